"""Similarity join of word n-gram sets by signature trees.

Two documents link when their sets of shingles agree to at least ``PERCENT``
(intersection over union). Equal sets are one class from the start.

Candidates: in any fixed order of shingles, linked sets of n shingles share at
least a known number of the first n - ceil(n * PERCENT / 100) + n / 10 or more (by hash;
see :func:`prefix_sizes`). A class stays only if that many of its prefix shingles
occur in other classes, and each may leave out its most frequent ones up to
half of that number, which keeps passages that many texts share from tying
them together. Classes that share a remaining shingle are tied by spanning
forests, so ties are at most as many as classes and tasks, never pairs. Tied
classes are the only possible partners.

Join: the sets of tied classes come together in blocks of bounded size; small
ties share a block, where the traversal keeps them apart. A block is a tree whose nodes hold the union of token bitmaps and the range of
set sizes. Pairs of nodes are visited from the root; a pair is left out if
the sizes or the common bits rule out enough overlap, or if all its members
are linked already. What remains is compared exactly.

A tie with more classes than one block is not compared block by block: each
block is joined with a few hubs, which links what belongs together, and only
classes that end up outside the largest group of their tie are compared with
all blocks.

Those shortcuts give groups (:func:`similar`). The join itself (:func:`links`,
:func:`link_counts`) compares each block of a tie with itself and with every
other one and leaves out no pair because its members are linked already.

Defined results: null and blank texts have no shingles, are linked with
nothing and are their own component. Fewer words than a shingle make one
shingle. Rows that share an id are one document. Rows without an id are linked
with nothing and have no component. Every input row gives one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.components import components
from quartermark.llm.forests import spanning_forest
from quartermark.llm.words import BLANK_WORDS_LOWER, LETTER_WORDS_LOWER, Words, binary, mix, shingles, slices, tidy
from quartermark.session import written_once

SHINGLE = 4
PERCENT = 85
BLOCK = 2048
HUBS = 32
LEAF = 16
SMALL = 48
FANOUT = 8
LINKS_PER_BATCH = 100_000


def shingle_sets(texts: list[bytes], size: int = SHINGLE, letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, one text after another, and how many each has."""
    found = Words(texts, LETTER_WORDS_LOWER if letters else BLANK_WORDS_LOWER)
    hashes = found.hashes()
    full = shingles(hashes, size)
    n = np.maximum(found.counts - size + 1, 0)
    place = np.repeat(found.first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    owner, values = np.repeat(np.arange(len(n)), n), full[place] if len(place) else np.empty(0, np.uint64)
    for words in range(1, size):
        few = np.flatnonzero(found.counts == words)
        if len(few):
            owner = np.concatenate([owner, few])
            values = np.concatenate([values, shingles(hashes, words)[found.first[few]]])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    return values[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def digests(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    total, other = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    np.cumsum(mix(values + np.uint64(0x14057B7EF767814F)), out=other[1:])
    b = np.cumsum(sizes)
    a = b - sizes
    one = mix(total[b] - total[a] + sizes.astype(np.uint64))
    return one.view(np.int64), (mix(other[b] - other[a]) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n shares with any set that it links with."""
    return -(-(n * percent) // 100)


def prefix_sizes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix length of a set, and how many of its prefix shingles any linked set's prefix has.

    A set of n shares at least ceil(n p) shingles with a linked one, so at most
    n - ceil(n p) of its first shingles are not common. With s(n) further ones in
    each prefix, both hold the first min(s) common shingles. A linked set has at
    least ceil(n p) shingles, so that is at least s(ceil(n p)), as far as there
    are that many. A small set takes part whole: few shared shingles of a few
    would say too little.
    """
    least = least_overlap(n, percent)
    return np.minimum(n, n - least + further(n)), np.minimum(least, further(least))


def further(n: np.ndarray) -> np.ndarray:
    """Prefix shingles beyond those that may be uncommon; grows with n."""
    return np.maximum(SMALL, n // 10)


def prefix_runs(texts: list[bytes], size: int, percent: int, letters: bool) -> dict:
    """The prefix shingles of each text for :func:`shared.shared_runs`; ``last`` is the set's size."""
    values, sizes = shingle_sets(texts, size, letters)
    rk1, rk2 = digests(values, sizes)
    take, _ = prefix_sizes(sizes, percent)
    first = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), take)
    place = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
    return {
        "text": text,
        "anchor": values[first[text] + place],
        "first": np.zeros(len(text), np.int32),
        "last": sizes[text].astype(np.int32),
        "again": np.zeros(len(text), bool),
        "rk1": rk1,
        "rk2": rk2,
    }


class Tree:
    """Sets of one block, in leaves of similar sets below nodes with united bitmaps."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        low = np.array([int(s[0]) >> 1 for s in sets], np.int64)
        order = np.lexsort((low, (np.log(sizes) * 3).astype(np.int64)))
        self.order = order
        self.sets = [sets[i] for i in order]
        self.sizes = sizes[order]
        wanted = 4 * int(np.quantile(sizes, 0.9))
        bits = min(1 << 15, max(512, 1 << wanted.bit_length()))
        maps = np.zeros((len(sets), bits), bool)
        for i, s in enumerate(self.sets):
            maps[i, (s >> np.uint64(8)).astype(np.int64) & (bits - 1)] = True
        self.maps = np.packbits(maps, axis=1).view(np.uint64)
        extra = self.sizes - np.bitwise_count(self.maps).sum(axis=1)
        # Levels from the leaves up: bitmaps, smallest and largest size, most shingles that share a bit.
        self.levels = []
        maps, small, large, most, width = self.maps, self.sizes, self.sizes, extra, LEAF
        while True:
            edges = np.arange(0, len(small), width)
            maps = np.bitwise_or.reduceat(maps, edges, axis=0)
            small, large = np.minimum.reduceat(small, edges), np.maximum.reduceat(large, edges)
            most = np.maximum.reduceat(most, edges)
            self.levels.append((maps, small, large, most))
            if len(small) == 1:
                break
            width = FANOUT
        self.extra = extra

    def possible(self, level, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Node pairs that may hold a linked pair: by sizes, and by the most shingles that can agree."""
        maps, small, large, most = level
        fits = (large[a] * 100 >= small[b] * percent) & (large[b] * 100 >= small[a] * percent)
        common = np.zeros(len(a), np.int64)
        chosen = np.flatnonzero(fits)
        for k in range(0, len(chosen), 4096):
            part = chosen[k : k + 4096]
            common[part] = np.bitwise_count(maps[a[part]] & maps[b[part]]).sum(axis=1)
        overlap = np.minimum(np.minimum(most[a], most[b]) + common, np.minimum(large[a], large[b]))
        return fits & (overlap * (100 + percent) >= percent * (small[a] + small[b]))

    def leaf_pairs(self, percent: int):
        """Pairs of leaves that dual traversal cannot rule out, each leaf with itself first."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            kept = self.possible(self.levels[depth], a, b, percent)
            a, b = a[kept], b[kept]
            if depth == 0:
                order = np.argsort(a != b, kind="stable")
                return a[order], b[order]
            n = len(self.levels[depth - 1][1])
            step = np.arange(FANOUT)
            a = (a[:, None, None] * FANOUT + step[:, None] + 0 * step).ravel()
            b = (b[:, None, None] * FANOUT + 0 * step[:, None] + step).ravel()
            kept = (a < n) & (b < n) & (a <= b)
            a, b = a[kept], b[kept]


def linked(sets: list[np.ndarray], percent: int = PERCENT, hidden: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets as all links would; ``hidden`` pairs (both true) need no comparison."""
    tree = Tree(sets)
    root = np.arange(len(sets))
    links = []
    for a, b in zip(*(x.tolist() for x in tree.leaf_pairs(percent))):
        i = np.arange(a * LEAF, min((a + 1) * LEAF, len(sets)))
        j = np.arange(b * LEAF, min((b + 1) * LEAF, len(sets)))
        x, y = np.repeat(i, len(j)), np.tile(j, len(i))
        kept = root[x] != root[y]
        if a == b:
            kept &= x < y
        if not kept.any():
            continue
        x, y = x[kept], y[kept]
        kept = tree.possible((tree.maps, tree.sizes, tree.sizes, tree.extra), x, y, percent)
        for p, q in zip(x[kept].tolist(), y[kept].tolist()):
            if root[p] == root[q]:
                continue
            one, two = tree.sets[p], tree.sets[q]
            if len(one) > len(two):
                one, two = two, one
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            common = int((two[at] == one).sum())
            if 100 * common >= percent * (len(one) + len(two) - common):
                links.append((int(tree.order[p]), int(tree.order[q])))
                root[root == root[q]] = root[p]
    return links


def every_link(sets: list[np.ndarray], percent: int = PERCENT, sides: np.ndarray | None = None):
    """All linked pairs, in arrays of places; with ``sides``, only those between different sides."""
    tree = Tree(sets)
    sides = None if sides is None else sides[tree.order]
    for a, b in zip(*(x.tolist() for x in tree.leaf_pairs(percent))):
        i = np.arange(a * LEAF, min((a + 1) * LEAF, len(sets)))
        j = np.arange(b * LEAF, min((b + 1) * LEAF, len(sets)))
        x, y = np.repeat(i, len(j)), np.tile(j, len(i))
        kept = x < y if a == b else np.ones(len(x), bool)
        if sides is not None:
            kept &= sides[x] != sides[y]
        x, y = x[kept], y[kept]
        kept = tree.possible((tree.maps, tree.sizes, tree.sizes, tree.extra), x, y, percent)
        x, y = x[kept], y[kept]
        for p in np.unique(x).tolist():
            one, others = tree.sets[p], y[x == p]
            values = np.concatenate([tree.sets[q] for q in others])
            hit = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
            common = np.bincount(np.repeat(np.arange(len(others)), tree.sizes[others])[hit], minlength=len(others))
            found = tree.order[others[100 * common >= percent * (len(one) + tree.sizes[others] - common)]]
            if len(found):
                yield np.full(len(found), tree.order[p]), found


def band_starts(percent: int, bits: int = 40) -> np.ndarray:
    """Set sizes at which bands begin: sets of two bands that are not neighbours cannot link."""
    starts = [1]
    while starts[-1] < 1 << bits:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts)


def ties(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes (id, places) connected by shared prefix shingles, as spanning forests.

    A task connects what it sees and tells the others which of its groups has
    which shingle, so a frequent shingle costs a row for each task.

    Linked sets lie in one band of sizes or in neighbouring ones. So every class
    is two nodes, 2 id and 2 id + 1: one among its own band and the one below,
    one among its own and the one above. Sets of quite different sizes are
    never tied together by others in between.
    """
    n = shared.partitions(classes)
    starts = band_starts(percent)

    def connected(anchor, node):
        """Which group of nodes has which anchor, and a forest that connects the nodes of each group."""
        label, edges = spanning_forest(anchor, node)
        pairs = np.unique(np.stack([anchor.view(np.int64), label]), axis=1)
        return pairs[0].copy().view(np.uint64), pairs[1].copy(), edges

    def rows(anchor, node, pairs):
        out = [(b, 0, shared.pack(anchor=anchor[at], node=node[at])) for b, at in shared.dealt(shared.buckets_of(anchor, n), n)]
        if len(pairs):
            out.append((0, 1, shared.pack(a=pairs[:, 0].copy(), b=pairs[:, 1].copy())))
        return shared.packed_batch(out)

    @tidy
    def local(batches):
        anchors, nodes, count = [], [], 0
        for batch in batches:
            for node, blob in zip(batch.column("id").to_pylist(), batch.column("places").to_pylist()):
                place = shared.unpack(blob)
                size = place["last"][:1].astype(np.int64)
                needed = int(prefix_sizes(size, percent)[1][0])
                anchor = place["anchor"]
                if len(anchor) < needed:
                    continue
                if needed > 2:
                    order = np.argsort(place["often"], kind="stable")
                    anchor = anchor[order[: len(order) - (needed - 1) // 2]]
                band = int(np.searchsorted(starts, size[0], "right")) - 1
                for upper in (0, 1):
                    anchors.append(mix(anchor + np.uint64(0x9E3779B97F4A7C15 * (band + upper) % (1 << 64))))
                    nodes.append(np.full(len(anchor), 2 * node + upper, np.int64))
                    count += len(anchor)
                if count >= shared.FLUSH_ROWS:
                    yield rows(*connected(np.concatenate(anchors), np.concatenate(nodes)))
                    anchors, nodes, count = [], [], 0
        if anchors:
            yield rows(*connected(np.concatenate(anchors), np.concatenate(nodes)))

    @tidy
    def merge(batches):
        parts = [shared.unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if parts:
            c = shared.joined(parts)
            _, pairs = spanning_forest(c["anchor"], c["node"])
            yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})

    @tidy
    def spread(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                yield pa.RecordBatch.from_pydict(shared.unpack(blob))

    found = written_once(classes.select("id", "places").mapInArrow(local, shared.PACKED), "ties")
    across = shared.exchange(found.filter("kind = 0"), n).mapInArrow(merge, "a long, b long")
    return across.unionByName(found.filter("kind = 1").mapInArrow(spread, "a long, b long")).distinct()


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) links among rows (task key, id, tokens) that share a key; keys are bounded groups."""

    @tidy
    def join(batches):
        key, ids, sets, last = None, [], [], None

        def found():
            pairs = linked(sets, percent) if len(sets) > 1 else []
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([ids[p] for p, _ in pairs], pa.int64()), "b": pa.array([ids[q] for _, q in pairs], pa.int64())}
            )

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("task", "id", "tokens")]
            for task, node, tokens in zip(*columns):
                if task != key:
                    if len(sets) > 1:
                        yield found()
                    key, ids, sets, last = task, [], [], None
                if (node, tokens) == last:  # a class of two ties that share the tree
                    continue
                last = (node, tokens)
                ids.append(node)
                sets.append(np.frombuffer(tokens, np.uint64))
        if len(sets) > 1:
            yield found()

    n = shared.partitions(members)
    sorted_rows = members.repartition(n, "task").sortWithinPartitions("task", "id")
    return sorted_rows.mapInArrow(join, "a long, b long")


def all_block_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) all links among rows (task key, side, id, tokens) that share a key; keys are bounded groups.

    Side -1 is a block compared with itself; of sides 0 and 1 only links across count.
    """

    @tidy
    def join(batches):
        key, ids, sides, sets = None, [], [], []

        def found():
            names, side, held, size = np.array(ids, np.int64), np.array(sides), [], 0
            across = side[0] >= 0
            if len(sets) < 2 or (across and (side == side[0]).all()):
                return
            for pair in every_link(sets, percent, side if across else None):
                held.append(pair)
                size += len(pair[0])
                if size >= LINKS_PER_BATCH:
                    yield batch_of(names, held)
                    held, size = [], 0
            if held:
                yield batch_of(names, held)

        def batch_of(names, held):
            a, b = (names[np.concatenate(x)] for x in zip(*held))
            return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("task", "side", "id", "tokens")]
            for task, side, node, tokens in zip(*columns):
                if task != key:
                    if sets:
                        yield from found()
                    key, ids, sides, sets = task, [], [], []
                ids.append(node)
                sides.append(side)
                sets.append(np.frombuffer(tokens, np.uint64))
        if sets:
            yield from found()

    n = shared.partitions(members)
    return members.repartition(n, "task").sortWithinPartitions("task", "id").mapInArrow(join, "a long, b long")


def tied_sets(docs: DataFrame, key: str, text: str, size: int, percent: int, letters: bool, block: int, by_class: bool = False):
    """Sets of all rows, their classes, the ties of classes, and the tokens of tied classes in their blocks.

    Tokens are named by the smallest id of their class, or with ``by_class`` by its hash rk1.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    @tidy
    def digest(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, sizes = shingle_sets(binary(part.column("text")).to_pylist(), size, letters)
                d1, d2 = digests(values, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(d1), pa.array(d2), pa.array(sizes)], ["doc_id", "rk1", "rk2", "n"]
                )

    base = written_once(rows.mapInArrow(digest, "doc_id long, rk1 long, rk2 int, n long"), "sets")
    classes = base.filter("n > 0 AND doc_id IS NOT NULL").groupBy("rk1", "rk2").agg(F.min("doc_id").alias("id"))
    plain = rows.withColumns({"rk1": F.lit(0).cast("long"), "rk2": F.lit(0).cast("int")})
    # Rows without an id are no partners.
    runs = shared.shared_runs(
        plain.filter("doc_id IS NOT NULL"), lambda texts: prefix_runs(texts, size, percent, letters), once=True
    )
    tied = components(ties(classes.join(runs, ["rk1", "rk2"]), percent))

    tied = tied.select(F.shiftright("node", 1).alias("id"), F.col("label").alias("tie"))
    # Blocks are settled before the sets are there, so that only numbers are shuffled for it.
    ties_size = tied.groupBy("tie").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("blocks"))
    tied = written_once(tied.join(ties_size, "tie"), "tied")
    wanted = tied.join(classes, "id")

    @tidy
    def tokens(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, sizes = shingle_sets(binary(part.column("text")).to_pylist(), size, letters)
                d1, d2 = digests(values, sizes)
                same = (d1 == part.column("rk1").to_numpy()) & (d2 == part.column("rk2").to_numpy())
                b = np.cumsum(sizes)
                sets = [values[x:y].tobytes() for x, y in zip(b - sizes, b)]
                out = pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rk1" if by_class else "id", "tie", "blocks")), pa.array(sets, pa.binary())],
                    ["id", "tie", "blocks", "tokens"],
                )
                yield out.filter(pa.array(same))

    texts = rows.join(wanted, rows["doc_id"] == wanted["id"]).select("id", "tie", "blocks", "rk1", "rk2", "text")
    members = written_once(texts.mapInArrow(tokens, "id long, tie long, blocks long, tokens binary"), "members")
    return base, classes, tied, members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))


def task(a, b):
    return F.concat_ws("/", "tie", a, b).alias("task")


def similar(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    letters: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Per document row: key, set size and component (the smallest id reachable by links)."""
    base, classes, tied, placed = tied_sets(docs, key, text, size, percent, letters, block)
    # Ties of one block share trees of about half a block's sets.
    bins = max(1, tied.filter("blocks = 1").count() // max(1, block // 2))
    shared_tree = F.concat(F.lit("tree/"), F.pmod(F.xxhash64("tie"), F.lit(bins)))
    place = F.when(F.col("blocks") == 1, shared_tree).otherwise(F.concat_ws("/", "tie", "block", F.lit("h")))
    own = placed.select(place.alias("task"), "id", "tokens")
    # Hubs: about HUBS classes of a tie that has several blocks, chosen by hash, in each of its blocks.
    hub = placed.filter((F.col("blocks") > 1) & (F.pmod(F.hash("id"), F.ceil(F.col("blocks") * block / HUBS)) == 0))
    hubs = hub.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("at <> block")
    links = written_once(block_links(own.unionByName(hubs.select(task(F.col("at"), F.lit("h")), "id", "tokens")), percent), "links")
    groups = components(links)
    if not tied.filter("blocks > 1").isEmpty():
        several = tied.filter("blocks > 1").join(groups, tied["id"] == groups["node"], "left")
        several = several.select("tie", "id", F.coalesce("label", "id").alias("group"))
        by_group = several.groupBy("tie", "group").agg(F.count("*").alias("n"))
        largest = by_group.groupBy("tie").agg(F.max_by("group", F.struct("n", "group")).alias("largest"))
        outside = several.join(largest, "tie").filter("group <> largest").select("tie", "id")
        count = outside.groupBy("tie").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("outer_blocks"))
        wide = placed.filter("blocks > 1")
        outside = wide.join(outside.join(count, "tie"), ["tie", "id"])
        outside = outside.withColumn("outer", F.pmod(F.xxhash64("id"), F.col("outer_blocks")))
        inner = wide.join(count, "tie").withColumn("outer", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)))
        outer = outside.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("at <> block")
        pairs = inner.select(task(F.col("block"), F.col("outer")), "id", "tokens").unionByName(
            outer.select(task(F.col("at"), F.col("outer")), "id", "tokens")
        )
        links = links.unionByName(written_once(block_links(pairs, percent), "links"))
        groups = components(links)

    # Rows that share an id are one document, so their classes belong together.
    of_class = classes.join(groups, classes["id"] == groups["node"], "left").select(
        "rk1", "rk2", F.coalesce("label", "id").alias("component")
    )
    named = base.join(of_class, ["rk1", "rk2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def class_links(placed: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: all links of classes; each block of a tie meets itself and every other one."""
    every = placed.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("at"), -1).otherwise((F.col("block") > F.col("at")).cast("int")).alias("side")
    pairs = every.select(task(F.least("block", "at"), F.greatest("block", "at")), side, "id", "tokens")
    # Classes may share two ties.
    return all_block_links(pairs, percent).filter("a <> b").distinct()


def links(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    letters: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """(a, b): all links between different sets, each set named by its hash. Equal sets are one."""
    return class_links(tied_sets(docs, key, text, size, percent, letters, block, by_class=True)[3], percent)


def link_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    letters: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Per document row: key, set size and how many other documents its set links with.

    Links are kept by class, so equal documents are counted and never paired.
    """
    base, _, _, placed = tied_sets(docs, key, text, size, percent, letters, block, by_class=True)
    found = written_once(class_links(placed, percent), "class-links")
    named = base.filter("n > 0 AND doc_id IS NOT NULL").select("rk1", "doc_id").distinct()
    sizes = named.groupBy("rk1").agg(F.count("*").alias("size"))
    near = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = near.unionByName(sizes.select(F.col("rk1").alias("a"), F.col("rk1").alias("b")))
    total = near.join(sizes, F.col("b") == F.col("rk1")).groupBy("a").agg(F.sum("size").alias("total"))
    # An id with several texts may be in several of these classes; it counts once.
    several = named.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id").join(named, "doc_id")
    twice = near.join(several, F.col("b") == F.col("rk1")).groupBy("a", "doc_id").agg((F.count("*") - 1).alias("more"))
    twice = twice.groupBy("a").agg(F.sum("more").alias("more"))
    counted = total.join(twice, "a", "left").select(
        F.col("a").alias("rk1"), (F.col("total") - F.coalesce("more", F.lit(0)) - 1).alias("n_links")
    )
    taking_part = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return base.join(counted, "rk1", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(taking_part, F.col("n_links")).otherwise(0).alias("n_links")
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; rows without an id stay."""
    found = similar(docs, key, text, **options).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.join(found, plain[f"c{names.index(key)}"].cast("long") == found["gone"], "left_anti").toDF(*names)
