"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

Signature: every element of a set (a shingle) deals out the slots in an order
of its own, a permutation that grows by one swap a step, and in step j offers
the rank j plus a random fraction to the slot drawn. A slot keeps the smallest
rank. Offers of one element are correlated: it never gives two slots the same
step, which lowers the variance against independent hashes. A set stops as
soon as each of its slots holds a rank below the next step; a set of many
elements is done after a step or two.

Banding: ``BANDS`` bands of ``ROWS`` slots. Sets that agree in a band are
candidates. A link of similarity 0.85 is missed with a probability of about
1 in 13,000 (0.623 to the power 20), a closer one more rarely.

Grouping: sets that share bands, directly or through others, form a tie. Tasks
connect the sets they see themselves (a spanning forest), so a band that very
many sets share costs one row for each task, not one for each set or pair.
The sets of a tie meet in blocks of bounded size, where union-find walks the
sets of each band: a pair is compared in full unless it is connected already.
A tie of several blocks is joined with a few hubs first; only sets that end up
outside the largest group of their tie meet all of its blocks.

Defined results: null and blank texts have no shingles, are linked with
nothing and are their own component. Fewer words than a shingle make one
shingle. Rows that share an id are one document, whatever their texts; of
these, a row without words still is its own component. Rows without an id are
linked with nothing and have neither component nor mark. Every input row gives
one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.components import components
from quartermark.llm.forests import spanning_forest
from quartermark.llm.jaccard_trees import digests, shingle_sets
from quartermark.llm.words import binary, mix, slices, tidy
from quartermark.session import written_once

SHINGLE = 3
PERCENT = 85
BANDS = 20
ROWS = 6
# A block has about so many sets, and so many shingles.
BLOCK = 2048
BLOCK_SHINGLES = 4_000_000
HUBS = 32

_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


def draw(elements: np.ndarray, step: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element: the place to swap with in this step, and its rank (step and 32 random bits)."""
    random = mix(elements + np.uint64(_STEP * (step + 1) % (1 << 64)))
    place = np.uint64(step) + (((random & _LOW) * np.uint64(slots - step)) >> np.uint64(32))
    return place.astype(np.int64), (np.uint64(step) << np.uint64(32)) | (random >> np.uint64(32))


def signatures(values: np.ndarray, sizes: np.ndarray, slots: int = BANDS * ROWS) -> np.ndarray:
    """The signature of each set, one row each; ``values`` holds the sets one after another."""
    sets = len(sizes)
    best = np.full(sets * slots, np.uint64(0xFFFFFFFFFFFFFFFF))
    owner = np.repeat(np.arange(sets), sizes)

    def offer(cell: np.ndarray, rank: np.ndarray) -> None:
        np.minimum.at(best, cell, rank)

    # In the first step no permutation has been changed yet: the place drawn is the slot.
    place, rank = draw(values, 0, slots)
    offer(owner * slots + place, rank)
    turn = None
    for step in range(1, slots):
        worst = best.reshape(sets, slots).max(axis=1) if sets else best
        going = worst >= np.uint64(step) << np.uint64(32)
        alive = np.flatnonzero(going[owner])
        if not len(alive):
            break
        if turn is None:
            turn = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(alive), 1))
            values, owner, place = values[alive], owner[alive], place[alive]
            at = np.arange(len(alive))
            turn[at, 0], turn[at, place] = place, 0
        elif len(alive) < len(owner):
            values, owner, turn = values[alive], owner[alive], turn[alive]
        place, rank = draw(values, step, slots)
        at = np.arange(len(values))
        slot = turn[at, place].astype(np.int64)
        turn[at, place] = turn[at, step]
        offer(owner * slots + slot, rank)
    return best.reshape(sets, slots)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of each signature."""
    sets, slots = signature.shape
    rows = signature.reshape(sets, bands, slots // bands)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (sets, bands))
    for k in range(rows.shape[2]):
        key = mix(key * np.uint64(0x2545F4914F6CDD1D) + rows[:, :, k])
    return key


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, rk1, rk2, n, bands): two hashes of each row's set, its size, and its packed band keys."""
    @tidy
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, sizes = shingle_sets(binary(part.column("text")).to_pylist(), size)
                d1, d2 = digests(values, sizes)
                keys = band_keys(signatures(values, sizes, bands * rows), bands)
                packed = [k.tobytes() if n else None for k, n in zip(keys, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(d1), pa.array(d2), pa.array(sizes), pa.array(packed, pa.binary())],
                    ["doc_id", "rk1", "rk2", "n", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, rk1 long, rk2 int, n long, bands binary")


def ties(classes: DataFrame) -> DataFrame:
    """(a, b): classes (id, bands) connected by shared bands, as spanning forests."""
    n = shared.partitions(classes)

    def packed(keys, names, edges):
        out = [(b, 0, shared.pack(key=keys[at], node=names[at])) for b, at in shared.dealt(shared.buckets_of(keys, n), n)]
        if len(edges):
            out.append((0, 1, shared.pack(a=edges[:, 0].copy(), b=edges[:, 1].copy())))
        return shared.packed_batch(out)

    @tidy
    def local(batches):
        keys, nodes, count = [], [], 0

        def flush():
            key, node = np.concatenate(keys), np.concatenate(nodes)
            label, edges = spanning_forest(key, node)
            # What others need to know of this task: which of its groups has which band.
            pairs = np.unique(np.stack([key.view(np.int64), label]), axis=1)
            return packed(pairs[0].copy().view(np.uint64), pairs[1].copy(), edges)

        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for node, blob in zip(ids.tolist(), batch.column("bands").to_pylist()):
                keys.append(np.frombuffer(blob, np.uint64))
                nodes.append(np.full(len(keys[-1]), node, np.int64))
                count += len(keys[-1])
            if count >= shared.FLUSH_ROWS // 4:
                yield flush()
                keys, nodes, count = [], [], 0
        if keys:
            yield flush()

    @tidy
    def merge(batches):
        parts = [shared.unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if parts:
            c = shared.joined(parts)
            _, edges = spanning_forest(c["key"], c["node"])
            yield pa.RecordBatch.from_pydict({"a": edges[:, 0], "b": edges[:, 1]})

    @tidy
    def spread(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                yield pa.RecordBatch.from_pydict(shared.unpack(blob))

    found = written_once(classes.select("id", "bands").mapInArrow(local, shared.PACKED), "bands")
    across = shared.exchange(found.filter("kind = 0"), n).mapInArrow(merge, "a long, b long")
    return across.unionByName(found.filter("kind = 1").mapInArrow(spread, "a long, b long")).distinct()


def similar_pair(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets agree enough, on all their elements."""
    if len(one) > len(two):
        one, two = two, one
    if len(one) * 100 < percent * len(two):
        return False
    common = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def union_links(sets: list[np.ndarray], keys: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets as all verified candidates would; candidates share a band key."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    flat = keys.ravel()
    owner = np.repeat(np.arange(len(sets)), keys.shape[1])
    order = np.lexsort((owner, flat))
    edges = np.flatnonzero(np.diff(flat[order])) + 1
    links, tried = [], set()
    for group in np.split(owner[order], edges):
        if len(group) < 2:
            continue
        # Members by connected group; a newcomer is compared with the first of each group before the others.
        seen: dict[int, list[int]] = {}
        for x in group.tolist():
            for leader in list(seen):
                if find(leader) == find(x):
                    continue
                for y in seen[leader]:
                    pair = (y, x) if y < x else (x, y)
                    if pair in tried:
                        continue
                    tried.add(pair)
                    if similar_pair(sets[x], sets[y], percent):
                        links.append(pair)
                        root[find(x)] = find(y)
                        break
            merged: dict[int, list[int]] = {}
            for leader, members in [*seen.items(), (x, [x])]:
                merged.setdefault(find(leader), []).extend(members)
            seen = merged
    return links


def block_links(members: DataFrame, percent: int, bands: int) -> DataFrame:
    """(a, b) links among rows (task key, id, bands, tokens) that share a key; keys are bounded groups."""

    @tidy
    def join(batches):
        key, ids, keys, sets = None, [], [], []

        def found():
            pairs = union_links(sets, np.frombuffer(b"".join(keys), np.uint64).reshape(len(sets), bands), percent)
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([ids[p] for p, _ in pairs], pa.int64()), "b": pa.array([ids[q] for _, q in pairs], pa.int64())}
            )

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("task", "id", "bands", "tokens")]
            for task, node, blob, tokens in zip(*columns):
                if task != key:
                    if len(sets) > 1:
                        yield found()
                    key, ids, keys, sets = task, [], [], []
                ids.append(node)
                keys.append(blob)
                sets.append(np.frombuffer(tokens, np.uint64))
        if len(sets) > 1:
            yield found()

    n = shared.partitions(members)
    return members.repartition(n, "task").sortWithinPartitions("task", "id").mapInArrow(join, "a long, b long")


def tied_members(rows: DataFrame, classes: DataFrame, tied: DataFrame, size: int) -> DataFrame:
    """(id, tie, blocks, block, bands, tokens) of the tied classes, from the text of one row of each."""

    @tidy
    def tokens(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, sizes = shingle_sets(binary(part.column("text")).to_pylist(), size)
                d1, d2 = digests(values, sizes)
                same = (d1 == part.column("rk1").to_numpy()) & (d2 == part.column("rk2").to_numpy())
                upto = np.cumsum(sizes)
                sets = [values[a:b].tobytes() for a, b in zip(upto - sizes, upto)]
                out = pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "tie", "blocks", "bands")), pa.array(sets, pa.binary())],
                    ["id", "tie", "blocks", "bands", "tokens"],
                )
                yield out.filter(pa.array(same))

    wanted = tied.join(classes, "id")
    texts = rows.join(wanted, rows["doc_id"] == wanted["id"]).select("id", "tie", "blocks", "bands", "rk1", "rk2", "text")
    members = written_once(texts.mapInArrow(tokens, "id long, tie long, blocks long, bands binary, tokens binary"), "members")
    return members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))


def grouped(members: DataFrame, tied: DataFrame, percent: int, bands: int, block: int) -> DataFrame:
    """(a, b): verified links that give the groups of all tied classes."""
    payload = ["id", "bands", "tokens"]

    def task(*parts):
        return F.concat_ws("/", "tie", *parts).alias("task")

    own = members.select(task("block"), *payload)
    hub = members.filter((F.col("blocks") > 1) & (F.pmod(F.hash("id"), F.ceil(F.col("blocks") * block / HUBS)) == 0))
    hubs = hub.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("at <> block")
    links = written_once(block_links(own.unionByName(hubs.select(task("at"), *payload)), percent, bands), "links")
    large = tied.filter("blocks > 1")
    if large.isEmpty():
        return links
    groups = components(links)
    placed = large.join(groups, large["id"] == groups["node"], "left").select("tie", "id", F.coalesce("label", "id").alias("group"))
    sizes = placed.groupBy("tie", "group").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("tie").agg(F.max_by("group", F.struct("n", "group")).alias("largest"))
    outside = placed.join(largest, "tie").filter("group <> largest").select("tie", "id")
    count = outside.groupBy("tie").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("outer_blocks"))
    wide = members.filter("blocks > 1")
    inner = wide.join(count, "tie").withColumn("outer", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)))
    rest = wide.join(outside.join(count, "tie"), ["tie", "id"]).withColumn("outer", F.pmod(F.xxhash64("id"), F.col("outer_blocks")))
    rest = rest.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("at <> block")
    pairs = inner.select(task("block", "outer"), *payload).unionByName(rest.select(task("at", "outer"), *payload))
    return links.unionByName(written_once(block_links(pairs, percent, bands), "links"))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per document row: key, set size, component (the smallest id reachable by links), and whether it is the one kept."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    base = written_once(signed(texts, size, bands, rows), "signatures")
    takes_part = base.filter("n > 0 AND doc_id IS NOT NULL")
    # Equal sets are one class, named by the smallest id that has it.
    classes = written_once(
        takes_part.groupBy("rk1", "rk2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    tied = components(ties(classes)).select(F.col("node").alias("id"), F.col("label").alias("tie"))
    weight = tied.join(classes.select("id", "n"), "id").groupBy("tie").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / F.lit(block)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("long")
    tied = written_once(tied.join(weight.select("tie", blocks.alias("blocks")), "tie"), "tied")
    links = grouped(tied_members(texts, classes, tied, size), tied, percent, bands, block)
    # Classes of one id with several texts belong together.
    named = takes_part.select("doc_id", "rk1", "rk2").join(classes.select("rk1", "rk2", "id"), ["rk1", "rk2"])
    several = named.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b").select("doc_id", "a")
    same_id = several.join(named, "doc_id").filter("a <> id").select("a", F.col("id").alias("b")).distinct()
    groups = components(links.unionByName(same_id))
    of_class = classes.join(groups, classes["id"] == groups["node"], "left").select(
        "rk1", "rk2", F.coalesce("label", "id").alias("component")
    )
    found = base.select("doc_id", "rk1", "rk2", "n").join(of_class, ["rk1", "rk2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )
