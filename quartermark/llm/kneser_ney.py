"""Interpolated modified Kneser-Ney language model of three words (order 3), or of word pairs (order 2).

Counting runs in Spark. Tasks count words and pairs of consecutive words in
bounded steps and send packed counts to ranges of a hash, where they are added
up. Each range becomes one model file: sorted hashes and their counts. Word
numbers are places in the sorted word hashes; a pair's hash is a bijection of
its two numbers, so frequent words do not make a range larger. Counts of
distinct neighbours (for continuation and for the weight of a context) are
gathered in the same way. The driver sees one row per file and the counts of
counts, from which the discounts come.

Order 3 counts words after a pair, known by the pair's place among all pairs.
They lie in the range of their pair, in order, so a pair's followers need no
keys of their own. The middle level then has counts of distinct words before a
pair; a pair met once has one, so only the others are told to each other.

Scoring maps the files into memory and looks a slice of text up at once, in
sorted order. Nothing is pruned: the model grows with the corpus, and workers
read the pages they need. They keep a bounded number of files open; of storage
that is not mounted they read the files of one range after another and keep
``READ_BYTES`` of them for each table. More than ``LARGEST_VOCABULARY``
different tokens, or 2^32 pairs or triples in one range, raise an error.

P(w|uv) = max(c(uvw) - D(c), 0) / c(uv) + g(uv) P(w|v), where P(w|v) and P(w)
have the same form over continuation counts and end in a uniform share for each
known word and one unknown word. A text begins in one start context and ends in
an end token: its first word has that context alone, and pairs that begin with
it keep their own counts, as nothing stands before them.

Defined results: a null text is empty and has the end token alone. An empty
training part gives every token the share of the unknown word. Every input
row gives one row; rows without an id count as id ''. Only id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.files import Writer, array_at
from quartermark.llm.words import BLANK_WORDS_LOWER, Words, binary, mix, slices
from quartermark.session import shared_dir, written_once

END = np.uint64(0x0123456789ABCDEF)
SLICE_BYTES = 4 << 20
COUNTED = 3_000_000
ALPHA = 0.1
ORDER = 3


def range_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of all hashes each one lies in."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, texts one after another with their end tokens, and the count of each text."""
    found = Words(texts, BLANK_WORDS_LOWER)
    sizes = found.counts + 1
    out = np.full(int(sizes.sum()), END)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(sizes) - 1] = False
    out[inside] = found.hashes()
    return out, sizes


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them; for values that repeat often."""
    table = pa.array(values).dictionary_encode()
    found = table.dictionary.to_numpy()
    order = np.argsort(found)
    code = np.empty(len(order), np.int64)
    code[order] = np.arange(len(order))
    return found[order], code[table.indices.to_numpy()]


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of at least 0, sorted, and the row of each."""
    width = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + width > 63:
        order = np.argsort(values, kind="stable")
        return values[order], order
    # One value for both sorts faster than an order of rows.
    both = (values << width) | np.arange(len(values))
    both.sort()
    return both >> width, both & ((1 << width) - 1)


def counted(keys: np.ndarray, counts: np.ndarray | None = None, home: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sum of their counts; with ``home``, keys are told apart and sorted within their home."""
    if home is not None and len(keys):
        width = int(keys.max()).bit_length()
        if width + int(home.max()).bit_length() <= 64:  # home and key fit into one value
            both, sums = counted((home.astype(np.uint64) << np.uint64(width)) | keys.astype(np.uint64), counts)
            inside = np.uint64((1 << width) - 1)
            return (both & inside).astype(keys.dtype), sums, (both >> np.uint64(width)).astype(home.dtype)
    if home is not None:
        order = np.lexsort((keys, home))
        keys = keys[order]
    elif counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys = keys[order]
    edge = np.diff(keys, prepend=~keys[:1]) != 0
    if home is not None:
        home = home[order]
        edge[1:] |= home[1:] != home[:-1]
    new = np.flatnonzero(edge)
    if counts is None:
        sums = np.diff(np.append(new, len(keys)))
    else:
        sums = np.add.reduceat(counts[order], new) if len(new) else counts[:0]
    return (keys[new], sums) if home is None else (keys[new], sums, home[new])


SMALL = "small"
# What a worker keeps open of each table: mapped files, and bytes of files that it had to read.
OPEN_FILES = 2048
READ_BYTES = 64 << 20
# Word numbers have 32 bits, and the start context is one of them.
LARGEST_VOCABULARY = (1 << 32) - 2


class Ranges:
    """Sorted hashes with their columns, one file for each range and column."""

    def __init__(self, folder: str, sizes: list[int], kinds: dict[str, str]):
        self.folder, self.sizes, self.kinds = folder, sizes, kinds
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.open: dict = {}
        self.read = 0

    def __getstate__(self):
        return self.__dict__ | {"open": {}, "read": 0}

    def column(self, number: int, name: str) -> np.ndarray:
        found = self.open.get((number, name))
        if found is None:
            kind = "<u1" if self.kinds.get(name) == SMALL else self.kinds.get(name, "<u8")
            found = array_at(f"{self.folder}/{name}-{number:05d}", kind).view(np.ndarray)  # plain, for short lookups
            self.read += self.held(found)
            # Ranges are visited in order, so the oldest is the one that is needed last.
            while self.open and (len(self.open) >= OPEN_FILES or self.read > READ_BYTES):
                self.read -= self.held(self.open.pop(next(iter(self.open))))
            self.open[number, name] = found
        return found

    @staticmethod
    def held(values: np.ndarray) -> int:
        return 0 if isinstance(values.base, np.memmap) else values.nbytes

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each sorted key among all keys, or -1."""
        out = np.full(len(keys), -1, np.int64)
        edges = np.searchsorted(range_of(keys, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for r in range(len(self.sizes)):
            a, b = edges[r], edges[r + 1]
            if a < b and self.sizes[r]:
                column = self.column(r, "key")
                at = np.searchsorted(column, keys[a:b])
                hit = column[np.minimum(at, len(column) - 1)] == keys[a:b]
                out[a:b][hit] = self.first[r] + at[hit]
        return out

    def take(self, name: str, places: np.ndarray) -> np.ndarray:
        """Values at sorted places (-1: 0)."""
        small = self.kinds[name] == SMALL
        out = np.zeros(len(places), np.int64 if small else self.kinds[name])
        for r, a, b in self.parts(places):
            at = places[a:b] - self.first[r]
            out[a:b] = self.small(r, name, at) if small else self.column(r, name)[at]
        return out

    def parts(self, places: np.ndarray):
        """Range, begin and end of the sorted places that lie in each range."""
        edges = np.searchsorted(places, self.first)
        for r in np.flatnonzero(edges[:-1] < edges[1:]):
            yield int(r), edges[r], edges[r + 1]

    def small(self, number: int, name: str, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Values of a column of mostly small numbers, see :func:`saved_small`."""
        out = self.column(number, name)[at].astype(np.int64)
        over = np.flatnonzero(out == 255)
        if len(over):
            place = over if isinstance(at, slice) else at[over]
            out[over] = self.column(number, f"{name}_large")[np.searchsorted(self.column(number, f"{name}_at"), place)]
        return out


def saved(folder: str, number: int, **columns: np.ndarray) -> None:
    for name, values in columns.items():
        out = Writer(folder, f"{name}-{number:05d}")
        out.write(np.ascontiguousarray(values).tobytes())
        out.close()


def saved_small(folder: str, number: int, **columns: np.ndarray) -> None:
    """Columns of one byte, with the values that need more in columns beside them."""
    for name, values in columns.items():
        over = np.flatnonzero(values >= 255)
        large = {f"{name}_at": over.astype(np.uint64), f"{name}_large": values[over].astype(np.uint64)}
        saved(folder, number, **{name: np.minimum(values, 255).astype(np.uint8)}, **large)


class Followers:
    """The words after each pair, in ascending order, in the range of their pair."""

    def __init__(self, pairs: Ranges, words: Ranges):
        self.pairs, self.words = pairs, words

    def find(self, places: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many different words follow each pair (sorted places), and how often the given word does."""
        kinds, times = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        for r, a, b in self.pairs.parts(places):
            begin, column = self.pairs.column(r, "begin"), self.words.column(r, "word")
            at = places[a:b] - self.pairs.first[r]
            low, end = begin[at].astype(np.int64), begin[at + 1].astype(np.int64)
            kinds[a:b] = end - low
            spot = np.full(len(at), -1, np.int64)
            row = np.flatnonzero(low < end)
            low, high, wanted = low[row], end[row], words[a:b][row].astype(column.dtype)
            while len(row):
                middle = (low + high) >> 1
                met = column[middle]
                hit = met == wanted
                spot[row[hit]] = middle[hit]
                less = met < wanted
                low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
                live = np.flatnonzero((low < high) & ~hit)
                row, low, high, wanted = row[live], low[live], high[live], wanted[live]
            hit = np.flatnonzero(spot >= 0)
            times[a:b][hit] = self.words.small(r, "count", spot[hit])
        return kinds, times


@dataclass
class Model:
    words: Ranges  # key, count
    pairs: Ranges  # key, count; in order 3 also before, n1, n2 and the begin of its followers
    about: Ranges  # by word number: before, total, n1, n2, n3
    tokens: int
    vocabulary: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    kinds: int  # distinct pairs
    rest: float  # weight of the uniform share
    followers: Followers | None = None  # in order 3
    triple_discounts: np.ndarray | None = None

    def __post_init__(self):
        self.start = self.vocabulary

    def discounted(self, counts: np.ndarray, discounts: np.ndarray) -> np.ndarray:
        return np.maximum(counts - discounts[np.minimum(counts, 3)], 0.0)

    def score(self, hashes: np.ndarray, sizes: np.ndarray):
        """For each text: known tokens, base score and log10 probability."""
        keys, code = distinct(hashes)
        place = self.words.find(keys)
        met = np.flatnonzero(place >= 0)  # places ascend with the hashes

        def of_words(table: Ranges, name: str) -> np.ndarray:
            out = np.zeros(len(place), np.int64)
            out[met] = table.take(name, place[met])
            return out

        count = of_words(self.words, "count").astype(np.float64)
        before = of_words(self.about, "before")
        total = of_words(self.about, "total").astype(np.float64)
        lost = sum(d * of_words(self.about, c) for d, c in zip(self.pair_discounts[1:], ("n1", "n2", "n3")))
        uniform = 1.0 / (self.vocabulary + 1)
        low = self.discounted(before, self.word_discounts) / max(self.kinds, 1) + self.rest * uniform
        word = place[code]
        first = np.cumsum(sizes) - sizes
        left = np.empty(len(word), np.int64)
        left[1:] = word[:-1]
        left[first] = self.start
        left_code = np.empty(len(word), np.int64)
        left_code[1:] = code[:-1]
        start_total, start_lost = self.start_context()
        context = total[left_code.clip(0, len(total) - 1)]
        context_lost = lost[left_code.clip(0, len(total) - 1)]
        context[first], context_lost[first] = start_total, start_lost
        known = (left >= 0) & (word >= 0)
        pair = np.zeros(len(word))
        pair_place = np.full(len(word), -1, np.int64)
        if known.any():
            wanted, pair_code = np.unique(pair_keys(left[known], word[known]), return_inverse=True)
            found = self.pairs.find(wanted)
            times = np.zeros(len(wanted), np.int64)
            times[found >= 0] = self.pairs.take("before" if self.followers else "count", found[found >= 0])
            pair[known] = self.discounted(times, self.pair_discounts)[pair_code]
            pair_place[known] = found[pair_code]
        seen = context > 0
        safe = np.where(seen, context, 1.0)
        chance = np.where(
            seen,
            pair / safe + context_lost / safe * low[code],
            low[code],
        )
        if self.followers:
            chance = self.after_pairs(chance, pair_place, word, first)
        base = np.log10((count + ALPHA) / (self.tokens + ALPHA * (self.vocabulary + 1)))
        return (
            np.add.reduceat((count[code] > 0).astype(np.int64), first),
            np.add.reduceat(base[code], first),
            np.add.reduceat(np.log10(chance), first),
        )

    def after_pairs(self, lower: np.ndarray, pair_place: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Chances after two words, from those after one; ``first`` words have one start context only."""
        context = np.full(len(word), -1, np.int64)
        context[1:] = pair_place[:-1]
        context[first] = -1
        after = np.flatnonzero(context >= 0)
        place, order = in_order(context[after])
        order = after[order]
        kinds, times = self.followers.find(place, word[order])
        few = [self.pairs.take(c, place) for c in ("n1", "n2")]
        lost = sum(d * n for d, n in zip(self.triple_discounts[1:], (*few, kinds - few[0] - few[1])))
        # Every pair but those with the end token has a word after each of its occurrences.
        total = self.pairs.take("count", place)
        seen = kinds > 0
        out = lower.copy()
        out[order[seen]] = ((self.discounted(times, self.triple_discounts) + lost * lower[order]) / np.maximum(total, 1))[seen]
        return out

    def start_context(self) -> tuple[float, float]:
        number = len(self.about.sizes) - 1
        values = {k: self.about.column(number, k)[-1] for k in ("total", "n1", "n2", "n3")}
        lost = sum(d * values[k] for d, k in zip(self.pair_discounts[1:], ("n1", "n2", "n3")))
        return float(values["total"]), float(lost)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))


_UNMIX = [np.uint64(pow(k, -1, 1 << 64)) for k in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9)]


def pairs_of_keys(keys: np.ndarray) -> np.ndarray:
    """The left and right word in one number, from the hash of :func:`pair_keys`."""
    x = keys ^ (keys >> np.uint64(31)) ^ (keys >> np.uint64(62))
    x = x * _UNMIX[0]
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * _UNMIX[1]
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from how many have counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in counts_of_counts[:4])
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    found = [k - (k + 1) * y * b / a for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))])


def tally(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, and 3 or more."""
    few = np.bincount(np.minimum(counts, 5), minlength=6)
    return [int(few[1]), int(few[2]), int(few[3]), int(few[4]), int((counts >= 3).sum())]


STATS = "number int, size long, total long, tally array<long>"


def stats_batch(number: int, size: int, total: int, found: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([total], pa.int64()), pa.array([found], pa.list_(pa.int64()))],
        ["number", "size", "total", "tally"],
    )


def blobs(batches) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for batch in batches:
        for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
            out.setdefault(b, []).append(shared.unpack(blob))
    return out


def train(texts: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """A model of all given texts; its files lie in the shared folder."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: models of order 2 and 3 are built")
    spark = texts.sparkSession
    rows = texts.select(F.col(text).cast("string").alias("text"))
    n = shared.partitions(rows)
    folder = shared_dir(spark, "model")

    def summed(held, home, columns):
        keys, counts, *homes = counted(*(np.concatenate(part) for part in zip(*held)))
        dealt = shared.dealt(homes[0] if homes else home(keys), n)
        return shared.packed_batch([(b, 0, shared.pack(**columns(keys[at], b), count=counts[at].astype(np.uint32))) for b, at in dealt])

    def counting(keys_of, home=None, columns=lambda keys, b: {"key": keys}):
        """A task that counts the keys of its slices and sends them to their ranges.

        Without ``home``, ``keys_of`` gives keys that hold within a range, and the range of each.
        """

        def run(batches):
            held, size = [], 0
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    found = keys_of(binary(part.column("text")).to_pylist())
                    held.append(counted(found) if home else counted(found[0], home=found[1]))
                    size += len(held[-1][0])
                    if size >= COUNTED:
                        yield summed(held, home, columns)
                        held, size = [], 0
            if size:
                yield summed(held, home, columns)

        return run

    def keep_words(batches):
        for number, parts in blobs(batches).items():
            c = shared.joined(parts)
            keys, counts = counted(c["key"], c["count"].astype(np.int64))
            saved(f"{folder}/words", number, key=keys, count=counts.astype(np.uint64))
            yield stats_batch(number, len(keys), int(counts.sum()), [])

    def run(df, work):
        return {r["number"]: r for r in written_once(df.mapInArrow(work, STATS), "model-files").collect()}

    counted_words = rows.mapInArrow(counting(lambda t: token_hashes(t)[0], lambda keys: range_of(keys, n)), shared.PACKED)
    # One row for each range, so at most as many as there are partitions.
    found = run(shared.exchange(counted_words, n), keep_words)
    sizes = [found[i]["size"] if i in found else 0 for i in range(n)]
    words = Ranges(f"{folder}/words", sizes, {"key": "<u8", "count": "<u8"})
    vocabulary, tokens = sum(sizes), sum(r["total"] for r in found.values())
    if vocabulary > LARGEST_VOCABULARY:
        raise OverflowError(f"{vocabulary} different tokens; word numbers have 32 bits")

    def numbers_of(texts_):
        """Word numbers, the number before each (the start context before first words), and where texts begin."""
        hashes, lengths = token_hashes(texts_)
        keys, code = distinct(hashes)
        word = words.find(keys)[code]
        begin = np.cumsum(lengths) - lengths
        left = np.empty(len(word), np.int64)
        left[1:] = word[:-1]
        left[begin] = vocabulary
        return word, left, begin

    def pairs_of(texts_):
        word, left, _ = numbers_of(texts_)
        # Sorted by the plain pair, left words repeat and compress well; the hash is taken again where it is needed.
        return (left.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)

    first = words.first.copy()
    first[-1] += 1  # the start context is one more word, in the last range

    def neighbours(number, pairs, counts):
        """Packed rows of one range of sorted pairs: its tally, and what its words have beside them."""
        left, right = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows_out = [(0, 9, shared.pack(number=np.array([number]), size=np.array([len(pairs)]), tally=np.array(tally(counts))))]
        word, before = counted(right)
        for b, at in shared.dealt(np.searchsorted(first, word, "right") - 1, n):
            rows_out.append((b, 0, shared.pack(word=word[at], before=before[at])))
        new = np.flatnonzero(np.diff(left, prepend=-1))
        sums = {
            "total": np.add.reduceat(counts, new),
            "n1": np.add.reduceat((counts == 1).astype(np.int64), new),
            "n2": np.add.reduceat((counts == 2).astype(np.int64), new),
            "n3": np.add.reduceat((counts >= 3).astype(np.int64), new),
        }
        for b, at in shared.dealt(np.searchsorted(first, left[new], "right") - 1, n):
            rows_out.append((b, 1, shared.pack(word=left[new][at], **{k: v[at] for k, v in sums.items()})))
        return rows_out

    def keep_pairs(batches):
        for number, parts in blobs(batches).items():
            c = shared.joined(parts)
            pairs, counts = counted(c["key"], c["count"].astype(np.int64))
            keys = mix(pairs)
            order_ = np.argsort(keys)
            saved(f"{folder}/pairs", number, key=keys[order_])
            saved_small(f"{folder}/pairs", number, count=counts[order_])
            if order == 2:
                yield shared.packed_batch(neighbours(number, pairs, counts))
            else:
                yield stats_batch(number, len(pairs), int(counts.sum()), [])

    every = spark.range(n).selectExpr("CAST(id AS INT) AS bucket", "2 AS kind", "CAST(NULL AS BINARY) AS blob")
    pair_columns = {"key": "<u8", "count": SMALL, "before": SMALL, "n1": SMALL, "n2": SMALL, "begin": "<u4"}
    counted_pairs = shared.exchange(rows.mapInArrow(counting(pairs_of, lambda keys: range_of(mix(keys), n)), shared.PACKED), n)
    followers, triple_tally = None, np.zeros(5, np.int64)
    if order == 2:
        stored = written_once(counted_pairs.mapInArrow(keep_pairs, shared.PACKED), "neighbours")
    else:
        found = run(counted_pairs, keep_pairs)
        pairs = Ranges(f"{folder}/pairs", [found[i]["size"] if i in found else 0 for i in range(n)], pair_columns)
        word_bits = np.uint64(max(vocabulary.bit_length(), 1))
        word_mask = (np.uint64(1) << word_bits) - np.uint64(1)
        if max(pairs.sizes) >= 1 << 32:
            raise OverflowError("2^32 pairs or more in one range; use more shuffle partitions")
        small_number = np.uint16 if n <= 1 << 16 else np.int64  # sorted in one pass

        def triples_of(texts_):
            word, left, begin = numbers_of(texts_)
            keys, code = np.unique(pair_keys(left, word), return_inverse=True)
            home = range_of(keys, n)
            # A pair's place within its range and a word always fit into one number.
            here = (pairs.find(keys) - pairs.first[home]).astype(np.uint64) << word_bits
            inside = np.ones(len(word), bool)
            inside[begin] = False
            at = np.flatnonzero(inside)
            context = code[at - 1]
            return here[context] | word[at].astype(np.uint64), home.astype(small_number)[context]

        def pair_range(places):
            return np.searchsorted(pairs.first, places.astype(np.int64), "right") - 1

        def steps(places, b):
            """Sorted places of a range as steps, which compress well."""
            return np.diff(places.astype(np.int64), prepend=pairs.first[b])

        def triple_columns(keys, b):
            return {"step": np.diff((keys >> word_bits).astype(np.int64), prepend=0), "word": (keys & word_mask).astype(np.uint32)}

        def parts_of(batches):
            """All parts of each range; every range has one, if only an empty one."""
            out: dict[int, list] = {}
            for batch in batches:
                for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                    out.setdefault(b, []).extend([shared.unpack(blob)] if blob else [])
            return out.items()

        def keep_triples(batches):
            for number, parts in parts_of(batches):
                for c in parts:
                    c["key"] = (np.cumsum(c.pop("step")).astype(np.uint64) << word_bits) | c.pop("word")
                c = shared.joined(parts) or {"key": np.empty(0, np.uint64), "count": np.empty(0, np.int64)}
                keys, counts = counted(c["key"], c["count"].astype(np.int64))
                at, word = (keys >> word_bits).astype(np.int64), keys & word_mask
                if len(keys) >= 1 << 32:
                    raise OverflowError("2^32 triples or more in one range; use more shuffle partitions")
                saved(f"{folder}/triples", number, word=word.astype(np.uint32))
                saved_small(f"{folder}/triples", number, count=counts)
                size = pairs.sizes[number]
                saved(f"{folder}/pairs", number, begin=np.concatenate([[0], np.cumsum(np.bincount(at, minlength=size))]).astype(np.uint32))
                few = {f"n{k}": np.bincount(at[counts == k], minlength=size) for k in (1, 2)}
                saved_small(f"{folder}/pairs", number, **few)
                rows_out = [(0, 9, shared.pack(number=np.array([number]), size=np.array([len(keys)]), tally=np.array(tally(counts))))]
                if len(keys):
                    middle = pairs_of_keys(np.asarray(pairs.column(number, "key"))) & np.uint64(0xFFFFFFFF)
                    wanted, before = counted(pair_keys(middle[at], word))
                    place = pairs.find(wanted)
                    # A pair met once has one word before it.
                    more = np.flatnonzero(pairs.take("count", place) > 1)
                    place, before = place[more], before[more].astype(np.uint32)
                    for b, rows_of in shared.dealt(pair_range(place), n):
                        rows_out.append((b, 0, shared.pack(step=steps(place[rows_of], b), before=before[rows_of])))
                yield shared.packed_batch(rows_out)

        counted_triples = rows.mapInArrow(counting(triples_of, columns=triple_columns), shared.PACKED)
        told = written_once(shared.exchange(counted_triples.unionByName(every), n).mapInArrow(keep_triples, shared.PACKED), "middles")
        triple_sizes = [0] * n
        for r in told.filter("kind = 9").select("blob").collect():  # one short row for each range
            c = shared.unpack(bytes(r["blob"]))
            triple_sizes[int(c["number"][0])] = int(c["size"][0])
            triple_tally += c["tally"]
        followers = Followers(pairs, Ranges(f"{folder}/triples", triple_sizes, {"word": "<u4", "count": SMALL}))

        def keep_before(batches):
            for number, parts in parts_of(batches):
                if not pairs.sizes[number]:
                    continue
                count = pairs.small(number, "count")
                before = (count == 1).astype(np.int64)
                for c in parts:
                    before[np.cumsum(c["step"])] += c["before"]
                both = pairs_of_keys(np.asarray(pairs.column(number, "key")))
                # Nothing stands before a start context: its pairs keep their counts.
                before = np.where(both >> np.uint64(32) == vocabulary, count, before)
                saved_small(f"{folder}/pairs", number, before=before)
                order_ = np.argsort(both)
                yield shared.packed_batch(neighbours(number, both[order_], before[order_]))

        stored = written_once(shared.exchange(told.filter("kind = 0").unionByName(every), n).mapInArrow(keep_before, shared.PACKED), "neighbours")

    pair_sizes, pair_tally = [0] * n, np.zeros(5, np.int64)
    for r in stored.filter("kind = 9").select("blob").collect():  # one short row for each range
        c = shared.unpack(bytes(r["blob"]))
        pair_sizes[int(c["number"][0])] = int(c["size"][0])
        pair_tally += c["tally"]

    def keep_about(batches):
        found_blobs: dict[int, list] = {}
        for batch in batches:
            for b, kind, blob in zip(*(batch.column(k).to_pylist() for k in ("bucket", "kind", "blob"))):
                found_blobs.setdefault(b, []).append((kind, shared.unpack(blob) if blob else {}))
        for number, parts in found_blobs.items():
            size = int(first[number + 1] - first[number])
            columns = {k: np.zeros(size, np.int64) for k in ("before", "total", "n1", "n2", "n3")}
            for _, c in parts:
                for k in c:
                    if k != "word":
                        np.add.at(columns[k], c["word"] - first[number], c[k])
            saved(f"{folder}/about", number, **columns)
            yield stats_batch(number, size, int(columns["before"].sum()), tally(columns["before"]))

    about = run(shared.exchange(stored.filter("kind < 2").unionByName(every), n), keep_about)
    word_tally = np.sum([r["tally"] for r in about.values()], axis=0)
    kinds = sum(pair_sizes)
    word_discounts = discounts(word_tally)
    lost = word_discounts[1] * word_tally[0] + word_discounts[2] * word_tally[1] + word_discounts[3] * word_tally[4]
    return Model(
        words=words,
        pairs=Ranges(f"{folder}/pairs", pair_sizes, pair_columns),
        about=Ranges(f"{folder}/about", [int(x) for x in np.diff(first)], dict.fromkeys(("before", "total", "n1", "n2", "n3"), "<i8")),
        tokens=tokens,
        vocabulary=vocabulary,
        pair_discounts=discounts(pair_tally),
        word_discounts=word_discounts,
        kinds=kinds,
        rest=lost / kinds if kinds else 1.0,
        followers=followers,
        triple_discounts=discounts(triple_tally) if followers else None,
    )


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: key, tokens, known tokens, training tokens, base score, log10 probability, perplexity."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # names of files and a few numbers
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, sizes = token_hashes(binary(part.column("text")).to_pylist())
                known, base, total = held.value.score(hashes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(np.full(len(sizes), held.value.tokens), pa.int64()),
                        pa.array(base),
                        pa.array(total),
                        pa.array(10 ** np.minimum(-total / sizes, 300)),
                    ],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
    )
