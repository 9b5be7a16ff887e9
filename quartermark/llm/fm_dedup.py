"""Removal of repeated word strings by compressed full-text indexes.

A word is removed if a window of ``WINDOW`` consecutive words that covers it
also starts in a document with a smaller id. Only runs of windows whose anchor
occurs elsewhere are looked at (:mod:`quartermark.llm.shared`). They are dealt
to shards by anchor. Each shard builds an FM-index of its distinct texts: the
Burrows-Wheeler transform as a wavelet matrix of packed bit vectors with
counts per 64 bits, and the texts' document ids in suffix order as another one.
Texts and suffix array are not part of it. The texts then stream against it:
backward search gives for each place the longest string ending there, up to a
window, that the shard holds at another place as well (the matching
statistics). Places that reach a window report their interval; the smallest
document id in it, found by one descent of the second matrix, decides. An anchor
too frequent for one shard has several; windows they keep are merged by two
hashes.

Defined results: a null text has no words. Rows without an id come after all
others and are no reason to remove from one another. Rows that share an id are
one document in this respect. Every input row gives one row. Only id and text
are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.suffix_arrays import suffix_array, with_sentinels
from quartermark.llm.suffix_dedup import kept_ranges, sliding_minimum
from quartermark.llm.words import BLANK_WORDS, Words, binary, mix, shingles, slices, tidy
from quartermark.session import written_once

WINDOW = 13
GRAM = 4
SHARD_BYTES = 1 << 20


def word_runs(texts: list[bytes], window: int = WINDOW) -> dict:
    """Runs of windows with one anchor; see :func:`shared.shared_runs`."""
    found = Words(texts, BLANK_WORDS)
    grams = shingles(found.hashes(), GRAM)
    width = window - GRAM + 1
    n = np.maximum(found.counts - window + 1, 0)
    valid = np.repeat(found.first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    owner = np.repeat(np.arange(len(n)), n)
    anchor = sliding_minimum(grams, width)[valid] if len(valid) else np.empty(0, np.uint64)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1 if len(first) else first
    text = owner[first]
    return {
        "text": text,
        "anchor": anchor[first],
        "first": (valid[first] - found.first[text]).astype(np.int32),
        "last": (valid[last] - found.first[text]).astype(np.int32),
        # Repeats within one document remove nothing.
        "again": np.zeros(len(first), bool),
    }


class WaveletMatrix:
    """A sequence of integers as one packed bit vector for each bit, with counts per 64 bits."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(values.max()).bit_length()) if self.n else 1
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(self.n - int(ones.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def ones(self, level: int, upto: np.ndarray) -> np.ndarray:
        """How many bits of a level are set before each place."""
        word = upto >> 6
        below = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def descend(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Where the occurrences of each symbol before each place end, in the order of the last level."""
        at = upto
        for level in range(self.bits):
            ones = self.ones(level, at)
            bit = (symbols >> (self.bits - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest value in each interval; intervals are not empty."""
        value = np.zeros(len(low), np.int64)
        for level in range(self.bits):
            before, upto = self.ones(level, low), self.ones(level, high)
            one = high - upto == low - before  # no value with a 0 here is left
            low = np.where(one, self.zeros[level] + before, low - before)
            high = np.where(one, self.zeros[level] + upto, high - upto)
            value = (value << 1) | one
        return value


class Index:
    """FM-index of separate texts of word numbers (1 or more), each text with a mark (0 or more).

    Kept are the Burrows-Wheeler transform and the marks in suffix order, both as
    wavelet matrices, and one number for each symbol. Neither the texts nor the
    suffix array are.
    """

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, marks: np.ndarray):
        text, first, ends = with_sentinels(numbers, sizes)
        order, _ = suffix_array(text, first, ends)
        self.n = len(text)
        self.transform = WaveletMatrix(text[order - 1])
        counts = np.bincount(text)
        # A step back goes to the symbol's first suffix, plus its occurrences before the place.
        every = np.arange(len(counts))
        self.shift = np.cumsum(counts) - counts - self.transform.descend(every, np.zeros(len(every), np.int64))
        self.marks = WaveletMatrix(np.repeat(marks, sizes + 1)[order])

    def statistics(self, numbers: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search for the windows at some places of a stream of the index's own texts.

        Gives the length of the longest end of each window that occurs elsewhere
        too, and for those of full length their interval (else an empty one).
        """
        length = np.zeros(len(places), np.int64)
        low, high = np.zeros(len(places), np.int64), np.full(len(places), self.n, np.int64)
        live = np.arange(len(places))
        a, b = low.copy(), high.copy()
        for k in range(window - 1, -1, -1):
            symbol = numbers[places[live] + k]
            reached = self.transform.descend(np.concatenate([symbol, symbol]), np.concatenate([a, b]))
            shift = self.shift[symbol]
            a, b = shift + reached[: len(live)], shift + reached[len(live) :]
            more = b - a > 1  # one place alone is the window itself
            live, a, b = live[more], a[more], b[more]
            length[live] += 1
        high[:] = 0
        low[live], high[live] = a, b
        return length, low, high


def smallest(shard: dict, window: int = WINDOW):
    """The smallest rank that each window of each segment has within the shard.

    Gives segment, place in it, smallest rank and two hashes, for every window.
    """
    data, at, size = shard["data"], shard["start"], shard["size"]
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(data[a : a + s].tobytes(), len(number)) for a, s in zip(at.tolist(), size.tolist())], np.int64)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, which, shard["rank"])
    found = Words(list(number), BLANK_WORDS)
    hashes = found.hashes()
    _, numbers = np.unique(hashes, return_inverse=True)
    numbers = numbers.astype(np.int64) + 1
    levels, marks = np.unique(least, return_inverse=True)
    index = Index(numbers, found.counts, marks)
    n = found.counts - window + 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    string = np.repeat(np.arange(len(n)), n)
    where = np.repeat(found.first, n) + inside
    length, low, high = index.statistics(numbers, where, window)
    value = least[string]
    full = np.flatnonzero(length == window)
    if len(full):
        start, one, back = np.unique(low[full], return_index=True, return_inverse=True)
        value[full] = levels[index.marks.least(start, high[full][one])][back]
    h1, h2 = (shingles(h, window)[where] for h in (hashes, mix(hashes ^ np.uint64(0xA24BAED4963EE407))))
    # Every segment has the windows of its text.
    edges = np.append(np.cumsum(n) - n, len(string))
    count = n[which]
    entry = np.repeat(edges[which], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return np.repeat(np.arange(len(which)), count), inside[entry], value[entry], h1[entry], h2[entry]


def runs_of(mask: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values within one segment."""
    edge = np.ones(len(mask), bool)
    edge[1:] = segment[1:] != segment[:-1]
    before = np.append(False, mask[:-1])
    after = np.append(mask[1:], False)
    return np.flatnonzero(mask & (edge | ~before)), np.flatnonzero(mask & (np.append(edge[1:], True) | ~after))


def repeated_spans(shared_rows: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(rk1, rk2, spans) of the words to remove; ``shared_rows`` has doc_id as well."""
    n = shared.partitions(shared_rows)

    def cut(text, first, last):
        words = text.split()
        return [b" ".join(words[a : b + window]) for a, b in zip(first.tolist(), last.tolist())]

    @tidy
    def work(batches):
        for shard, wide in shared.shards(batches, shard_bytes):
            segment, place, value, h1, h2 = smallest(shard, window)
            rank = shard["rank"][segment]
            start = shard["first"].astype(np.int64)[segment] + place
            gone = value < rank
            a, b = runs_of(gone, segment)
            who = segment[a]
            rows = shared.span_rows(n, shard["rk1"][who], shard["rk2"][who], start[a], start[b] + window)
            open_windows = np.flatnonzero(wide[segment] & ~gone)
            for bucket, at in shared.dealt(shared.buckets_of(h1[open_windows], n), n):
                at = open_windows[at]
                who = segment[at]
                rows.append(
                    (bucket, 1, shared.pack(h1=h1[at], h2=h2[at], rank=rank[at], rk1=shard["rk1"][who], rk2=shard["rk2"][who], start=start[at]))
                )
            yield shared.packed_batch(rows)

    @tidy
    def merge(batches):
        parts = [shared.unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if not parts:
            return
        c = shared.joined(parts)
        order = np.lexsort((c["rank"], c["h2"], c["h1"]))
        c = {k: v[order] for k, v in c.items()}
        new = np.ones(len(order), bool)
        new[1:] = (c["h1"][1:] != c["h1"][:-1]) | (c["h2"][1:] != c["h2"][:-1])
        least = c["rank"][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        gone = np.flatnonzero(c["rank"] > least)
        if len(gone):
            yield shared.packed_batch(
                shared.span_rows(n, c["rk1"][gone], c["rk2"][gone], c["start"][gone], c["start"][gone] + window)
            )

    worked = written_once(shared.segments(shared_rows, cut, "doc_id").mapInArrow(work, shared.PACKED), "repeats")
    merged = shared.exchange(worked.filter("kind = 1"), n).mapInArrow(merge, shared.PACKED)
    return shared.by_document(worked.filter("kind = 0").unionByName(merged))


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, rk1, rk2, text, spans) of every row; spans are null where nothing goes."""
    rows = shared.keyed(docs, key, text)
    places = shared.shared_runs(rows, lambda texts: word_runs(texts, window))
    found = rows.join(places, ["rk1", "rk2"]).select("doc_id", "rk1", "rk2", "text", "places")
    return rows.join(repeated_spans(found, window), ["rk1", "rk2"], "left")


def kept_words(text: bytes, blob: bytes | None) -> tuple[int, int, list[bytes], list[dict]]:
    """Word count, removed words, the words that stay and the removed spans."""
    words = text.split()
    if not blob:
        return len(words), 0, words, []
    spans = shared.unpack(blob)
    kept = [w for a, b in kept_ranges(len(words), spans["start"], spans["end"]) for w in words[a:b]]
    removed = [{"start": a, "end": b} for a, b in zip(spans["start"].tolist(), spans["end"].tolist())]
    return len(words), len(words) - len(kept), kept, removed


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: key, words, removed words, the kept words' checksum, and the removed spans."""
    rows = with_spans(docs, key, text, window).select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    @tidy
    def report(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for raw, blob in zip(binary(part.column("text")).to_pylist(), part.column("spans").to_pylist()):
                    total, gone, kept, removed = kept_words(raw, blob)
                    out.append((total, gone, hashlib.sha256(b" ".join(kept)).hexdigest(), removed))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
                )

    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, removed array<struct<start: long, end: long>>"
    return rows.mapInArrow(report, schema)


def rewrite(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated words taken out of the text; rows that lose all their words go.

    Texts that lose nothing stay as they are. Other columns are unchanged.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(key)}", f"c{names.index(text)}"
    keyed = plain.withColumns({"k1": F.xxhash64(key, F.coalesce(text, F.lit(""))), "k2": F.hash(F.coalesce(text, F.lit("")), key)})
    spans = with_spans(plain, key, text, window).filter("spans IS NOT NULL").select("rk1", "rk2", "spans").distinct()
    found = keyed.join(spans, (F.col("k1") == F.col("rk1")) & (F.col("k2") == F.col("rk2")), "left")
    found = found.select(*plain.columns, "spans")
    columns_out, place = plain.columns, plain.columns.index(text)

    @tidy
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                column, kept = part.column(place), np.ones(part.num_rows, bool)
                texts = column.to_pylist()
                for i, blob in enumerate(part.column("spans").to_pylist()):
                    if blob:
                        _, gone, words, _ = kept_words(texts[i].encode(), blob)
                        texts[i], kept[i] = b" ".join(words).decode(), bool(words)
                columns = [pa.array(texts, column.type) if i == place else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, columns_out).filter(pa.array(kept))

    return found.mapInArrow(run, plain.schema).toDF(*names)
