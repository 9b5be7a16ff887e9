"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``WINDOW`` consecutive words; an item of
fewer words is one window. The shingles of a window (``SHINGLE`` words) are
ordered by rarity, counted over all documents. A window is contained whole, so
all its shingles have to occur and its necessary prefix is the rarest one. A
document shingle that equals it gives one candidate start, which is kept if
the window lies within the document (length and position) and all its words
agree in order.

Documents never shuffle, and the benchmark does not pass through the driver.
Tasks cut it into blocks of about ``BLOCK_WORDS`` words (long items are cut
into pieces that overlap by a window) and write each block as sorted arrays in
the shared folder. Two passes over the documents follow, however many blocks
there are: one counts the shingles, one marks the windows. A task walks each
slice of its rows along the blocks and keeps ``OPEN_BLOCKS`` of them open,
memory-mapped where the folder is mounted.

Defined results: null and blank texts have no words, are never hit and give
no windows. Items with a null id still mark words, but are not listed. Items
of equal id count once. Every document row gives one row, repeated rows too.
Columns other than the key and the text are not read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.files import Writer, array_at
from quartermark.llm.words import LETTER_WORDS_LOWER, Words, binary, covered, keep_rows, shingles, slices, tidy
from quartermark.session import shared_dir, written_once

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 2_000_000
PIECE_WINDOWS = 50_000
OPEN_BLOCKS = 4
FLUSH_PLACES = 1_000_000

PIECES = "item string, n_words long, words binary"


def item_pieces(
    benchmark: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text", windows: int = PIECE_WINDOWS
) -> DataFrame:
    """Word hashes of every item that has words; consecutive pieces of an item share all but one word of a window."""

    @tidy
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = Words(binary(part.column("text")).to_pylist(), LETTER_WORDS_LOWER)
                hashes, items = found.hashes(), part.column("item").to_pylist()
                for i in np.flatnonzero(found.counts):
                    first, last = found.first[i], found.last[i]
                    for start in range(first, max(first + 1, last - window + 1), windows):
                        words = hashes[start : min(last, start + windows + window - 1)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([items[i]], pa.string()),
                                pa.array([len(words)], pa.int64()),
                                pa.array([words.tobytes()], pa.binary()),
                            ],
                            ["item", "n_words", "words"],
                        )

    chosen = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES).distinct()


class Block:
    """Windows of one bounded block of item pieces, by size."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, window: int, shingle: int):
        self.words = words
        first = np.cumsum(sizes) - sizes
        n = np.maximum(sizes - window, 0) + 1
        self.owner = np.repeat(np.arange(len(sizes)), n)
        self.start = np.repeat(first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        self.size = np.minimum(np.repeat(sizes, n), window)
        self.shingle = np.minimum(self.size, shingle)

    def tokens(self):
        """Shingle size, window numbers and the shingles of each, in columns."""
        for size, words in sorted({(int(a), int(b)) for a, b in zip(self.shingle, self.size)}):
            chosen = np.flatnonzero((self.shingle == size) & (self.size == words))
            every = shingles(self.words, size)
            yield size, chosen, every[self.start[chosen][:, None] + np.arange(words - size + 1)]

    def keys(self) -> dict[int, np.ndarray]:
        """By shingle size: the distinct shingles of all windows."""
        found: dict[int, list] = {}
        for size, _, grid in self.tokens():
            found.setdefault(size, []).append(np.unique(grid))
        return {size: np.unique(np.concatenate(parts)) for size, parts in found.items()}

    def rarest(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, ...]]:
        """By shingle size: sorted prefix shingles, their windows and places in them."""
        found: dict[int, list] = {}
        for size, chosen, grid in self.tokens():
            known, often = counts.get(size, (np.empty(0, np.uint64), np.empty(0, np.int64)))
            rarity = np.zeros(grid.shape, np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, grid), len(known) - 1)
                rarity = np.where(known[at] == grid, often[at], 0)
            place = rarity.argmin(axis=1)
            found.setdefault(size, []).append((grid[np.arange(len(grid)), place], chosen, place))
        out = {}
        for size, parts in found.items():
            key, chosen, place = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(key, kind="stable")
            out[size] = (key[order], chosen[order], place[order])
        return out


class Filter:
    """Membership in a sorted key list, with a bitmap that turns most values away."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bitmap = np.zeros(1 << self.BITS, bool)
        self.bitmap[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        """Indexes of the values that are in the list."""
        if not len(self.keys):
            return np.empty(0, np.int64)
        maybe = np.flatnonzero(self.bitmap[(values >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.searchsorted(self.keys, values[maybe])
        return maybe[self.keys[np.minimum(at, len(self.keys) - 1)] == values[maybe]]


class StoredKeys:
    """The shingles of one written block, by size."""

    def __init__(self, folder: str, number: int, sizes: int):
        named = {size: array_at(f"{folder}/keys{size}-{number:05d}", "<u8") for size in range(1, sizes + 1)}
        self.filters = {size: Filter(keys) for size, keys in named.items() if len(keys)}


class StoredBlock:
    """One written block: words, windows, items and, by shingle size, the prefixes with their filters."""

    def __init__(self, folder: str, number: int, sizes: int):
        def column(name: str, kind: str) -> np.ndarray:
            return array_at(f"{folder}/{name}-{number:05d}", kind)

        self.words = column("words", "<u8")
        self.start, self.size, self.owner = (column(name, "<i4") for name in ("start", "size", "owner"))
        self.items = json.loads(column("items", "u1").tobytes() or b"[]")
        self.prefixes, self.filters = {}, {}
        for size in range(1, sizes + 1):
            keys = column(f"prefix{size}", "<u8")
            if len(keys):
                self.prefixes[size] = (keys, column(f"window{size}", "<i4"), column(f"place{size}", "<i4"))
                self.filters[size] = Filter(np.unique(keys))


class Blocks:
    """The written blocks, one after another; the first ``OPEN_BLOCKS`` stay open in a task."""

    def __init__(self, folder: str, n: int, sizes: int, kind=StoredBlock):
        self.folder, self.n, self.sizes, self.kind = folder, n, sizes, kind
        self.open: dict[int, object] = {}

    def __iter__(self):
        for number in range(self.n):
            block = self.open.get(number) or self.kind(self.folder, number, self.sizes)
            if number < OPEN_BLOCKS:
                self.open[number] = block
            yield block


def _write(folder: str, name: str, number: int, values: np.ndarray) -> None:
    out = Writer(folder, f"{name}-{number:05d}")
    out.write(values.tobytes())
    out.close()


def _by_block(batches):
    """Packed values of each block, by kind."""
    found: dict[int, dict[int, list]] = {}
    for batch in batches:
        for b, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "blob"))):
            found.setdefault(b, {}).setdefault(kind, []).append(shared.unpack(blob))
    return found.items()


def _block_of(parts: list[dict], window: int, shingle: int) -> tuple[Block, list]:
    c = shared.joined(parts)
    items = [item for p in parts for item in json.loads(p["items"])]
    return Block(c["sizes"], c["words"], window, shingle), items


def packed_pieces(pieces: DataFrame, n: int) -> DataFrame:
    """Item pieces as packed rows of their block, kind 0."""

    @tidy
    def run(batches):
        for batch in batches:
            sizes = batch.column("n_words").to_numpy()
            words, items = batch.column("words").to_pylist(), batch.column("item").to_pylist()
            block = batch.column("block").to_numpy()
            for b, rows in shared.dealt(block, n):
                blob = shared.pack(
                    sizes=sizes[rows],
                    words=np.frombuffer(b"".join(words[i] for i in rows), np.uint64),
                    items=json.dumps([items[i] for i in rows]).encode(),
                )
                yield shared.packed_batch([(b, 0, blob)])

    block = F.pmod(F.xxhash64("item", "words"), F.lit(n)).cast("int").alias("block")
    return pieces.select("*", block).mapInArrow(run, shared.PACKED)


def shingle_counts(docs: DataFrame, folder: str, n: int, sizes: int, text: str) -> DataFrame:
    """How often the shingles of each block occur in all documents, as packed rows of the block; the kind is the size."""

    @tidy
    def count(batches):
        blocks = Blocks(folder, n, sizes, StoredKeys)
        waiting: dict[tuple[int, int], list] = {}
        places = 0

        def rows():
            for (number, size), parts in waiting.items():
                shingle, often = np.unique(np.concatenate(parts), return_counts=True)
                same = [np.full(len(shingle), x, np.int32) for x in (number, size)]
                columns = [*map(pa.array, same), pa.array(shingle.view(np.int64)), pa.array(often.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "size", "shingle", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                found = Words(binary(part.column("text")).to_pylist(), LETTER_WORDS_LOWER)
                hashes, room = found.hashes(), found.room()
                values = {size: shingles(hashes, size) for size in range(1, sizes + 1)}
                for number, block in enumerate(blocks):
                    for size, kept in block.filters.items():
                        at = kept.places(values[size])
                        at = at[room[at] >= size]
                        if len(at):
                            waiting.setdefault((number, size), []).append(values[size][at])
                            places += len(at)
                if places >= FLUSH_PLACES:
                    yield from rows()
                    waiting, places = {}, 0
        yield from rows()

    @tidy
    def packed(batches):
        for batch in batches:
            block, size, shingle, often = (batch.column(c).to_numpy() for c in ("block", "size", "shingle", "n"))
            for b, at in shared.dealt(block, n):
                for s in np.unique(size[at]):
                    rows = at[size[at] == s]
                    blob = shared.pack(shingle=shingle[rows].view(np.uint64), n=often[rows])
                    yield shared.packed_batch([(b, int(s), blob)])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        count, "block int, size int, shingle long, n long"
    )
    return found.groupBy("block", "size", "shingle").agg(F.sum("n").alias("n")).mapInArrow(packed, shared.PACKED)


def write_blocks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_words: int = BLOCK_WORDS,
) -> tuple[str, int]:
    """Writes the benchmark in blocks with the rarest shingle of each window; the folder and the number of blocks."""
    folder = shared_dir(docs.sparkSession, "benchmark-blocks")
    pieces = written_once(item_pieces(benchmark, window), "benchmark-pieces")
    total = pieces.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    n = -(-total // block_words)
    if not n:
        return folder, 0
    rows = written_once(packed_pieces(pieces, n), "benchmark-packed")
    sizes = min(window, shingle)

    @tidy
    def keys(batches):
        for number, kinds in _by_block(batches):
            found = _block_of(kinds[0], window, shingle)[0].keys()
            for size in range(1, sizes + 1):
                _write(folder, f"keys{size}", number, found.get(size, np.empty(0, np.uint64)))
            yield shared.packed_batch([(number, 0, b"")])

    @tidy
    def blocks(batches):
        for number, kinds in _by_block(batches):
            block, items = _block_of(kinds.pop(0), window, shingle)
            counts = {}
            for size, parts in kinds.items():
                c = shared.joined(parts)
                order = np.argsort(c["shingle"])
                counts[size] = (c["shingle"][order], c["n"][order])
            prefixes = block.rarest(counts)
            for size in range(1, sizes + 1):
                columns = prefixes.get(size, (np.empty(0, np.uint64), np.empty(0), np.empty(0)))
                for name, values, kind in zip(("prefix", "window", "place"), columns, ("<u8", "<i4", "<i4")):
                    _write(folder, f"{name}{size}", number, values.astype(kind))
            for name in ("start", "size", "owner"):
                _write(folder, name, number, getattr(block, name).astype("<i4"))
            _write(folder, "items", number, np.frombuffer(json.dumps(items).encode(), np.uint8))
            _write(folder, "words", number, block.words)
            yield shared.packed_batch([(number, 0, b"")])

    # Blocks that no piece falls into are written too, empty.
    missing = docs.sparkSession.range(n).selectExpr("CAST(id AS INT) AS bucket", "0 AS kind").withColumn(
        "blob", F.lit(shared.pack(sizes=np.empty(0, np.int64), words=np.empty(0, np.uint64), items=b"[]"))
    )
    rows = rows.unionByName(missing)
    shared.exchange(rows, n).mapInArrow(keys, shared.PACKED).agg(F.count("bucket")).first()
    counted = shingle_counts(docs, folder, n, sizes, text)
    shared.exchange(rows.unionByName(counted), n).mapInArrow(blocks, shared.PACKED).agg(F.count("bucket")).first()
    return folder, n


def contained(found: Words, hashes: np.ndarray, block: StoredBlock) -> tuple[np.ndarray, np.ndarray]:
    """Starts of contained windows among the words of several texts, and the window numbers."""
    room, texts_first = found.room(), np.repeat(found.first, found.counts)
    starts, windows = [], []
    for size, (keys, chosen, place) in block.prefixes.items():
        values = shingles(hashes, size)
        at = block.filters[size].places(values)
        low, high = np.searchsorted(keys, values[at], "left"), np.searchsorted(keys, values[at], "right")
        n = high - low
        # Copies of one window within the benchmark are few runs of equal keys.
        entry = np.repeat(low, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        start, window = np.repeat(at, n) - place[entry], chosen[entry]
        fits = (start >= np.repeat(texts_first[at], n)) & (start >= 0)
        start, window = start[fits], window[fits]
        fits = block.size[window] <= room[start]
        start, window = start[fits], window[fits]
        for words in np.unique(block.size[window]):
            same = np.flatnonzero(block.size[window] == words)
            alive = same
            for k in range(int(words)):
                alive = alive[hashes[start[alive] + k] == block.words[block.start[window[alive]] + k]]
            starts.append(start[alive])
            windows.append(window[alive])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(windows)


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document row: key, word count, a byte per word (1: hit) and the items whose windows occur."""
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    folder, n = write_blocks(docs, benchmark, text, window, shingle, block_words)
    sizes = min(window, shingle)

    @tidy
    def run(batches):
        blocks = Blocks(folder, n, sizes)
        for batch in batches:
            for part in slices(batch, "text"):
                found = Words(binary(part.column("text")).to_pylist(), LETTER_WORDS_LOWER)
                hashes = found.hashes()
                hit = np.zeros(len(found.starts), bool)
                listed: list[set] = [set() for _ in range(part.num_rows)]
                for block in blocks if len(found.starts) else ():
                    start, number = contained(found, hashes, block)
                    hit |= covered(start, block.size[number], len(found.starts))
                    texts = np.searchsorted(found.last, start, "right")
                    pairs = np.unique(np.stack([texts, block.owner[number]], axis=1), axis=0)
                    for t, item in pairs.tolist():
                        if block.items[item] is not None:
                            listed[t].add(block.items[item])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_words": pa.array(found.counts, pa.int64()),
                        "hits": pa.array([hit[a:b].tobytes() for a, b in zip(found.first, found.last)], pa.binary()),
                        "items": pa.array([sorted(x) for x in listed], pa.list_(pa.string())),
                    }
                )

    return chosen.mapInArrow(run, f"doc_id {kind}, n_words long, hits binary, items array<string>")


def hit_report(marked: DataFrame) -> DataFrame:
    """The digest of :func:`mark_hits` per document row."""
    kind = marked.schema["doc_id"].dataType.simpleString()

    @tidy
    def run(batches):
        for batch in batches:
            hits = [x.count(1) if x else 0 for x in batch.column("hits").to_pylist()]
            items = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array(hits, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
                    pa.array([n > 0 for n in hits], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    schema = (
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )
    return marked.select("doc_id", "n_words", "hits", "items").mapInArrow(run, schema)


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without the rows in which an item window occurs; columns unchanged."""
    folder, n = write_blocks(docs, benchmark, text, block_words=block_words)

    def masks():
        blocks = Blocks(folder, n, min(WINDOW, SHINGLE))

        def clean(texts):
            found = Words(texts, LETTER_WORDS_LOWER)
            kept = np.ones(len(texts), bool)
            hashes = found.hashes()
            for block in blocks if len(found.starts) else ():
                start, _ = contained(found, hashes, block)
                kept[np.searchsorted(found.last, start, "right")] = False
            return kept

        return clean

    return keep_rows(docs, text, masks)
