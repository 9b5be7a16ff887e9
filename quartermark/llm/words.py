"""Words of whole texts as numpy arrays, for the operators that run inside Arrow tasks.

Texts are handled as UTF-8 bytes. Every word pattern used here splits at ASCII
bytes only, so no character is ever cut. A task walks its rows in slices of a
few megabytes; only a single text longer than that makes a slice larger.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20

# Fixed values of the word patterns: blanks, and everything that is not a digit, a-z or above ASCII.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NO_LETTERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_BASE = 0x9E3779B97F4A7C15 | 5
_HASH_BYTES = 1 << 20


def _translation(separators: bytes, lower: bool) -> bytes:
    table = bytearray(range(256))
    if lower:
        for upper in range(0x41, 0x5B):
            table[upper] = upper + 32
    kept = bytes(table)
    return bytes(0x20 if kept[b] in separators else kept[b] for b in range(256))


BLANK_WORDS = _translation(BLANKS, lower=False)
BLANK_WORDS_LOWER = _translation(BLANKS, lower=True)
LETTER_WORDS_LOWER = _translation(NO_LETTERS, lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"], _TABLES["down"] = powers(n), powers(n, _INVERSE)
    return _TABLES["up"], _TABLES["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that lie in ascending order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + _HASH_BYTES, "right")))
        size = int(ends[to - 1] - first)
        up, down = _tables(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[first : first + size]] * up[:size], out=total[1:])
        a, b = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return mix(out)


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; the caller masks runs across texts."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x2545F4914F6CDD1D) + word_hashes[k : k + n]
        total ^= total >> np.uint64(29)
    return mix(total)


def give_back() -> None:
    """Returns memory that is free but still held by the allocators of this process to the system."""
    _TABLES.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that leaves nothing behind: Python workers live on, idle, beside those of later stages."""

    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def binary(column: pa.Array) -> pa.Array:
    """A text column as bytes without nulls; null is empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return pc.fill_null(column, b"")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES):
    """Consecutive pieces of a batch with at most ``max_bytes`` of text, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < len(total):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of several texts: byte spans in ``data`` and the range of each text's words."""

    def __init__(self, texts: list[bytes], table: bytes):
        joined = b"\n".join(texts)
        clean = joined.translate(table)
        self.data = np.frombuffer(clean, np.uint8)
        self.raw = joined
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(sizes + 1)])[: len(texts)]
        self.text_ends = self.text_starts + sizes
        # A line feed between texts is a separator in every table above.
        inside = self.data != 0x20
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.last = np.searchsorted(self.starts, self.text_ends)
        self.counts = self.last - self.first

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def room(self) -> np.ndarray:
        """For each word, how many words of its text begin at it or later."""
        return np.repeat(self.last, self.counts) - np.arange(len(self.starts))

    def owner(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run; runs may overlap and repeat."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:n]) > 0


def keep_rows(docs: DataFrame, text: str, masks: Callable[[], Callable[[list[bytes]], np.ndarray]]) -> DataFrame:
    """``docs`` with the rows whose text a mask keeps; all columns stay, whatever their names.

    ``masks`` runs once in each task and gives the function that decides on a slice of texts.
    """
    names, place = docs.columns, docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    @tidy
    def run(batches):
        mask = masks()
        for batch in batches:
            for part in slices(batch, f"c{place}"):
                yield part.filter(pa.array(mask(binary(part.column(place)).to_pylist())))

    return plain.mapInArrow(run, plain.schema).toDF(*names)
