"""Packing of whole documents into windows of equal length.

Tokens come from a given public tokenizer. A text is cut at places that the
tokenizer's own pattern always cuts (between an ASCII letter and a blank, a
punctuation mark or a digit), every distinct piece is encoded once, and the
ids are put together again, which gives the ids of the whole text. A worker
keeps up to ``CACHED`` encoded pieces; a full cache starts anew.

Windows: full windows of a document stand alone. What remains is cut into
pieces of at most ``PIECE`` tokens, and groups of about ``GROUP`` pieces are
divided by Karmarkar-Karp multiway differencing: the two partial partitions
with the largest imbalance are merged, the fullest bins of one with the
emptiest of the other, until one partition is left. Its bins are near-equal
windows. When one exceeds the capacity, the window count rises by one and the
group is divided again. Pieces that would leave a window part empty move on to
the next group; the last pieces of a task are cut at powers of two, which
stand without padding.

All of this happens within the tasks that read the documents: no shuffle, and
memory bounded by one group and one document.

Defined results: a null text is empty and has the end id alone. Rows without a
key are packed like others. Every input row is a document of its own, so
repeated rows are packed as often as they occur. Only key and text are read.
"""

from __future__ import annotations

import heapq
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.words import BLANKS, _translation, binary, slices, span_hashes, tidy

CAPACITY = 4096
PIECE = 256
GROUP = 1024
# Tokens left free in each window on average, and windows held back for a rising count.
ROOM = 8
SPARE = 4
END_ID = 2
CACHED = 1_000_000
SLICE_BYTES = 1 << 20

_LOWER = _translation(BLANKS, lower=True)
_BLANK, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _OTHER = range(6)
_KIND = bytearray([_OTHER] * 256)
_KIND[0x20] = _BLANK
for _b in range(0x21, 0x7F):
    _KIND[_b] = _LETTER if 97 <= _b < 123 else _DIGIT if 48 <= _b < 58 else _APOSTROPHE if _b == 39 else _MARK
_KINDS = bytes(_KIND)


def _always_cut(x: int, y: int) -> bool:
    """Whether the pattern cuts between characters of these kinds, whatever stands around them.

    An apostrophe before a letter may belong to a contraction and is no such place.
    """
    if _BLANK in (x, y):
        return x != y
    if _OTHER in (x, y):
        return False
    marks = (_MARK, _APOSTROPHE)
    return _DIGIT in (x, y) or (x == _LETTER and y in marks) or (x == _MARK and y == _LETTER)


_CUTS = np.zeros(64, bool)
for _x in range(6):
    for _y in range(6):
        _CUTS[_x * 8 + _y] = _always_cut(_x, _y)


def piece_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Spans between places where the tokenizer's pattern always cuts; blanks are left out."""
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = _CUTS[(kind[:-1] << 3) | kind[1:]]
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    kept = kind[starts] != _BLANK
    return starts[kept], ends[kept]


# Fixed value: the splitting pattern for which the cuts above hold.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_hold(path: str) -> bool:
    """Whether a tokenizer file lower-cases and splits by the known pattern."""
    with open(path, encoding="utf-8") as source:
        rules = json.load(source)
    normal, split = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
    steps = [s.get("type") for s in normal.get("normalizers", [normal])]
    patterns = [(s.get("pattern") or {}).get("Regex") for s in split.get("pretokenizers", [split])]
    return "Lowercase" in steps and patterns[:1] == [PIECE_PATTERN]


class Encoder:
    """Ids of whole texts by a tokenizer file; texts are cut and known pieces kept where its rules allow that."""

    def __init__(self, path: str):
        # Spark runs the tasks in parallel already; threads of the library's own only cost memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        self.cuts_hold = cuts_hold(path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.uint32)

    def learn(self, keys: np.ndarray, texts: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(size.sum()))
        known = len(self.keys)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, flat])
        every = np.concatenate([self.keys, keys])
        # Both parts are sorted, which a stable sort merges in one pass.
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.slot = np.concatenate([self.slot, known + np.arange(len(keys))])[order]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, without special tokens of the library's own."""
        if not self.cuts_hold or any(s in t for t in texts for s in self.special):
            whole = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, np.uint32) for e in whole]
        joined = b"\n".join(texts)
        clean = joined.translate(_LOWER)
        starts, ends = piece_spans(clean)
        hashes = span_hashes(np.frombuffer(clean, np.uint8), starts, ends)
        order = np.argsort(hashes)
        new_key = np.diff(hashes[order], prepend=~hashes[order][:1]) != 0
        keys, first = hashes[order][new_key], order[new_key]
        code = np.empty(len(order), np.int64)
        code[order] = np.cumsum(new_key) - 1
        if len(self.keys) + len(keys) > CACHED:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        if not known.all():
            spans = first[~known]
            # Spans are UTF-8 of whole characters, since all cuts are at ASCII bytes.
            texts_new = [clean[a:b].decode() for a, b in zip(starts[spans].tolist(), ends[spans].tolist())]
            self.learn(keys[~known], texts_new)
            at = np.searchsorted(self.keys, keys)
        slot = self.slot[at][code]
        where, size = self.first[slot], self.first[slot + 1] - self.first[slot]
        done = np.cumsum(size)
        ids = self.flat[np.repeat(where - (done - size), size) + np.arange(done[-1] if len(done) else 0)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text_end = np.cumsum(sizes + 1) - 1
        upto = np.searchsorted(starts, text_end)
        cuts = np.concatenate([[0], done])[upto]
        return np.split(ids, cuts[:-1]) if len(texts) else []


def differencing(sizes: list[int], bins: int) -> tuple[np.ndarray, int]:
    """Karmarkar-Karp: the bin of each size, and the sum of the fullest bin."""
    left: list[int] = []
    right: list[int] = []
    n = len(sizes)
    heap = [(-s, i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, a, a_node = heapq.heappop(heap)
        _, _, b, b_node = heapq.heappop(heap)
        # Sums in descending order; bins beyond the arrays are empty. a's bins meet b's in reverse.
        b, b_node = b[::-1], b_node[::-1]
        over = max(0, len(a) + len(b) - bins)
        if over:
            alone = len(a) - over
            node = np.arange(n + len(left), n + len(left) + over)
            left.extend(a_node[alone:].tolist())
            right.extend(b_node[:over].tolist())
            sums = np.concatenate([a[:alone], a[alone:] + b[:over], b[over:]])
            nodes = np.concatenate([a_node[:alone], node, b_node[over:]])
        else:
            sums, nodes = np.concatenate([a, b]), np.concatenate([a_node, b_node])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0] - (sums[-1] if len(sums) == bins else 0))
        heapq.heappush(heap, (-spread, count, sums, nodes))
        count += 1
    _, _, sums, nodes = heap[0]
    home = np.full(n + len(left), -1, np.int64)
    home[nodes] = np.arange(len(nodes))
    for k in range(len(left) - 1, -1, -1):
        home[left[k]] = home[right[k]] = home[n + k]
    return home[:n], int(sums[0])


class Packer:
    """Pieces of one task in, rows of packed pieces out."""

    COLUMNS = ("doc", "start", "length", "ids", "doc_tokens", "sequence", "offset")

    def __init__(self, first_sequence: int, capacity: int, piece: int, group: int):
        self.next = first_sequence
        self.capacity, self.piece, self.group = capacity, piece, group
        self.pending: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            self.emit([(doc, start, ids[start : start + self.capacity], n)])
        for start in range(whole, n, self.piece):
            self.pending.append((doc, start, ids[start : start + self.piece], n))
        if len(self.pending) >= self.group:
            self.divide()

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), n, self.next, offset))
            offset += len(ids)
        self.next += 1

    def divide(self) -> None:
        """Divides the pending pieces; those that would leave a window part empty stay pending.

        Each time that capacity is exceeded the window count rises by one, and the
        new window takes further pieces, but leaves more room in all windows.
        """
        upto = np.cumsum([len(p[2]) for p in self.pending])
        bins, room, used = max(0, int(upto[-1]) // self.capacity - SPARE) if len(upto) else 0, min(ROOM, self.capacity // 512), 0
        while True:
            used = max(used, int(np.searchsorted(upto, bins * (self.capacity - room), "right")))
            if not used:
                if bins * self.capacity >= (upto[-1] if len(upto) else 0):
                    return
                bins += 1
                continue
            home, fullest = differencing([len(p[2]) for p in self.pending[:used]], bins)
            if fullest <= self.capacity:
                break
            bins, room = bins + 1, min(room + ROOM // 2, self.capacity // 2)
        windows: list[list] = [[] for _ in range(bins)]
        for piece, w in zip(self.pending[:used], home.tolist()):
            windows[w].append(piece)
        self.pending = self.pending[used:]
        for window in windows:
            if window:
                self.emit(window)

    def finish(self) -> None:
        """Divides what is left, then cuts the rest at powers of two."""
        while len(self.pending) > self.capacity // self.piece * SPARE * 2:
            self.divide()
        rest = sum(len(p[2]) for p in self.pending)
        queue = self.pending[::-1]
        self.pending = []
        while rest:
            room = min(1 << (rest.bit_length() - 1), 1 << (self.capacity.bit_length() - 1))
            window = []
            rest -= room
            while room:
                doc, start, ids, n = queue.pop()
                if len(ids) > room:
                    queue.append((doc, start + room, ids[room:], n))
                    ids = ids[:room]
                window.append((doc, start, ids, n))
                room -= len(ids)
            self.emit(window)


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32 bit), document tokens, sequence, offset.

    Sequence ids are unique over all tasks; a task numbers its own.
    """
    if piece > capacity // 2:
        raise ValueError("a piece may have at most half of a window's tokens")
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    @tidy
    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, piece, group)
        # One for each task, so that idle workers do not keep it.
        encode = Encoder(tokenizer).encode
        end = np.array([end_id], np.uint32)
        doc_type = None

        def rows(packed):
            columns = list(zip(*packed))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d.as_py() for d in columns[0]], doc_type),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.binary()),
                    pa.array(columns[4], pa.int64()),
                    pa.array(columns[5], pa.int64()),
                    pa.array(columns[6], pa.int64()),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text", SLICE_BYTES):
                for doc, ids in zip(part.column("doc_id"), encode(binary(part.column("text")).to_pylist())):
                    packer.add(doc, np.concatenate([ids, end]))
                if packer.rows:
                    yield rows(packer.rows)
                    packer.rows = []
        packer.finish()
        if packer.rows:
            yield rows(packer.rows)

    schema = (
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return chosen.mapInArrow(run, schema)


def piece_report(packed: DataFrame) -> DataFrame:
    """The digest of :func:`pack`: a checksum in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
