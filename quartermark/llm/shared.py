"""Places that texts share: what the two substring operators have in common.

A window of fixed length is represented by the smallest hash among the short
strings inside it (its anchor), so equal windows have equal anchors, and
consecutive windows with the same anchor form a run. :func:`shared_runs` keeps
the runs whose anchor occurs elsewhere, :func:`exchange` moves packed rows to
numbered partitions, :func:`segments` deals the texts of the runs to shards by
anchor, and :func:`by_document` gathers spans found there.

Nothing depends on one key being small. A task settles anchors that it meets
twice itself and tells the others of them by one row. An anchor that is
frequent in one task is not sent to its home shard but dealt out as a shard of
its own, with a notice to the home shard; windows that such shards cannot
decide alone are merged across shards by the operators.

Rows are known by two hashes of key and text, so keys may be null or repeated.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.words import binary, mix, slices, tidy

FLUSH_ROWS = 1_000_000
FLUSH_BYTES = 24 << 20
# An anchor with more runs in one task is dealt out as a shard of its own.
HOT_RUNS = 256


def pack(**columns: np.ndarray | bytes) -> bytes:
    """Columns as one compressed value; bytes of equal weight lie together, which compresses well."""
    parts = {}
    for name, values in columns.items():
        if isinstance(values, bytes):
            parts[name] = values
        else:
            values = np.ascontiguousarray(values)
            planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()
            parts[name] = (values.dtype.str, planes)
    return zstandard.compress(pickle.dumps(parts, protocol=5), 1)


def unpack(blob: bytes) -> dict:
    out = {}
    for name, part in pickle.loads(zstandard.decompress(blob)).items():
        if isinstance(part, bytes):
            out[name] = part
        else:
            kind = np.dtype(part[0])
            planes = np.frombuffer(part[1], np.uint8).reshape(kind.itemsize, -1)
            out[name] = np.ascontiguousarray(planes.T).view(kind).ravel()
    return out


def joined(parts: list[dict]) -> dict:
    """Columns of several unpacked values, one after another."""
    if not parts:
        return {}
    return {
        k: b"".join(p[k] for p in parts) if isinstance(parts[0][k], bytes) else np.concatenate([p[k] for p in parts])
        for k in parts[0]
    }


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Partition numbers for hashes, independent of how the hashes were chosen."""
    return ((mix(hashes.astype(np.uint64)) >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def dealt(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers of each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def packed_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, kind, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
        ["bucket", "kind", "blob"],
    )


def first_of(*columns: np.ndarray) -> np.ndarray:
    """For each row, the first row that has the same values."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    out = np.empty(len(order), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return out


PACKED = "bucket int, kind int, blob binary"


def exchange(rows: DataFrame, n: int) -> DataFrame:
    """Packed rows, each in the partition of its bucket."""
    return rows.repartitionById(n, F.col("bucket"))


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rk1, rk2, text): texts without nulls, rows known by hashes of key and text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("rk1"), F.hash("text", "doc_id").alias("rk2"), "text")


RUN = ("anchor", "first", "last", "often")


def shared_runs(rows: DataFrame, runs: Callable[[list[bytes]], dict], once: bool = False) -> DataFrame:
    """(rk1, rk2, places): the runs of each row whose anchor occurs more than once anywhere.

    ``runs`` gives for some texts the columns text, anchor, first, last (window
    starts of the run within the text) and again (the anchor repeats within the
    run); it may give rk1 and rk2 for each text instead of those of the rows.
    With ``once``, rows of equal hashes count as one. ``places`` packs anchor,
    first, last and often (how often the anchor was met, at least).
    """
    n = partitions(rows)

    def told_of(c: dict, at: np.ndarray) -> bytes:
        # Runs name their row by its place in a table, which is shorter than two hashes.
        who, place = np.unique(c["row"][at], return_inverse=True)
        return pack(**{k: c[k][at] for k in RUN}, row=place.astype(np.int32), rk1=c["rk1"][who], rk2=c["rk2"][who])

    def read(blob: bytes) -> dict:
        c = unpack(blob)
        row = c.pop("row")
        return c | {"rk1": c["rk1"][row], "rk2": c["rk2"][row]}

    @tidy
    def find(batches):
        task = TaskContext.get().partitionId()
        held: list[dict] = []
        count = turn = 0

        def flush():
            nonlocal held, count, turn
            rows_before = np.cumsum([0, *(len(h["rk1"]) for h in held)])
            c = joined([{k: v for k, v in h.items() if k not in ("rk1", "rk2")} for h in held])
            c["row"] = c["text"] + np.repeat(rows_before[:-1], [len(h["text"]) for h in held])
            table = joined([{k: h[k] for k in ("rk1", "rk2")} for h in held])
            held, count = [], 0
            if once:
                row = first_of(table["rk1"], table["rk2"])[c["row"]]
                kept = np.flatnonzero(first_of(c["anchor"], row) == np.arange(len(row)))
                c = {k: v[kept] for k, v in c.items()}
                c["row"] = row[kept]
            order = np.argsort(c["anchor"], kind="stable")
            c = {k: v[order] for k, v in c.items()}
            new = np.flatnonzero(np.diff(c["anchor"], prepend=~c["anchor"][:1]))
            size = np.diff(np.append(new, len(order)))
            c["often"] = np.repeat(size, size).astype(np.int32)
            known = (c["often"] > 1) | c["again"]
            c |= table
            out = []
            keep = np.flatnonzero(~known)
            told = c["anchor"][new[known[new]]]
            for b, at in dealt(buckets_of(c["anchor"][keep], n), n):
                out.append((b, 0, told_of(c, keep[at])))
            for b, at in dealt(buckets_of(told, n), n):
                out.append((b, 1, pack(anchor=told[at])))
            at = np.flatnonzero(known)
            if len(at):
                out.append(((task + turn) % n, 2, told_of(c, at)))
            turn += 1
            return packed_batch(out)

        for batch in batches:
            for part in slices(batch, "text"):
                c = runs(binary(part.column("text")).to_pylist())
                if not len(c["text"]):
                    continue
                for k in ("rk1", "rk2"):
                    c.setdefault(k, part.column(k).to_numpy(zero_copy_only=False))
                held.append(c)
                count += len(c["text"])
                if count >= FLUSH_ROWS:
                    yield flush()
        if count:
            yield flush()

    @tidy
    def settle(batches):
        singles, told, kept = [], [], []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
                (singles, told, kept)[kind].append(unpack(blob) if kind == 1 else read(blob))
        if singles:
            c = joined(singles)
            alone = c["anchor"]
            if once:
                order = np.lexsort((c["rk2"], c["rk1"], c["anchor"]))
                same = np.ones(len(order), bool)
                same[1:] = np.any([c[k][order][1:] != c[k][order][:-1] for k in ("anchor", "rk1", "rk2")], axis=0)
                alone = c["anchor"][order[same]]
            every = np.concatenate([alone, *(t["anchor"] for t in told)])
            values, counts = np.unique(every, return_counts=True)
            c["often"] = counts[np.searchsorted(values, c["anchor"])].astype(np.int32)
            more = c["often"] > 1
            kept.append({k: v[more] for k, v in c.items()})
        if not kept:
            return
        c = joined(kept)
        home = buckets_of(c["rk1"].view(np.uint64), n)
        yield packed_batch([(b, 0, pack(**{k: v[at] for k, v in c.items()})) for b, at in dealt(home, n)])

    @tidy
    def gather(batches):
        parts = [unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if not parts:
            return
        c = joined(parts)
        order = np.lexsort((c["anchor"], c["first"], c["rk2"], c["rk1"]))
        c = {k: v[order] for k, v in c.items()}
        # Repeated rows report each run once for every copy.
        same = np.ones(len(order), bool)
        same[1:] = np.any([c[k][1:] != c[k][:-1] for k in ("rk1", "rk2", "first", "anchor")], axis=0)
        c = {k: v[same] for k, v in c.items()}
        new = np.flatnonzero(np.diff(c["rk1"], prepend=~c["rk1"][:1]) | np.diff(c["rk2"], prepend=~c["rk2"][:1]))
        ends = np.append(new[1:], len(c["rk1"]))
        for at in range(0, len(new), 1000):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c["rk1"][new[at : at + 1000]]),
                    pa.array(c["rk2"][new[at : at + 1000]]),
                    pa.array(
                        [
                            pack(**{k: c[k][a:b] for k in RUN})
                            for a, b in zip(new[at : at + 1000], ends[at : at + 1000])
                        ],
                        pa.binary(),
                    ),
                ],
                ["rk1", "rk2", "places"],
            )

    found = exchange(rows.select("rk1", "rk2", "text").mapInArrow(find, PACKED), n)
    settled = exchange(found.mapInArrow(settle, PACKED), n)
    return settled.mapInArrow(gather, "rk1 long, rk2 int, places binary")


def segments(shared: DataFrame, cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]], order: str | None = None) -> DataFrame:
    """Texts of the runs, dealt to shards by anchor; kind 1 marks shards of one task's frequent anchors.

    ``shared`` has rk1, rk2, text and places, ``cut`` gives the text of each run.
    A blob holds anchor, rk1, rk2, first, rank (the value of ``order``), size and
    data; kind 2 blobs tell home shards of anchors that have shards elsewhere.
    """
    n = partitions(shared)
    rank = F.coalesce(F.col(order).cast("long"), F.lit((1 << 63) - 1)) if order else F.lit(0).cast("long")
    rows = shared.select("rk1", "rk2", rank.alias("rank"), "text", "places")

    @tidy
    def deal(batches):
        task = TaskContext.get().partitionId()
        held: list[dict] = []
        total = turn = 0

        def flush():
            nonlocal held, total, turn
            pieces = [p for h in held for p in h.pop("pieces")]
            c = joined(held)
            held, total = [], 0
            size = np.fromiter(map(len, pieces), np.int64, len(pieces))
            values, inverse, counts = np.unique(c["anchor"], return_inverse=True, return_counts=True)
            hot = counts[inverse] > HOT_RUNS
            out = []
            for kind, rows_of in ((0, np.flatnonzero(~hot)), (1, np.flatnonzero(hot))):
                home = buckets_of(c["anchor"][rows_of], n)
                if kind:
                    home = (home + task + turn) % n
                for b, at in dealt(home, n):
                    at = rows_of[at]
                    out.append(
                        (b, kind, pack(**{k: v[at] for k, v in c.items()}, size=size[at], data=b"".join([pieces[i] for i in at])))
                    )
            told = values[counts > HOT_RUNS]
            for b, at in dealt(buckets_of(told, n), n):
                out.append((b, 2, pack(anchor=told[at])))
            turn += 1
            return packed_batch(out)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("rk1", "rk2", "rank", "places")]
            texts = binary(batch.column("text"))
            for i, (rk1, rk2, value, places) in enumerate(zip(*columns)):
                place = unpack(places)
                pieces = cut(texts[i].as_py(), place["first"], place["last"])
                k = len(pieces)
                held.append(
                    {
                        "anchor": place["anchor"],
                        "rk1": np.full(k, rk1, np.int64),
                        "rk2": np.full(k, rk2, np.int32),
                        "rank": np.full(k, value, np.int64),
                        "first": place["first"],
                        "pieces": pieces,
                    }
                )
                total += sum(map(len, pieces))
                if total >= FLUSH_BYTES:
                    yield flush()
        if held:
            yield flush()

    return exchange(rows.mapInArrow(deal, PACKED), n)


def shards(batches, most: int) -> Iterator[tuple[dict, np.ndarray]]:
    """Bounded shards of one partition of :func:`segments`, whole anchors together where they fit.

    With each shard comes which of its segments have an anchor with further shards.
    """
    home, own, told = [], [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            (home, own, told)[kind].append(unpack(blob))
    elsewhere = np.unique(np.concatenate([t["anchor"] for t in told])) if told else np.empty(0, np.uint64)
    for parts, apart in [(home, False), *(([x], True) for x in own)]:
        if not parts:
            continue
        c = joined(parts)
        data = np.frombuffer(c.pop("data"), np.uint8)
        start = np.cumsum(c["size"]) - c["size"]
        order = np.argsort(c["anchor"], kind="stable")
        anchor = c["anchor"][order]
        upto = np.cumsum(c["size"][order])
        new = np.append(np.flatnonzero(np.diff(anchor, prepend=~anchor[:1])), len(order))
        wide = np.ones(len(order), bool) if apart else np.isin(anchor, elsewhere)
        at = 0
        while at < len(order):
            before = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + most, "right")))
            if to < len(order):
                whole = new[np.searchsorted(new, to, "right") - 1]
                if whole > at:
                    to = int(whole)
                else:  # one anchor alone is too large: its shards are merged later
                    end = new[np.searchsorted(new, at, "right")]
                    wide[at:end] = True
            rows = order[at:to]
            shard = {k: v[rows] for k, v in c.items()}
            shard["data"] = data
            shard["start"] = start[rows]
            yield shard, wide[at:to]
            at = to


def by_document(spans: DataFrame) -> DataFrame:
    """(rk1, rk2, spans): all spans of a row, merged; ``spans`` packs start and end."""
    n = partitions(spans)

    @tidy
    def gather(batches):
        parts = [unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if not parts:
            return
        c = joined(parts)
        order = np.lexsort((c["start"], c["rk2"], c["rk1"]))
        rk1, rk2, start, end = (c[k][order] for k in ("rk1", "rk2", "start", "end"))
        new = np.flatnonzero(np.diff(rk1, prepend=~rk1[:1]) | np.diff(rk2, prepend=~rk2[:1]))
        ends = np.append(new[1:], len(rk1))
        merged = []
        for a, b in zip(new, ends):
            reach = np.maximum.accumulate(end[a:b])
            first = np.concatenate([[True], start[a + 1 : b] > reach[:-1]])
            last = np.append(first[1:], True)
            merged.append(pack(start=start[a:b][first], end=reach[last]))
        for at in range(0, len(new), 2000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rk1[new[at : at + 2000]]), pa.array(rk2[new[at : at + 2000]]), pa.array(merged[at : at + 2000], pa.binary())],
                ["rk1", "rk2", "spans"],
            )

    return exchange(spans, n).mapInArrow(gather, "rk1 long, rk2 int, spans binary")


def span_rows(n: int, rk1, rk2, start, end) -> list[tuple[int, int, bytes]]:
    """Spans as packed rows (kind 0) for :func:`by_document`."""
    home = buckets_of(rk1.view(np.uint64), n)
    return [(b, 0, pack(rk1=rk1[at], rk2=rk2[at], start=start[at], end=end[at])) for b, at in dealt(home, n)]
