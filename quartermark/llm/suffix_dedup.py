"""Removal of repeated byte strings by suffix arrays.

A byte is removed if a string of ``WINDOW`` bytes that covers it starts at
another place too, in any document. Only runs of windows whose anchor occurs
elsewhere are looked at (:mod:`quartermark.llm.shared`). They are dealt to
shards by anchor; in each shard the distinct strings get a suffix array
(Larsson-Sadakane) and common prefixes (Kasai), and a window is repeated when
it shares ``WINDOW`` bytes with a neighbour in sorted order. An anchor too
frequent for one shard has several. Each then reports one window of every
sort, by two hashes, and sorted lists of them are merged by binary search.

Defined results: a null text is empty; texts shorter than a window keep all
bytes. Repeated rows are other places, so their windows go in every copy.
Every input row gives one row. Only key and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm import shared
from quartermark.llm.suffix_arrays import common_prefixes, suffix_array, with_sentinels
from quartermark.llm.words import binary, mix, slices
from quartermark.session import written_once

WINDOW = 200
GRAM = 16
SHARD_BYTES = 1 << 20
LONGEST_RUN = 512


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    word = np.ascontiguousarray(eight).view(np.uint64).ravel()
    a, b = word[: len(word) - 8], word[8:]
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` consecutive values, for each first place."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def byte_runs(texts: list[bytes], window: int = WINDOW) -> dict:
    """Runs of windows with one anchor; see :func:`shared.shared_runs`."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    empty = {
        "text": np.empty(0, np.int64),
        "anchor": np.empty(0, np.uint64),
        "first": np.empty(0, np.int32),
        "last": np.empty(0, np.int32),
        "again": np.empty(0, bool),
    }
    long = np.flatnonzero(sizes >= window)
    if not len(long):
        return empty
    data = np.frombuffer(b"".join([texts[i] for i in long]), np.uint8)
    size = sizes[long]
    start = np.cumsum(size) - size
    hashes = gram_hashes(data)
    width = window - GRAM + 1
    least = sliding_minimum(hashes, width)
    n = size - window + 1
    valid = np.repeat(start, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    anchor = least[valid]
    owner = np.repeat(np.arange(len(long)), n)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    value, text = anchor[first], owner[first]
    a, b = valid[first], valid[last]
    # An anchor that occurs twice within its own run may repeat a window there.
    bits = np.uint64(64 - 20)
    bitmap = np.zeros(1 << 20, bool)
    bitmap[(value >> bits).astype(np.int64)] = True
    maybe = np.flatnonzero(bitmap[(hashes >> bits).astype(np.int64)])
    known = np.unique(value)
    at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
    hit = known[at] == hashes[maybe]
    place = at[hit] * len(data) + maybe[hit]
    place.sort()
    group = np.searchsorted(known, value) * len(data)
    again = np.searchsorted(place, group + b + width - 1, "right") - np.searchsorted(place, group + a, "left") > 1
    # Long runs (of periodic text) are cut, which leaves every window in one run.
    parts = -(-(last - first + 1) // LONGEST_RUN)
    again |= parts > 1
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    base = np.repeat(a - start[text], parts) + part * LONGEST_RUN
    return {
        "text": np.repeat(long[text], parts),
        "anchor": np.repeat(value, parts),
        "first": base.astype(np.int32),
        "last": np.minimum(base + LONGEST_RUN - 1, np.repeat(b - start[text], parts)).astype(np.int32),
        "again": np.repeat(again, parts),
    }


def window_hashes(data: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows at the given places."""
    out = []
    for base in (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5):
        weight = np.cumprod(np.full(window, base, np.uint64), dtype=np.uint64)
        value = np.empty(len(places), np.uint64)
        for k in range(0, len(places), 20_000):
            grid = data[places[k : k + 20_000, None] + np.arange(window)].astype(np.uint64) + np.uint64(1)
            value[k : k + 20_000] = (grid * grid * weight + mix(grid) * weight).sum(axis=1, dtype=np.uint64)
        out.append(mix(value))
    return out[0], out[1]


def repeated(shard: dict, wide: np.ndarray, window: int = WINDOW):
    """Windows of a shard that repeat within it, and those that only another shard can decide.

    Gives the spans (segment, start, end) of the first, and for segments with
    wide anchors one row (segment, place, hashes, whether repeated) of each
    distinct window.
    """
    data, at, size = shard["data"], shard["start"], shard["size"]
    content = [data[a : a + s].tobytes() for a, s in zip(at.tolist(), size.tolist())]
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(c, len(number)) for c in content], np.int64)
    copies = np.bincount(which)
    sizes = np.fromiter(map(len, number), np.int64, len(number))
    symbols = np.frombuffer(b"".join(number), np.uint8).astype(np.int64) + 1
    text, first, ends = with_sentinels(symbols, sizes)
    order, rank = suffix_array(text, first, ends)
    prefix = common_prefixes(text, first, ends, order, rank)
    close = prefix[order] >= window
    group = np.cumsum(~close)  # of equal windows in sorted order
    many = close.copy()
    many[:-1] |= close[1:]
    twice = np.zeros(len(text), bool)
    twice[order] = many
    n = sizes - window + 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(first, n) + inside
    string = np.repeat(np.arange(len(sizes)), n)
    dup = twice[place] | (copies[string] > 1)
    edge = np.diff(dup.astype(np.int8), prepend=0)
    start_new = dup & ((edge == 1) | (inside == 0))
    run_first = np.flatnonzero(start_new)
    stop_new = dup & np.append(~dup[1:] | (inside[1:] == 0), True)
    run_last = np.flatnonzero(stop_new)
    # Runs of the distinct strings, for each segment that has the string.
    by_string = np.searchsorted(string[run_first], np.arange(len(sizes) + 1))
    runs = np.diff(by_string)[which]
    segment = np.repeat(np.arange(len(which)), runs)
    run = np.repeat(by_string[which], runs) + (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    spans = (segment, inside[run_first[run]], inside[run_last[run]] + window)
    asked = np.unique(which[wide])
    if not len(asked):
        return spans, None
    chosen = np.flatnonzero(np.isin(string, asked))
    sort = group[rank[place[chosen]]]
    _, one = np.unique(sort, return_index=True)
    chosen = chosen[one]
    some = np.zeros(len(sizes), np.int64)
    some[which[wide]] = np.flatnonzero(wide)
    h1, h2 = window_hashes((text - 1).astype(np.uint8), place[chosen], window)
    return spans, (some[string[chosen]], inside[chosen], h1, h2, dup[chosen])


def repeated_spans(shared_rows: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(rk1, rk2, spans) of the bytes to remove."""
    n = shared.partitions(shared_rows)

    def cut(text, first, last):
        return [text[a : b + window] for a, b in zip(first.tolist(), last.tolist())]

    def work(batches):
        for shard, wide in shared.shards(batches, shard_bytes):
            (segment, start, end), open_windows = repeated(shard, wide, window)
            base = shard["first"].astype(np.int64)
            rows = shared.span_rows(n, shard["rk1"][segment], shard["rk2"][segment], base[segment] + start, base[segment] + end)
            if open_windows is not None:
                segment, start, h1, h2, dup = open_windows
                for b, at in shared.dealt(shared.buckets_of(h1, n), n):
                    order = at[np.argsort(h1[at], kind="stable")]
                    who = segment[order]
                    rows.append(
                        (b, 1, shared.pack(h1=h1[order], h2=h2[order], rk1=shard["rk1"][who], rk2=shard["rk2"][who], start=base[who] + start[order], dup=dup[order]))
                    )
            yield shared.packed_batch(rows)

    def merge(batches):
        # One sorted list of windows from each shard; a window that another list holds too is repeated.
        lists = [shared.unpack(blob) for batch in batches for blob in batch.column("blob").to_pylist()]
        if len(lists) < 2:
            return
        every = shared.joined(lists)
        order = np.lexsort((every["h2"], every["h1"]))
        h1, h2 = every["h1"][order], every["h2"][order]
        for c in lists:
            low = np.searchsorted(h1, c["h1"], "left")
            high = np.searchsorted(h1, c["h1"], "right")
            found = np.flatnonzero((high - low > 1) & ~c["dup"])
            # Equal first hashes are few, one of each shard; the second has to agree as well.
            size = (high - low)[found]
            entry = np.repeat(low[found], size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
            agree = np.add.reduceat((h2[entry] == np.repeat(c["h2"][found], size)).astype(np.int64), np.cumsum(size) - size) if len(found) else found
            found = found[agree > 1]
            if len(found):
                yield shared.packed_batch(
                    shared.span_rows(n, c["rk1"][found], c["rk2"][found], c["start"][found], c["start"][found] + window)
                )

    worked = written_once(shared.segments(shared_rows, cut).mapInArrow(work, shared.PACKED), "repeats")
    merged = shared.exchange(worked.filter("kind = 1"), n).mapInArrow(merge, shared.PACKED)
    return shared.by_document(worked.filter("kind = 0").unionByName(merged))


def kept_ranges(size: int, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """What is left of ``size`` places between merged, ascending spans."""
    edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), size]
    return [(a, b) for a, b in zip(edges[0::2], edges[1::2]) if a < b]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: key, bytes, removed bytes, removed runs, the kept bytes' checksum, and the spans."""
    rows = shared.keyed(docs, key, text)
    places = shared.shared_runs(rows, lambda texts: byte_runs(texts, window))
    found = rows.join(places, ["rk1", "rk2"]).select("rk1", "rk2", "text", "places")
    spans = repeated_spans(found, window)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def report(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for text, blob in zip(binary(part.column("text")).to_pylist(), part.column("spans").to_pylist()):
                    start, end = (lambda s: (s["start"], s["end"]))(shared.unpack(blob)) if blob else (np.empty(0, np.int64),) * 2
                    kept = hashlib.sha256()
                    for a, b in kept_ranges(len(text), start, end):
                        kept.update(text[a:b])
                    removed = [{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())]
                    out.append((len(text), int((end - start).sum()), len(start), kept.hexdigest(), removed))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
                )

    schema = (
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<struct<start: long, end: long>>"
    )
    final = rows.join(spans, ["rk1", "rk2"], "left").select("doc_id", "text", "spans")
    return final.mapInArrow(report, schema)
