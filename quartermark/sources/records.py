"""Records of files in which quoted fields run over line ends, read by many tasks.

A file is cut into blocks. Whether a block's first line continues a quoted
field depends on all blocks before it, so a first pass finds, for each block
on its own, the state in which it leaves the next one, once for either state
in which it may begin. Put together along the file, which takes two flags for
each block, that gives the state of every block; a second pass then cuts each
block at its true record ends. A record belongs to the block it starts in.

A quote opens a field only at its start. It is closed by a lone quote in the
same line, or by one in a later line that ends the field, at most
``RECORD_LIMIT`` bytes after the record's start. A quote that is not closed is
plain text: its line is a record of its own, marked as damaged, and the lines
after it are read as if nothing had happened.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.session import written_once
from quartermark.sources.files import open_stream

BLOCK_BYTES = 32 << 20
# The states of one file are put together in one row, so long files get larger blocks.
MOST_BLOCKS = 4096
RECORD_LIMIT = 1 << 20
BATCH = 10_000
TASKS_PER_CORE = 4


def cut_in_field(sep: str) -> str:
    """Pattern for a line in which a field's opening quote is not closed."""
    s = re.escape(sep)
    closed = '"[^"]*+(?:""[^"]*+)*+"'
    return f'^(?:(?:{closed}|(?!"))[^{s}]*+{s})*+(?!{closed})"'


@lru_cache(maxsize=None)
def patterns(sep: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """A record, the rest of a record from within a quoted field, and a damaged record."""
    s = re.escape(sep).encode()
    same_line = rb'"[^"\n]*+(?:""[^"\n]*+)*+"'
    ends = rb'"(?=[' + s + rb"\r\n]|\Z)"
    # Some writers put a backslash before an inner quote; they are heard where doubled quotes make no sense.
    later = rb'(?:[^"]*+(?:""[^"]*+)*+' + ends + rb'|[^"\\]*+(?:(?:\\[\s\S]|"")[^"\\]*+)*+' + ends + rb")"
    quoted = rb"(?:" + same_line + rb'|"' + later + rb")"
    field = quoted + rb"?+[^" + s + rb"\n]*+"
    rest = rb"(?:" + s + field + rb")*+\n"
    damaged = rb"(?:(?:" + quoted + rb'|(?!"))[^' + s + rb"\n]*+" + s + rb")*+(?!" + quoted + rb')"'
    return re.compile(field + rest), re.compile(later + rb"[^" + s + rb"\n]*+" + rest), re.compile(damaged)


class Block:
    """The records that start between two places of a file."""

    def __init__(self, path: str, start: int, size: int, length: int, sep: str):
        self.path, self.start, self.size, self.length = path, start, size, length
        self.record, self.rest, self.damaged = patterns(sep)
        self.base = max(start - 1, 0)
        self.end = start + size - self.base
        self.fetch(self.end + RECORD_LIMIT)

    def fetch(self, size: int) -> None:
        with open_stream(self.path) as stream:
            stream.seek(self.base)
            self.data = stream.read(size)
        self.whole = self.base + len(self.data) >= self.length
        if self.whole and not self.data.endswith(b"\n"):
            self.data += b"\n"

    def line_from(self, place: int) -> int:
        """The first line start at ``place`` or later; -1 if the file ends before."""
        while True:
            at = self.data.find(b"\n", place - 1) + 1 if place else 0
            if at or not place or self.whole:
                return at if (at or not place) and at < len(self.data) else -1
            self.fetch(2 * len(self.data))

    def match(self, pattern: re.Pattern, at: int) -> re.Match | None:
        found = pattern.match(self.data, at)
        while found is None and not self.whole and self.data.find(b"\n", at) < 0:
            self.fetch(2 * len(self.data))
            found = pattern.match(self.data, at)
        return found

    def records(self, inside: bool) -> Iterator[bytes]:
        """The records; afterwards ``leaves`` says whether the next block begins inside a field."""
        self.leaves = inside
        at = self.line_from(self.start - self.base)
        if at < 0 or at >= self.end:
            return
        if inside:
            found = self.match(self.rest, at)
            at = found.end() if found else at
        while at < min(self.end, len(self.data)):
            found = self.match(self.record, at)
            to = found.end() if found and found.end() - at <= RECORD_LIMIT else self.data.find(b"\n", at) + 1
            yield self.data[at:to].rstrip(b"\r\n")
            at = to
        following = self.line_from(self.end)
        self.leaves = 0 <= following < at


def whole_records(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, layout, block, arrival, value, damaged) of ``files`` (path, file, length, sep, layout, encoding), without headers."""
    size = F.greatest(F.lit(block_bytes), F.ceil(F.col("length") / MOST_BLOCKS)).cast("long")
    blocks = files.filter("length > 0").withColumn("size", size)
    blocks = blocks.withColumn("start", F.explode(F.expr("sequence(0L, length - 1, size)")))
    tasks = TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                block = Block(r.path, r.start, r.size, r.length, r.sep)
                after = []
                for inside in (False, True):
                    for _ in block.records(inside):
                        pass
                    after.append(block.leaves)
                rows.append((r.path, r.start, *after))
            yield pd.DataFrame(rows, columns=["path", "start", "out", "within"])

    named = blocks.select("path", "start", "size", "length", "sep").repartition(tasks, "path", "start")
    left = named.mapInPandas(leave, "path string, start long, out boolean, within boolean")
    along = left.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "out", "within"))).alias("b"))
    states = F.expr(
        """aggregate(b, named_struct('list', cast(array() AS array<struct<start: bigint, inside: boolean>>), 'now', false),
        (a, x) -> named_struct('list', concat(a.list, array(named_struct('start', x.start, 'inside', a.now))),
            'now', if(a.now, x.within, x.out))).list"""
    )
    begins = written_once(along.select("path", F.inline(states)), "block-states")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["file", "layout", "block", "arrival", "value", "damaged"]
        for batch in batches:
            for r in batch.itertuples():
                block, held = Block(r.path, r.start, r.size, r.length, r.sep), []
                for number, data in enumerate(block.records(r.inside)):
                    if r.start or number:
                        damaged = block.damaged.match(data) is not None
                        held.append((r.file, r.layout, r.start, number, data.decode(r.encoding, errors="replace"), damaged))
                    if len(held) == BATCH:
                        yield pd.DataFrame(held, columns=columns)
                        held = []
                yield pd.DataFrame(held, columns=columns)

    chosen = blocks.join(begins, ["path", "start"]).repartition(tasks, "path", "start")
    return chosen.mapInPandas(cut, "file string, layout int, block long, arrival long, value string, damaged boolean")
