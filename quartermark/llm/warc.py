"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

:func:`write_archives` writes records as whole-file gzip streams, one file
after another in each task. :func:`normalise` inflates each file once, writes
every record as its own gzip member and notes its offset and length in a
sidecar index. :func:`read_records` opens the members by that index. No step
holds more than one record, and files lie in the shared folder, so a lost
executor costs only a repeated task: a file gets its name when it is whole.

Equal payloads of at least ``SMALL`` bytes are stored once. The row with the
largest id is the response, the others are revisits that refer to it; which row that is comes
from an aggregate per digest, joined back. A payload that a third of all
pages share is one row on the small side, and adaptive execution splits the
large side.

Defined results: a null payload is empty. Payloads below ``SMALL`` bytes are
responses. Rows that repeat the largest id are all responses, and so are rows
of a payload that has no row with an id. A null url gives no target header.
Only id, url and payload are read.
"""

from __future__ import annotations

import hashlib
import posixpath
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.files import Writer, store
from quartermark.session import shared_dir

SMALL = 1000
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def with_roles(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Pages with the digest of their payload and the id that they refer to (null: a response)."""
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    small = rows.filter(F.col("size") < SMALL).withColumn("refers", F.lit(None).cast(rows.schema["id"].dataType))
    large = rows.filter(F.col("size") >= SMALL)
    kept = large.groupBy("digest").agg(F.max("id").alias("kept"))
    joined = large.join(kept, "digest", "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") != F.col("kept")), F.col("kept"))
    return small.unionByName(joined.withColumn("refers", refers).drop("kept"))


def record(page, url: str | None, payload: bytes, digest: str, refers) -> bytes:
    kind = "response" if refers is None else "revisit"
    headers = [
        b"WARC/1.1",
        f"WARC-Type: {kind}".encode(),
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>".encode(),
        f"WARC-Date: {DATE}".encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"X-Full-Payload-Length: {len(payload)}".encode(),
    ]
    if url is not None:
        headers.append(b"WARC-Target-URI: " + quote(url, safe="/:?#[]@!$&'()*+,;=%~").encode())
    if refers is not None:
        headers.append(f"WARC-Refers-To: <urn:page:{refers}>".encode())
        headers.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        payload = b""
    headers += [b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode()]
    return b"\r\n".join(headers) + _END + payload + _END


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes rows of :func:`with_roles` as whole-file gzip streams when evaluated; one row per file."""

    def run(batches):
        task, number, writer, stream = TaskContext.get().partitionId(), 0, None, None

        def close():
            writer.write(stream.flush())
            return pa.RecordBatch.from_pydict({"path": [writer.close()]})

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    writer = Writer(folder, f"part-{task:06d}-{number:04d}.warc.gz")
                    stream, number = zlib.compressobj(6, zlib.DEFLATED, 31), number + 1
                data = record(row["id"], row["url"], row["payload"], row["digest"], row["refers"])
                writer.write(stream.compress(data))
                if writer.size >= archive_bytes:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    return rows.select("id", "url", "payload", "digest", "refers").mapInArrow(run, "path string")


def inflated(files, path: str, chunk: int = 1 << 20):
    """Content of a gzip file of one or several members, in pieces."""
    with files.open_input_stream(path, compression=None) as source:
        stream = zlib.decompressobj(31)
        while data := source.read(chunk):
            while data:
                yield stream.decompress(data)
                data = stream.unused_data
                if stream.eof:
                    stream = zlib.decompressobj(31)
        if not stream.eof and stream.decompress(b"") + stream.flush():
            raise ValueError(f"{path} ends within a record")


def records(pieces):
    """Whole records, one at a time, from consecutive pieces of an archive."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(_END)
                if end < 0:
                    break
                need = end + 2 * len(_END) + int(fields(bytes(held[:end]))["content-length"])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def normalise(paths: DataFrame, folder: str) -> DataFrame:
    """Rewrites archives with one gzip member per record when evaluated; one row per member.

    Beside each archive lies its index as text: offset and length of each member.
    """

    def run(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                files, path = store(uri)
                writer = Writer(folder, posixpath.basename(path))
                offsets, lengths = [], []
                for data in records(inflated(files, path)):
                    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = stream.compress(data) + stream.flush()
                    offsets.append(writer.size)
                    lengths.append(len(member))
                    writer.write(member)
                done = writer.close()
                index = Writer(folder, posixpath.basename(path) + ".idx")
                index.write("".join(f"{a} {b}\n" for a, b in zip(offsets, lengths)).encode())
                index.close()
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([done] * len(offsets)), "at": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())}
                )

    return paths.mapInArrow(run, "path string, at long, length long")


def read_records(index: DataFrame) -> DataFrame:
    """Every record of normalised archives, each opened at its offset."""

    def read(uri, at, length, opened):
        if uri not in opened:
            opened.clear()
            files, path = store(uri)
            opened[uri] = files.open_input_file(path)
        source = opened[uri]
        source.seek(at)
        data = zlib.decompress(source.read(length), 31)
        end = data.index(_END)
        head = fields(data[:end])
        payload = data[end + len(_END) : end + len(_END) + int(head["content-length"])]
        kind = head["warc-type"]
        whole = kind == "response"
        return {
            "id": head["warc-record-id"][len("<urn:page:") : -1] or None,
            "url": head.get("warc-target-uri"),
            "payload": payload,
            "payload_bytes": len(payload) if whole else int(head["x-full-payload-length"]),
            "payload_digest": hashlib.sha1(payload).hexdigest() if whole else head["warc-payload-digest"][5:],
            "record_type": kind,
            "refers_to": None if whole else head["warc-refers-to"][len("<urn:page:") : -1],
        }

    names = ["id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches):
        opened: dict = {}
        for batch in batches:
            rows = batch.to_pylist()
            for k in range(0, len(rows), 200):
                found = [read(r["path"], r["at"], r["length"], opened) for r in rows[k : k + 200]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[n] for f in found], t) for n, t in zip(names, kinds)], names
                )

    schema = (
        "id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string"
    )
    return index.mapInArrow(run, schema)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes all pages, normalises the archives and returns their index."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    write_archives(with_roles(pages, key, url, payload), f"{folder}/whole").write.parquet(f"{folder}/files")
    files = spark.read.parquet(f"{folder}/files")
    # A row per file: one task for each, however many files Spark would read together.
    spread = files.repartitionByRange(max(1, files.count()), "path")
    normalise(spread, f"{folder}/members").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")
