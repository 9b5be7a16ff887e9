"""Newly arrived files, each processed once.

The stream runs over files, not lines: a micro-batch is a bounded set of whole
files, so rules that need a whole file (its header, its decimal style) hold
exactly as in a batch run. Each batch overwrites a folder of its own, so a
batch that is run again after a failure adds nothing twice. The folders are
named by checkpoint and batch number, so streams with other checkpoints may
write to the same target.

Archives that arrive are unpacked into a folder of the batch and their members
read like files that arrived. What a batch leaves out, and why, is written
beside its rows: files without usable rows or without a byte, damaged archives
and members, and records with a quote that is not closed. Files without a byte
are never rows of a batch, so each batch lists the folder for them and writes
those that no earlier batch of its stream has written.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quartermark.operators.normalize import consolidated
from quartermark.sources.archives import unpack
from quartermark.sources.delimited import LATIN, file_columns, list_files
from quartermark.sources.empty import empty_files
from quartermark.sources.raw import LANDED_ENDINGS, RAW_ENDINGS, RAW_FILES, RawScan, empty_rows

LANDED_FILES = "*.{[cC][sS][vV],[tT][xX][tT],[xX][lL][sS][xX],[zZ][iI][pP]}"

REJECT = "source_file string, motivo string, registro string"
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(spark: SparkSession, root: str, pattern: str = LANDED_FILES, per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch)
        .load(root)
        .select(*file_columns())
    )


def ingest(
    spark: SparkSession, root: str, target: str, checkpoint: str, encoding: str = LATIN, per_batch: int = 1000
) -> StreamingQuery:
    """Processes what has arrived since the last run with this checkpoint, then stops."""

    owner = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write_batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        place = f"stream={owner}/batch={batch_id}"
        is_archive = F.lower("path").endswith(".zip")
        landed, members, empty = files.filter(~is_archive), None, None
        if not files.filter(is_archive).isEmpty():
            # The folder belongs to the batch: run again, it gets the same files.
            unpacked = f"{target}/unpacked/{place}"
            members = unpack(session, root, unpacked, archives=files.filter(is_archive))
            if not members.filter("error IS NULL").isEmpty():
                landed = landed.unionByName(list_files(session, unpacked, RAW_FILES))
                empty = empty_files(session, unpacked, RAW_ENDINGS)
        found = RawScan(session, landed, encoding, members, empty=empty)
        bronze_path = f"{target}/bronze/{place}"
        found.bronze().write.mode("overwrite").parquet(bronze_path)
        bronze = session.read.parquet(bronze_path)
        consolidated(bronze).write.mode("overwrite").parquet(f"{target}/silver/{place}")
        damaged = found.damaged_records().withColumn("motivo", F.lit("unbalanced_quote"))
        left_out = found.skipped(bronze).withColumn("registro", F.lit(None).cast("string")).unionByName(damaged)
        left_out.write.mode("overwrite").parquet(f"{target}/rejects/{place}")
        # Read after the batch's own rows are there, so that the folder exists; the batch itself does not count.
        earlier = session.read.schema(f"{REJECT}, stream string, batch long").parquet(f"{target}/rejects")
        known = earlier.filter((F.col("stream") == owner) & (F.col("batch") < batch_id) & (F.col("motivo") == "empty_file"))
        new = empty_rows(empty_files(session, root, LANDED_ENDINGS)).join(known, "source_file", "left_anti")
        new.withColumn("registro", F.lit(None).cast("string")).write.mode("append").parquet(f"{target}/rejects/{place}")

    return (
        arriving_files(spark, root, per_batch=per_batch)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/silver").drop("stream", "batch")


def rejected(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, motivo, registro): files and records that added nothing, once each."""
    return spark.read.schema(REJECT).parquet(f"{target}/rejects").select("source_file", "motivo", "registro")
