"""Tables that grow by committed batches, so that a step that runs again adds nothing.

Rows carry the name of their source (a file, a load). A batch is written to a
folder of its own; a small commit record, written afterwards as one file, names
its sources. Readers see committed batches only. A run that is lost before the
commit leaves a batch that no one sees, and the next run writes it anew; a run
after the commit finds its sources committed and adds nothing. One writer at a
time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermark.sources.tables import write_table

COMMIT = "batch string, source string"


class CommittedTable:
    """``schema`` names the columns of a row without its source; ``partitions`` become folders."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partitions: Sequence[str] = ()) -> None:
        self.spark, self.schema, self.partitions = spark, schema, tuple(partitions)
        self.rows_path, self.commits_path = f"{root}/rows", f"{root}/commits"
        spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(self.commits_path)

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).parquet(self.commits_path)

    def read(self) -> DataFrame:
        """All committed rows."""
        committed = self.commits().select("batch").distinct()
        if committed.isEmpty():
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        # The batch is a folder: others are pruned before they are opened.
        rows = self.spark.read.schema(stored).parquet(self.rows_path).join(committed, "batch", "left_semi")
        return rows.select(*self.schema.names)

    def append(self, rows: DataFrame, source: str = "source_file") -> None:
        """Adds the rows of sources that no commit names yet."""
        batch = uuid.uuid4().hex
        known = self.commits().select(F.col("source").alias(source)).distinct()
        fresh = rows.select(*self.schema.names, source).join(known, source, "left_anti")
        folders = ("batch", *self.partitions)
        write_table(fresh.withColumn("batch", F.lit(batch)).withColumnRenamed(source, "_source"), self.rows_path, "append", folders)
        stored = T.StructType([T.StructField("_source", T.StringType()), T.StructField("batch", T.StringType())])
        written = self.spark.read.schema(stored).parquet(self.rows_path).filter(F.col("batch") == batch)
        names = written.select("batch", F.col("_source").alias("source")).distinct()
        # Names only, in one file, which appears whole or not at all.
        names.coalesce(1).write.mode("append").parquet(self.commits_path)

    def insert_absent(self, rows: DataFrame, keys: Sequence[str], load: str) -> None:
        """Adds the rows whose key no stored row has; ``rows`` has one row for each key.

        A stored row is never changed: the first load of a key wins. A row
        with a null in its key is added by every load.
        """
        stored = self.read().select(*keys)
        absent = rows.select(*self.schema.names).join(stored, list(keys), "left_anti")
        self.append(absent.withColumn("source_file", F.lit(load)))
