"""Merge the many small folders of closed dates, while batches are written and replayed around it.

A table of ``append_batch`` has a folder for each date, run and batch. ``compact_closed`` writes the rows
of closed dates once more under one run of its own, then marks what these rows replace, and only
then removes the replaced folders. Readers go by the marks: merged rows count from the mark on, and
replaced folders count no more, whether they are gone, still there after a crash, or written
again by a batch that is replayed later. So each record is there once at any moment.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierflow.sinks.tables import BATCH, RUN
from courierflow.sources.files import read_table

#: The run of merged rows; their batch number is the generation of the merge.
MERGED = "merged"
#: Folder of the marks below the table, hidden from plain reads by its name.
MARKS = "_merged"
MARK_SCHEMA = T.StructType([
    T.StructField("ingest_date", T.DateType()), T.StructField("generation", T.LongType()), T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
PLACE = ["ingest_date", RUN, BATCH]


def marks_of(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, f"{path}/{MARKS}", MARK_SCHEMA)


def visible(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows that count: what no mark replaces, and merged rows only once they are marked."""
    left = rows.join(marks.select(*PLACE), PLACE, "left_anti")
    done = marks.select("ingest_date", F.col("generation").alias(BATCH)).distinct()
    merged = left.where(F.col(RUN) == MERGED).join(done, ["ingest_date", BATCH], "left_semi")
    return left.where(F.col(RUN) != MERGED).unionByName(merged)


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A landed table as it counts now; one that nobody has written yet is empty.

    ``schema`` may have columns that older files lack (NULL there)."""
    whole = T.StructType([f for f in schema.fields if f.name not in (RUN, BATCH)])
    place = T.StructType([*whole.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
    return visible(read_table(spark, path, place), marks_of(spark, path)).select(*whole.names)


def _remove(spark: SparkSession, folders: Sequence[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(conf).delete(where, True)


def compact_closed(
    spark: SparkSession,
    path: str,
    before: date,
    partition_by: Sequence[str] = ("ingest_date",),
    generation: int | None = None,
    remove: bool = True,
) -> int:
    """Merge the folders of each date before ``before`` that has more than one; returns how many were merged.

    Files come out at the advisory partition size, small dates in one and large ones in several.
    Columns of all schema versions are kept. ``remove`` off leaves replaced folders to readers that
    listed them before; a later call with it on removes them. Run one call for a table at a time.
    """
    generation = int(time.time() * 1000) if generation is None else generation
    if not _there(spark, path):
        return 0
    table = spark.read.option("mergeSchema", "true").parquet(path).withColumns({"ingest_date": F.col("ingest_date").cast("date"), RUN: F.col(RUN).cast("string"), BATCH: F.col(BATCH).cast("long")})
    closed = F.col("ingest_date") < F.lit(before)
    marks = marks_of(spark, path)
    rows = visible(table, marks).where(closed)
    parts = rows.select(*PLACE).distinct()
    several = parts.groupBy("ingest_date").count().where("count > 1").select("ingest_date")
    replaced = parts.join(several, "ingest_date", "left_semi").collect()  # one row a batch of closed dates
    if replaced:
        days = sorted({r["ingest_date"] for r in replaced})
        merged = rows.where(F.col("ingest_date").isin(days)).withColumns({RUN: F.lit(MERGED), BATCH: F.lit(generation).cast("long")})
        writer = merged.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by, RUN, BATCH).parquet(path)
        told = spark.createDataFrame([(r["ingest_date"], generation, r[RUN], r[BATCH]) for r in replaced], MARK_SCHEMA)
        told.coalesce(1).write.mode("append").parquet(f"{path}/{MARKS}")  # from here on the merged rows count
    if remove:
        files = spark.read.option("mergeSchema", "true").parquet(path)  # listed anew
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
        gone = files.select(F.col("ingest_date").cast("date").alias("ingest_date"), F.col(RUN).cast("string").alias(RUN), F.col(BATCH).cast("long").alias(BATCH), folder)
        _remove(spark, [r.folder for r in gone.join(marks_of(spark, path).select(*PLACE), PLACE, "left_semi").select("folder").distinct().collect()])
    return len(replaced)


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
