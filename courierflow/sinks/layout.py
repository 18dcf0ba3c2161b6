"""Layouts for lookups: files along a Z-order curve with Bloom filters and a zone map, bucketed tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that each column of a Z-order is cut into by its quantiles: 2 to this power.
Z_BITS = 8
ZONES = "_zones"


def _code(value: Column, cuts: Column, bits: int) -> Column:
    """How many cuts lie at or below a value, by binary search."""
    further = lambda at, p: F.when(F.get(cuts, at + p - 1) <= value, at + p).otherwise(at)
    return F.aggregate(F.array(*[F.lit(1 << b) for b in reversed(range(bits))]), F.lit(0), further)


def z_order(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> Column:
    """A row's place on the Z-order curve of numeric columns, from the interleaved bits of their quantiles.

    The quantiles are taken by one aggregate over these columns, so values that bunch together
    are told apart as well as spread ones. NULL counts as smallest.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 1 << (bits + 2)).alias(c) for c in columns]).first()
    place = F.lit(0).cast("long")
    for n, c in enumerate(columns):
        cuts = sorted(set(found[c] or []))  # at most 2 ** bits
        array = F.array(*map(F.lit, cuts)).cast(f"array<{df.schema[c].dataType.simpleString()}>")
        # few different values spread over all bits, or they would only tell rows apart within a file
        code = _code(F.col(c), array, bits) * F.lit((1 << bits) // (len(cuts) + 1))
        for b in range(bits):
            bit = F.shiftright(code, b).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, b * len(columns) + n))
    return place


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], files: int, bloom: Sequence[str] = ()) -> None:
    """Write about ``files`` files, each a stretch of the Z-order curve of ``columns``, with Parquet Bloom
    filters on ``bloom`` and a zone map beside them.

    A file then covers a small range of every column, so that a condition on any of them skips most
    files. The zone map has one row a file with the least and greatest value of each column.
    """
    writer = (
        df.withColumn("_z", z_order(df, columns))
        .repartitionByRange(files, "_z", *columns)
        .sortWithinPartitions("_z", *columns)
        .drop("_z")
        .write.mode("overwrite")
    )
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    ends = [end(c).alias(f"{name}_{c}") for c in columns for name, end in (("min", F.min), ("max", F.max))]
    zones = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"), *ends)
    zones.write.mode("overwrite").parquet(f"{path}/{ZONES}")


def zones_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{ZONES}")


def look_up(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> tuple[DataFrame, int, int]:
    """Rows whose columns lie within ``ranges`` (least, greatest), with how many files are read and how
    many there are: only files whose zones meet all ranges are opened, and the ranges are pushed
    to them as well, where statistics and Bloom filters skip row groups."""
    zones = zones_of(spark, path)
    meets = reduce(lambda a, b: a & b, [(F.col(f"min_{c}") <= high) & (F.col(f"max_{c}") >= low) for c, (low, high) in ranges.items()])
    within = reduce(lambda a, b: a & b, [F.col(c) == low if low == high else F.col(c).between(low, high) for c, (low, high) in ranges.items()])
    files = [r.file for r in zones.where(meets).select("file").collect()]  # of the files to open
    there = zones.count()
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.where(within), len(files), there


def bucketed_join(spark: SparkSession, left: str, right: str, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two catalog tables that are bucketed alike by ``keys``: neither is shuffled."""
    a, b = spark.table(left), spark.table(right)
    return a.hint("merge").join(b, list(keys), how)
