"""File streams (the broker-free twin of the Kafka source) and tolerant table reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Stream the files of a folder or glob in order of modification time."""
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a table folder; a table nobody has written yet reads as empty."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
