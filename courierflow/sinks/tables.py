"""Replay-safe appends, table layout and event output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

RUN, BATCH = "_run", "_batch_id"


def append_batch(
    df: DataFrame,
    path: str,
    run: str,
    batch_id: int,
    partition_by: Sequence[str] = ("ingest_date",),
    files: int | None = None,
) -> None:
    """Append one micro-batch so that writing it again changes nothing.

    The run and the batch are part of the partition path, and only partitions present in
    ``df`` are overwritten. All partition columns must come out the same on a replay.
    ``run`` is the streaming query's id: a new checkpoint numbers its batches from 0 again
    and must not replace the old ones. ``files`` bounds the files of a low-volume topic.
    """
    stamped = df.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")})
    if files:
        stamped = stamped.coalesce(files)
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, RUN, BATCH)
        .parquet(path)
    )


def transaction_options(run: str, batch_id: int) -> dict[str, str]:
    """Options by which a transactional table format skips a batch that it has committed, and
    takes on columns that a new schema version adds."""
    return {"txnAppId": run, "txnVersion": str(batch_id), "mergeSchema": "true"}


def append_transaction(
    df: DataFrame,
    path: str,
    run: str,
    batch_id: int,
    table_format: str,
    partition_by: Sequence[str] = ("ingest_date",),
    options: dict[str, str] | None = None,
) -> None:
    """Append one micro-batch to a table of a transactional format, which needs no run and batch
    folders: a replay is the format's own business."""
    writer = df.write.format(table_format).mode("append").options(**transaction_options(run, batch_id), **(options or {}))
    writer.partitionBy(*partition_by).save(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Write files sorted and ranged by ``keys`` (entity, then time), so that min/max
    statistics let a key lookup skip most files. The range split samples rows, so a hot
    entity spreads over several files as long as time is among the keys."""
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], sort_by: Sequence[str], buckets: int) -> None:
    """Write a catalog table bucketed by ``keys``: joins and aggregates on the keys of tables
    with the same bucketing need no shuffle. Not for tables with hot keys, as a bucket is
    read by one task; those are better clustered by key and time."""
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*sort_by)
        .option("path", path)
        .saveAsTable(table)
    )


def compact(df: DataFrame, path: str, partition_by: Sequence[str] = ("ingest_date",)) -> None:
    """Write many small batch files as few large ones, to a new location.

    ``rebalance`` lets adaptive execution merge the pieces of small days and split big ones,
    to the advisory partition size.
    """
    tidy = df.drop(RUN, BATCH).hint("rebalance", *partition_by)
    tidy.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def as_messages(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as ``key``/``value`` messages with every field present, NULL or not."""
    body = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def console_rows(mode: str, options: dict[str, str] | None) -> None:
    if mode == "console" and "numRows" not in (options or {}):
        raise ValueError("the console needs the option numRows: it shows no more rows than that")


def emit(messages: DataFrame, mode: str, target: str | None = None, options: dict[str, str] | None = None) -> None:
    """Write messages to ``kafka``, ``file`` (JSON lines of the values) or ``console``.

    The console shows as many rows as the option ``numRows`` says, so it has to be given.
    """
    console_rows(mode, options)
    writer = messages.write.options(**(options or {}))
    if mode == "kafka":
        writer.format("kafka").save()
    elif mode == "file":
        messages.select("value").write.mode("append").text(target)
    elif mode == "console":
        writer.format("console").option("truncate", "false").mode("append").save()
    else:
        raise ValueError(f"unknown output mode {mode!r}: use kafka, file or console")


def emit_stream(
    messages: DataFrame, mode: str, checkpoint: str, target: str | None = None, options: dict[str, str] | None = None
) -> DataStreamWriter:
    """Streaming twin of ``emit``; set a trigger on the result and start it."""
    if mode not in ("kafka", "file", "console"):
        raise ValueError(f"unknown output mode {mode!r}: use kafka, file or console")
    console_rows(mode, options)
    rows = messages.select("value") if mode == "file" else messages
    writer = rows.writeStream.options(**(options or {})).option("checkpointLocation", checkpoint)
    return writer.format("text").option("path", target) if mode == "file" else writer.format(mode)
