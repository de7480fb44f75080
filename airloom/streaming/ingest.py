"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airloom.functions.expr import epoch_micros, floor_hour
from airloom.session import materialize
from airloom.sources.tables import Table


def upsert_stream(
    rows: DataFrame, table: Table, checkpoint: str, *, seq: str | None = None,
    keys: tuple[str, ...] = ("city", "ts"), prepare: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append", keep: str = "last",
) -> StreamingQuery:
    """Upsert each micro-batch into ``table``; stops when all present input is taken.

    With ``keep="first"`` a stored key is never rewritten, and within a batch the row with the
    lowest ``seq`` comes first.

    A batch that is replayed after a failure writes the same rows again, so the result is
    the same as if it had run once.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        # Stored once: the upsert reads it more than once, the stream's plan should not run again.
        table.upsert(materialize(prepare(batch) if prepare else batch), keys=keys, seq=seq, keep=keep)

    return (
        rows.writeStream.foreachBatch(write).outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_readings(
    events: DataFrame, value: str = "value", *, order: str = "ts", late: str = "1 hour",
    keys: tuple[str, ...] = ("city",),
) -> DataFrame:
    """Hourly count, sum, mean, min and max of an event stream or table.

    On a stream, events later than ``late`` are dropped and an hour is emitted once the
    watermark passes its end. Times are taken as UTC.
    """
    timed = events.withColumn("_at", F.col(order).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_at", late)
    return timed.groupBy(*keys, F.window("_at", "1 hour").alias("_hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"),
        F.min(value).alias("low"), F.max(value).alias("high"),
    ).select(
        *keys, F.col("_hour.start").cast("timestamp_ntz").alias("ts"),
        "n", "total", "mean", "low", "high",
    )


def fold_hours(
    events: DataFrame, table: Table, late_path: str, batch_id: int, *, value: str = "value", order: str = "ts",
    late_seconds: int = 3600, keys: tuple[str, ...] = ("city",),
) -> None:
    """Add one batch of events to the hourly rows of ``table``; events of closed hours go to ``late_path``.

    The watermark trails the latest time of all earlier batches by ``late_seconds``; an hour is closed once it
    ends at the watermark or before. Rows, watermark and batch number change in one snapshot, and the late
    events of a batch have a folder of their own, so a batch that runs again changes nothing. Events without a
    time belong to no hour and go aside with the late ones.
    """
    state = table.snapshot() or {}
    marks = state.get("marks", {})
    if marks.get("batch", -1) >= batch_id:
        return
    batch = materialize(events)
    watermark, micros = marks.get("watermark"), epoch_micros(order)
    hour = floor_hour(order)
    if watermark is None:
        closed = F.col(order).isNull()
    else:
        closed = F.coalesce(epoch_micros(hour) + 3_600_000_000 <= F.lit(watermark), F.lit(True))
    batch.filter(closed).write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
    newest = batch.agg(F.max(micros)).first()[0]
    known = [w for w in (watermark, None if newest is None else newest - late_seconds * 1_000_000) if w is not None]
    counted = batch.filter(~closed).groupBy(*keys, hour.alias("ts")).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"), F.sum(value).alias("total"), F.min(value).alias("low"),
        F.max(value).alias("high"))
    kinds = dict(counted.dtypes)

    def added(old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.select(*new.columns).unionByName(new)
        return both.groupBy(*keys, "ts").agg(
            *[F.sum(c).cast(kinds[c]).alias(c) for c in ("n", "n_values", "total")], F.min("low").alias("low"), F.max("high").alias("high"))

    table.fold(counted, added, marks={"batch": batch_id, "watermark": max(known, default=None)})


def hours_with_late(
    events: DataFrame, table: Table, late_path: str, checkpoint: str, **options,
) -> StreamingQuery:
    """Hourly aggregation whose late events are kept instead of lost; stops when all present input is taken.

    ``table`` gets (keys, ``ts``, n, n_values, total, low, high), ``late_path`` the late events with the number of their
    ``batch``. Only sums are merged, so no state is held between batches. See ``fold_hours``.
    """
    return (
        events.writeStream.foreachBatch(lambda batch, n: fold_hours(batch, table, late_path, n, **options))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def first_by_key(
    events: DataFrame, *, keys: tuple[str, ...] = ("city", "ts"), order: str = "ts",
    late: str = "1 hour",
) -> DataFrame:
    """Keep the first arrival of each key within the watermark."""
    timed = events.withColumn("_at", F.col(order).cast("timestamp")).withWatermark("_at", late)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def late_rows(run: StreamingQuery) -> int:
    """Rows that the watermark has dropped so far; an aggregation counts them after summing up
    each task's share of a group."""
    return sum(
        op.numRowsDroppedByWatermark for p in run.recentProgress for op in p.stateOperators
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder; stops when all present input is taken."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )
