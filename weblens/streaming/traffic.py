"""Live requests per minute over the last minutes of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weblens.operators.metrics import minute_of
from weblens.streaming.batches import read_all_batches, read_batch, start_narrow, write_batch
from weblens.streaming.parse import REFRESH

# Views are kept in a ring of folders: an hour of five-second batches, then reused.
RING = 720
# Clock values a part of the state is made for; each part is committed with every batch.
CLOCKS_PER_PART = 20_000

VIEW_SCHEMA = T.StructType(
    [
        T.StructField("view_id", T.LongType()),
        T.StructField("minutes", T.LongType()),
        T.StructField("ts_event", T.TimestampType()),
        T.StructField("requests", T.LongType()),
    ]
)


def stream_minute_traffic(
    logs: DataFrame,
    target: str,
    checkpoint: str,
    minutes: int = 5,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start keeping the last minutes of traffic of a parsed stream in a table at `target`.

    Counts are kept per clock value with a watermark one second longer, as a row right on
    the watermark counts as too late but one on the view's edge is part of it. Every batch
    writes the view before with the batch's counts in one job, which runs the state once. It
    leaves out what is older than the last minutes of the view before, which is written and so
    cheap to ask; readers cut at the view's own last minutes.
    """
    span = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    counts = (
        logs.where(F.col("ts").isNotNull())
        .select(F.col("ts").cast("timestamp").alias("ts_event"))
        .withWatermark("ts_event", f"{60 * int(minutes) + 1} seconds")
        .groupBy("ts_event")
        .agg(F.count("*").alias("requests"))
    )

    def refresh(changed: DataFrame, batch_id: int) -> None:
        before = read_batch(changed.sparkSession, target, (batch_id - 1) % RING, VIEW_SCHEMA)
        view = changed
        if before is not None:
            last = before.where(F.col("view_id") == batch_id - 1)
            edge = last.agg(F.max("ts_event") - span).scalar()
            view = changed.unionByName(last.select(changed.columns))
            view = view.where(F.coalesce(F.col("ts_event") >= edge, F.lit(True)))
        # A count only grows, so the largest one seen is the current one.
        view = view.groupBy("ts_event").agg(F.max("requests").alias("requests"))
        view = view.select(
            F.lit(batch_id).cast("bigint").alias("view_id"),
            F.lit(int(minutes)).cast("bigint").alias("minutes"),
            "ts_event",
            "requests",
        )
        write_batch(view, target, batch_id % RING)

    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or REFRESH))
    )
    parts = 1 + 60 * int(minutes) // CLOCKS_PER_PART
    return start_narrow(logs.sparkSession, parts, writer.start)


def live_minute_traffic(spark: SparkSession, target: str) -> DataFrame:
    """Requests per minute in the newest view: `(minute, requests)`."""
    views = read_all_batches(spark, target, VIEW_SCHEMA)
    newest = views.agg(F.max("view_id")).scalar()
    view = views.where(F.col("view_id") == newest)
    span = F.make_dt_interval(mins=F.col("minutes"))
    edge = view.agg(F.max(F.col("ts_event") - span)).scalar()
    return (
        view.where(F.coalesce(F.col("ts_event") >= edge, F.lit(True)))
        .groupBy(minute_of(F.col("ts_event").cast("timestamp_ntz")).alias("minute"))
        .agg(F.sum("requests").alias("requests"))
    )
