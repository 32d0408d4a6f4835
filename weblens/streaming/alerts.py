"""New errors of a stream, batch by batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weblens import schema as S
from weblens.operators.alerts import new_error_rows
from weblens.streaming.batches import read_all_batches, read_batch, write_batch
from weblens.streaming.parse import REFRESH

STATE_SCHEMA = T.StructType(
    [
        T.StructField("high_water", T.TimestampNTZType()),
        T.StructField("error_count", T.LongType()),
    ]
)


def watch_new_errors(
    logs: DataFrame,
    alerts: str,
    state: str,
    checkpoint: str,
    levels: Iterable[str] = S.ERROR_LEVELS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start writing errors later than all clocks of earlier batches to `alerts`.

    The first batch sets the mark and alerts nothing. `state` gets one row per batch: the
    newest clock and the number of errors so far. A repeated batch starts from the row of
    the batch before it and overwrites its own, so it ends the same.
    """
    levels = list(levels)

    def look(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_batch(spark, state, batch_id - 1, STATE_SCHEMA)
        last = before.first() if before is not None else None
        mark = last.high_water if last else None
        batch = batch.persist()
        write_batch(new_error_rows(batch, mark, levels), alerts, batch_id)
        seen = batch.agg(
            F.greatest(F.max("ts"), F.lit(mark).cast("timestamp_ntz")).alias("high_water"),
            (F.count_if(F.col("error_level").isin(levels)) + (last.error_count if last else 0))
            .cast("bigint")
            .alias("error_count"),
        )
        write_batch(seen.coalesce(1), state, batch_id)
        batch.unpersist()

    return (
        logs.writeStream.foreachBatch(look)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or REFRESH))
        .start()
    )


def read_alerts(spark: SparkSession, alerts: str, schema: T.StructType) -> DataFrame:
    """All alerts so far with the batch that raised them."""
    return read_all_batches(spark, alerts, schema)


def error_delta_by_batch(spark: SparkSession, state: str) -> DataFrame:
    """Error count of every batch and its rise over the batch before, NULL when none.

    Batches are numbered without gaps, so each row finds the one before by its number.
    """
    now = read_all_batches(spark, state, STATE_SCHEMA).select("batch_id", "error_count")
    before = now.select(
        (F.col("batch_id") + 1).alias("batch_id"), F.col("error_count").alias("previous_count")
    )
    rise = F.col("error_count") - F.coalesce("previous_count", F.lit(0))
    return now.join(before, "batch_id", "left").withColumn("delta", F.when(rise > 0, rise))
