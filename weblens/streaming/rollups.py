"""Counts of a stream kept up to date batch by batch, instead of recounted.

Two small tables are kept, each merged in levels:

- `counts`: rows by hour, level and status class, with the first and last clock;
- `clients`: by day a sketch of the distinct clients, of fixed size, which can be united over
  any days. A day and each of its sketches is one row.

A batch adds one row per group, whatever its size; a batch that runs again replaces its own.
The results are those of the operators of the same names over all rows, but for distinct clients,
which are estimated (with the standard error of `SKETCH_BITS`; the exact count needs all
rows).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weblens import schema as S
from weblens.operators.metrics import hour_of
from weblens.streaming.batches import start_narrow
from weblens.streaming.levels import read_runs, write_run
from weblens.streaming.parse import REFRESH

# 2**14 registers: a standard error of about 0.8 percent, at most 16 KB a sketch.
SKETCH_BITS = 14

# Parts of a batch's shuffles: one task writes the groups of a batch in any case.
BATCH_PARTS = 4

COUNTS = T.StructType(
    [
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("error_level", T.StringType()),
        T.StructField("status_class", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_ts", T.TimestampNTZType()),
        T.StructField("last_ts", T.TimestampNTZType()),
    ]
)
CLIENTS = T.StructType(
    [T.StructField("day", T.DateType()), T.StructField("sketch", T.BinaryType())]
)
GROUP = ("hour", "error_level", "status_class")


def count_rows(logs: DataFrame) -> DataFrame:
    """A batch's rows of `counts`."""
    hundreds = F.floor(F.col("status_code") / 100).cast("string")
    keyed = logs.select(
        hour_of(F.col("ts")).alias("hour"),
        "error_level",
        F.concat(hundreds, F.lit("xx")).alias("status_class"),
        "ts",
    )
    return keyed.groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def merge_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )


def sketch_clients(logs: DataFrame) -> DataFrame:
    """A batch's rows of `clients`; rows without a client are left out."""
    known = logs.where(F.col("ip").isNotNull()).select(F.to_date("ts").alias("day"), "ip")
    return known.groupBy("day").agg(F.hll_sketch_agg("ip", SKETCH_BITS).alias("sketch"))


def merge_clients(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day").agg(F.hll_union_agg("sketch").alias("sketch"))


def add_batch(logs: DataFrame, target: str, batch_id: int) -> None:
    """Add the rows of a batch to the rollups at `target`, or replace what it added before."""
    spark = logs.sparkSession
    needed = logs.select("ts", "error_level", "status_code", "ip").persist()
    write_run(spark, count_rows(needed), f"{target}/counts", batch_id, merge_counts)
    write_run(spark, sketch_clients(needed), f"{target}/clients", batch_id, merge_clients)
    needed.unpersist()


def stream_rollups(
    logs: DataFrame, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start keeping the rollups of a parsed stream at `target`."""
    writer = (
        logs.writeStream.foreachBatch(lambda batch, batch_id: add_batch(batch, target, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or REFRESH))
    )
    return start_narrow(logs.sparkSession, BATCH_PARTS, writer.start)


def rollup_counts(spark: SparkSession, target: str) -> DataFrame:
    """Rows by hour, level and status class; rows without a clock have no hour."""
    return merge_counts(read_runs(spark, f"{target}/counts", COUNTS))


def rollup_hourly_traffic(counts: DataFrame) -> DataFrame:
    """`hourly_traffic` out of `rollup_counts`."""
    known = counts.where(F.col("hour").isNotNull())
    return known.groupBy("hour").agg(F.sum("n").alias("requests"))


def rollup_errors_by_hour_level(
    counts: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS
) -> DataFrame:
    """`errors_by_hour_level` out of `rollup_counts`."""
    errors = counts.where(F.col("hour").isNotNull() & F.col("error_level").isin(list(levels)))
    return errors.groupBy("hour", "error_level").agg(F.sum("n").alias("n"))


def rollup_status_class_breakdown(counts: DataFrame) -> DataFrame:
    """`status_class_breakdown` out of `rollup_counts`."""
    known = counts.where(F.col("status_class").isNotNull())
    return known.groupBy("status_class").agg(F.sum("n").alias("requests"))


def _sum(n: Column) -> Column:
    return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")


def rollup_kpis(counts: DataFrame, levels: Iterable[str] = S.ERROR_LEVELS) -> DataFrame:
    """`kpi_summary` out of `rollup_counts`, without the distinct clients."""
    is_error = F.col("error_level").isin(list(levels))
    errors = _sum(F.when(is_error, F.col("n")))
    rate = F.coalesce(F.try_divide(errors, _sum(F.col("n"))) * 100, F.lit(0.0))
    span = F.extract(F.lit("DAY"), F.max("last_ts") - F.min("first_ts"))
    return counts.agg(
        _sum(F.col("n")).alias("total_requests"),
        errors.alias("error_count"),
        rate.alias("error_rate"),
        (F.count("first_ts") > 0).alias("has_timestamps"),
        span.cast("bigint").alias("time_span_days"),
    )


def rollup_unique_ips(
    spark: SparkSession, target: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Estimated distinct clients over the days from `start` to `end`, both included.

    Without bounds rows without a clock count too, as they do in `unique_ips`.
    """
    days = read_runs(spark, f"{target}/clients", CLIENTS)
    if start is not None:
        days = days.where(F.col("day") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("day") <= F.lit(end))
    united = days.agg(F.hll_union_agg("sketch").alias("sketch"))
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("bigint")
    return united.select(estimate.alias("unique_ips"))


def rollup_daily_ips(spark: SparkSession, target: str) -> DataFrame:
    """Estimated distinct clients of each day: `(day, unique_ips)`."""
    days = merge_clients(read_runs(spark, f"{target}/clients", CLIENTS))
    known = days.where(F.col("day").isNotNull())
    return known.select("day", F.hll_sketch_estimate("sketch").alias("unique_ips"))
