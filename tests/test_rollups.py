"""Rollups against the operators over all rows, whatever the order of the batches."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from weblens import operators as ops
from weblens import schema as S
from weblens import streaming
from weblens.streaming import levels, rollups

START = datetime(2024, 3, 1)
SCHEMA = "ts timestamp_ntz, error_level string, status_code int, ip string, raw string"


def some_batch(n, rng):
    rows = []
    for _ in range(rng.randrange(0, 60)):
        ts = START + timedelta(minutes=rng.randrange(7000)) if rng.random() < 0.9 else None
        level = rng.choice([*S.ERROR_LEVELS, "INFO", None])
        status = rng.choice([200, 302, 404, 503, 99, None])
        rows.append((ts, level, status, rng.choice([None, f"10.0.{n}.{rng.randrange(40)}"]), "x"))
    return rows


def same(spark, target, batches):
    logs = spark.createDataFrame([r for rows in batches.values() for r in rows], SCHEMA)
    counts = streaming.rollup_counts(spark, target)
    for name in ("hourly_traffic", "errors_by_hour_level", "status_class_breakdown"):
        kept = getattr(streaming, f"rollup_{name}")(counts)
        assert spark_rows(kept) == spark_rows(getattr(ops, name)(logs)), name
    kept = streaming.rollup_kpis(counts)
    assert spark_rows(kept) == spark_rows(ops.kpi_summary(logs).drop("unique_ips"))
    return logs


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_repeated_batches(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(levels, "FANOUT", 2)
    rng = random.Random(seed)
    target, batches = str(tmp_path / "r"), {}
    order = list(range(9))
    if seed == 2:
        rng.shuffle(order)
    for n in order:
        batches[n] = some_batch(n, rng)
        streaming.add_batch(spark.createDataFrame(batches[n], SCHEMA), target, n)
    same(spark, target, batches)
    covering = levels.covering_runs(spark, f"{target}/counts")
    assert covering == [(0, 8), (3, 0)]
    # A batch whose run is part of merged ones comes again with other rows.
    batches[3] = some_batch(3, rng)
    streaming.add_batch(spark.createDataFrame(batches[3], SCHEMA), target, 3)
    logs = same(spark, target, batches)
    assert levels.covering_runs(spark, f"{target}/counts") == covering
    exact = ops.unique_ips(logs).first().unique_ips
    kept = streaming.rollup_unique_ips(spark, target).first().unique_ips
    assert abs(kept - exact) <= max(1, 0.03 * exact)


def test_a_job_that_died_between_levels(spark, tmp_path, monkeypatch):
    """Without the merged runs the lower ones say the same; the next batch merges again."""
    monkeypatch.setattr(levels, "FANOUT", 2)
    rng, target = random.Random(5), str(tmp_path / "r")
    batches = {n: some_batch(n, rng) for n in range(4)}
    for n, rows in batches.items():
        streaming.add_batch(spark.createDataFrame(rows, SCHEMA), target, n)
    path = f"{target}/counts"
    levels._remove(spark, levels.run_path(path, 1, 1))
    levels._remove(spark, levels.run_path(path, 2, 0))
    assert levels.covering_runs(spark, path) == [(0, 2), (0, 3), (1, 0)]
    same(spark, target, batches)
    streaming.add_batch(spark.createDataFrame(batches[3], SCHEMA), target, 3)
    assert levels.covering_runs(spark, path) == [(2, 0)]
    same(spark, target, batches)


def test_clients_over_days(spark, tmp_path):
    """The error of the sketches, against the exact numbers: within 3 percent."""
    target = str(tmp_path / "r")
    rows = spark.range(0, 60_000).select(
        F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 6)").alias("ts"),
        F.lit("INFO").alias("error_level"),
        F.lit(200).alias("status_code"),
        F.concat(F.lit("10."), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("ip"),
    )
    for n in range(3):
        streaming.add_batch(rows.where(F.pmod(F.xxhash64("ip", "ts"), F.lit(3)) == n), target, n)
    for first, last in ((date(2024, 3, 1), date(2024, 3, 1)), (date(2024, 3, 2), date(2024, 3, 4)), (None, None)):
        logs = ops.filter_date_range(rows, first, last)
        exact = logs.agg(F.count_distinct("ip")).first()[0]
        kept = streaming.rollup_unique_ips(spark, target, first, last).first().unique_ips
        assert abs(kept - exact) <= 0.03 * exact
    assert streaming.rollup_unique_ips(spark, target, date(2030, 1, 1)).first().unique_ips == 0


def test_nothing_yet(spark, tmp_path):
    target = str(tmp_path / "none")
    counts = streaming.rollup_counts(spark, target)
    assert counts.count() == 0 and streaming.rollup_kpis(counts).first().total_requests == 0
    assert streaming.rollup_unique_ips(spark, target).first().unique_ips == 0
    assert rollups.rollup_daily_ips(spark, target).count() == 0


def test_batches_look_at_their_neighbours_only(spark, tmp_path, monkeypatch):
    """What a batch costs does not grow with the batches before it."""
    monkeypatch.setattr(levels, "_done", lambda *_: pytest.fail("all runs were listed"))
    target = str(tmp_path / "r")
    batch = spark.createDataFrame(some_batch(1, random.Random(2)), SCHEMA)
    for n in range(levels.FANOUT):
        streaming.add_batch(batch, target, n)
    monkeypatch.undo()
    assert levels.covering_runs(spark, f"{target}/counts") == [(1, 0)]


def test_streams_shuffle_into_few_parts(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    seen = []
    try:
        logs = spark.readStream.format("rate").load().selectExpr("value")
        write = logs.writeStream.option("checkpointLocation", str(tmp_path))
        write = write.foreachBatch(lambda df, n: seen.append(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        from weblens.streaming.batches import start_narrow

        query = start_narrow(spark, 3, write.start)
        query.processAllAvailable()
        query.stop()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50" and set(seen) == {"3"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_larger_logs_are_streamed_in_larger_files():
    from registry import lines as L

    sizes = {n: L.streamed_lines_per_file(n) for n in (0, 100_000, 6_000_000, 36_000_000, 10**9)}
    assert sizes == {0: 2500, 100_000: 2500, 6_000_000: 37_500, 36_000_000: 225_000, 10**9: 500_000}
