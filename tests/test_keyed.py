"""Look-ups in tables bucketed by key."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.compare import plan_of, spark_rows
from weblens.sources import keyed_lookup, open_keyed_table, table_key_lookup, write_keyed_table

BUCKETS = 16


@pytest.fixture(scope="module")
def keyed(spark, tmp_path_factory):
    """A table where one key holds a third of the rows and some rows have none."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 400 END")
    rows = spark.range(6000).select(key.alias("k"), F.col("id").alias("v"))
    path = str(tmp_path_factory.mktemp("keyed")) + "/t"
    name = "keyed_" + uuid.uuid4().hex
    write_keyed_table(rows, name, path, "k", BUCKETS)
    yield rows, name, path
    spark.sql(f"DROP TABLE {name}")


KEYS = [[7], [1, 2, 2, None], [None], [], [399, 100_000], list(range(400))]


@pytest.mark.parametrize("keys", KEYS)
def test_rows_are_those_of_a_scan(spark, keyed, keys):
    rows, name, _ = keyed
    want = spark_rows(table_key_lookup(rows, "k", keys))
    assert spark_rows(keyed_lookup(spark.table(name), "k", keys)) == want
    frame = spark.createDataFrame([(k,) for k in keys], "other long")
    for most in (0, 10_000):
        assert spark_rows(keyed_lookup(spark.table(name), "k", frame, most_named=most)) == want


def test_few_buckets_are_selected(spark, keyed):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = plan_of(keyed_lookup(spark.table(keyed[1]), "k", [11, 12]))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert f"SelectedBucketsCount: 2 out of {BUCKETS}" in plan or f"SelectedBucketsCount: 1 out of {BUCKETS}" in plan


def test_a_join_leaves_the_table_where_it_is(spark, keyed):
    keys = spark.range(300).select((F.col("id") * 2).alias("k"))
    hint = keyed_lookup(spark.table(keyed[1]), "k", keys.hint("merge"), most_named=10)
    assert plan_of(hint).count("hashpartitioning(k") <= 2


def test_some_columns_and_another_session(spark, keyed):
    rows, name, path = keyed
    again = name + "_again"
    table = open_keyed_table(spark, again, path, "k", BUCKETS, spark.table(name).schema)
    got = keyed_lookup(table, "k", [7], ["v"])
    assert got.columns == ["v"]
    assert spark_rows(got) == spark_rows(rows.where("k = 7").select("v"))
    spark.sql(f"DROP TABLE {again}")
    assert spark.table(name).count() == rows.count()
