"""Line dedup against a brute-force rule, over several batches and compactions."""

import random

import pytest
from pyspark.sql import functions as F

from weblens.llm.line_dedup import LineRuns, dedup_lines, line_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, text in sorted(rows, key=lambda r: order(r[0])):
        for line in (text or "").split("\n"):
            first.setdefault(key_of(line), i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or first[key_of(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


def make_rows():
    rng = random.Random(1)
    lines = [f"line number {i} is long" for i in range(30)] + ["short", "", "ÉCOLE À PARIS ", "école à paris"]
    rows = []
    for i in range(60):
        chosen = [rng.choice(lines) for _ in range(rng.randint(0, 8))] + ["Everywhere  the same"] * (i % 3)
        rows.append((i, rng.choice(["\n", "\n \t", "\r\n"]).join(x.upper() if i % 5 == 0 else x for x in chosen)))
    return [*rows, rows[7], (7, "line number 1 is long"), (None, "line number 2 is long\nnew line here"),
            (None, "new line here"), (None, None), (80, ""), (81, None), (82, "\n\n")]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (7, 3)])
def test_against_the_rule(spark, batches, fanout):
    rows = make_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS `n_lines`", "1 AS `odd.name`")
    got = dedup_lines(docs.repartition(3), batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "text", "n_lines", "odd.name", "n_dropped"]
    got = got.select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_runs_are_compacted_and_disjoint(spark):
    runs = LineRuns(spark, fanout=2)
    docs = spark.createDataFrame([(i, f"common line {i % 4}\nown line {i:04d}") for i in range(40)], "doc_id long, text string")
    for low in range(0, 40, 8):
        lines = line_hashes(docs.where(F.col("doc_id").between(low, low + 7)), "doc_id", "text", 10)
        runs.add(lines.groupBy("__h1", "__h2").agg(F.min("__doc").alias("__first")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    union = runs.tables()[0].unionByName(runs.tables()[1])
    assert union.count() == 44 == union.select("__h1", "__h2").distinct().count()


def test_runs_are_read_without_a_shuffle(spark):
    runs = LineRuns(spark)
    keys = spark.range(50).selectExpr("id AS __h1", "id AS __h2", "id AS __first")
    run = runs.add(keys)
    from tests.compare import plan_of

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = keys.groupBy("__h1", "__h2").agg(F.min("__first").alias("__first"))
        plan = plan_of(batch.join(run, ["__h1", "__h2"], "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange (") <= 1 + plan.count("ReusedExchange") and "Bucketed: true" in plan


def test_empty_table_and_one_row(spark):
    docs = spark.createDataFrame([(1, "x\n" * 500)], "doc_id long, text string")
    assert dedup_lines(docs.limit(0)).count() == 0
    assert dedup_lines(docs).first().text == "x\n" * 500
