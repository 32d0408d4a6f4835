"""Searches through the trigram index against searches of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from weblens import operators as ops
from weblens.operators.search_index import candidate_files, grams_of, required_grams
from weblens.plans import parse_logs, store_logs

WORDS = ["checkout", "Straße", "cart/12", "Kelvin", "miſſ", "İstanbul", "a+b", "x|y", "(paid)", "naïve", "500", "  two", "tab\there"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, request):
    rng = random.Random(6)
    lines = []
    for day in range(1, 13):
        for n in range(40):
            words = " ".join(rng.choices(WORDS, k=3)) if day % 3 else f"quiet{day} {n}"
            lines.append(("a.log", day * 100 + n, f"2024-05-{day:02d} 10:00:{n:02d} INFO {words}"))
    raw = spark.createDataFrame(lines, "file_path string, line_no bigint, raw string")
    path = str(tmp_path_factory.mktemp("stored"))
    logs = parse_logs(raw, "generic")
    store_logs(logs, f"{path}/logs", rebalance=True)
    ops.build_search_index(spark, f"{path}/logs", f"{path}/index")
    return path, logs


def found(spark, stored, term, literal=False):
    path, logs = stored
    got = ops.search_stored(spark, f"{path}/logs", f"{path}/index", term, literal)
    want = ops.search_logs(logs, term, literal)
    assert spark_rows(got) == spark_rows(want.select(got.columns)), term
    return got


TERMS = [
    "checkout", "CHECKOUT", "kelvin", "miss", "istanbul", "quiet6", "nothing here", "cart/1[0-9]", "a\\+b", "x\\|y",
    "checkout|quiet9", "ab?c", "na.ve", "quiet[36] 1", "(paid)", "\\(paid\\)", "qu+iet3", "quiets?3", "\\bquiet", "500",
    "2024-05-06", "", "st", "ße", "tab\\there", "INFO", "10:00:1\\d", "[^x]quiet", "q{1,2}uiet", "two  *x", "\\Qa+b\\E",
]


@pytest.mark.parametrize("term", TERMS)
def test_terms(spark, stored, term):
    found(spark, stored, term)


@pytest.mark.parametrize("term", ["a+b", "x|y", "(paid)", "[a", "\\", "checkout 500", "ſſ"])
def test_literal_terms(spark, stored, term):
    found(spark, stored, term, literal=True)


def files_read(spark, stored, term):
    """Files opened by a search; the plan tells that of its first run only."""
    df = ops.search_stored(spark, f"{stored[0]}/logs", f"{stored[0]}/index", term)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numFiles").value() for m in scans if m.contains("numFiles"))


def test_files_that_cannot_match_are_not_opened(spark, stored):
    assert files_read(spark, stored, "quiet6") == 1
    assert files_read(spark, stored, "quiet3|quiet12") == 2
    assert files_read(spark, stored, "st") == 12
    assert files_read(spark, stored, "no such words") == 0


def test_what_terms_require():
    assert required_grams("checkout") == [grams_of("checkout")]
    assert required_grams("abc?d|xyz") is None  # `ab` and `d` are too short
    assert required_grams("abcd?|xyz") == [{"abc"}, {"xyz"}]
    assert required_grams("a.*b") is None and required_grams("(abc)?") is None
    assert required_grams("ab{2}cde") == [{"cde"}]


def test_files_added_later(spark, stored, tmp_path):
    """The index of some files, then of the others, is the index of all."""
    path, _ = stored
    names = [r.f for r in spark.read.parquet(f"{path}/logs").select(F.col("_metadata.file_path").alias("f")).distinct().collect()]
    for part in (names[:5], names[5:]):
        ops.build_search_index(spark, f"{path}/logs", f"{tmp_path}/i", spark.createDataFrame([(n,) for n in part], "file_path string"))
    both = [{tuple(r) for r in spark.read.parquet(p).collect()} for p in (f"{tmp_path}/i", f"{path}/index")]
    assert both[0] == both[1]
    assert candidate_files(spark, f"{tmp_path}/i", "quiet6").count() == 1
