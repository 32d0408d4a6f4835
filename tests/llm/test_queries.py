"""The operators' queries against their SQL, on the smallest tables."""

import pytest

from tests.compare import duck, duck_rows, spark_rows
from weblens.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    want = duck_rows(duck(SF_DIR), ORACLE[name])
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == want


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    from tests.compare import plan_of

    for name in ("op4_decontamination", "op6_licences", "op7_line_dedup"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
