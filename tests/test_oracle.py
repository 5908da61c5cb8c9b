"""Every query with SQL gives the rows of that SQL, by a plan without Python or cross joins."""

import pytest

from roadpulse.plans import check, registry

SQL = registry.oracle_sql()
BANNED = ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    assert check.compare(df, duck, SQL[name]) is None
    if name != "knn_classify":
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [b for b in BANNED if b in plan]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(registry.queries())
