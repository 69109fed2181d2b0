import pytest

from tests.oracle_compare import compare, duck

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 146
    assert df.columns[-2:] == ["cnpj_mais_similar", "similaridade"]


def test_every_query_has_an_oracle():
    from __spark_entry__ import QUERIES, oracle_sql, queries
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def _names():
    from marketscope.plans.queries import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, name):
    from __spark_entry__ import oracle_sql, queries
    res = compare(spark, SF01, name, queries()[name], oracle_sql()[name], duck(SF01))
    assert res["status"] == "match", res


def test_similarity_scores_differ(spark):
    """The fixture can tell a right similarity from a wrong one: many scores, most below 1."""
    from __spark_entry__ import queries
    scores = [r.similaridade for r in queries()["m1_most_similar"](spark, SF01).collect()]
    assert len(set(scores)) >= 10 and sum(s < 1 for s in scores) > 0.9 * len(scores)


def test_plans(spark):
    from __spark_entry__ import queries
    q = queries()
    w1 = q["w1_top5_products"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in w1
    for name in ("m2_fact_companies", "w1_top5_products", "d1_dim_activity", "b1_star_view"):
        plan = q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
