"""The activity list of a supplier holds every brand it sold, in the registry view and in the SQL."""

import pytest

from marketscope.sources import fixtures
from tests.oracle_compare import duck

BRANDS = [f"Brand#{i}" for i in range(1, 13)]


@pytest.fixture(scope="module")
def sold(spark, tmp_path_factory):
    """Two customers, six suppliers; every supplier sells all twelve brands, customer 1 buys two of them."""
    at = str(tmp_path_factory.mktemp("sold"))
    lines = [(i % 2, b, s, (b + s) % 7) for i, (s, b) in enumerate((s, b) for s in range(6) for b in range(12))]
    tables = {
        "nation": ([(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(0, "c0", 0, 5.0, "AUTO"), (1, "c1", 1, 5.0, "BUILD")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(s, f"s{s}", s % 2, 7.0) for s in range(6)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(i, b, "T") for i, b in enumerate(BRANDS)], "p_partkey long, p_brand string, p_type string"),
        "orders": ([(0, 0), (1, 1)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(o, b, s, float(v)) for o, b, s, v in lines], "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def test_every_brand_sold_is_listed(spark, sold):
    rows = fixtures.raw_tables(spark, sold)["estabelecimento"].where("nome_fantasia LIKE 's%'").collect()
    assert len(rows) == 6 and all(set(r.cnae_fiscal_secundaria.split(",")) == set(BRANDS) for r in rows)


@pytest.mark.parametrize("name", ["g1_explode_codes", "s1_registry_csv_roundtrip"])
def test_sql_has_every_brand_sold(sold, name):
    from marketscope.plans.oracle import oracle_queries

    con = duck("/nowhere")
    for table in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sold}/{table}.parquet/*.parquet')")
    got = con.execute(f"SELECT cnae_fiscal_secundaria FROM ({oracle_queries()[name]}) q").fetchall()
    whole = sum(len(r[0].split(",")) for r in got)
    assert whole == 6 * len(BRANDS) + 2 * len(BRANDS) // 2     # the customers buy every other brand each
