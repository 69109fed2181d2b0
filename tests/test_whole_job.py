"""Queries on the code lists work on whole lists: a supplier's list holds every brand it sold, in Spark and in the SQL.

Own rows: customers c1 and c2, suppliers s0 and s5, one nation and one activity. s0 sold the brands 11 to 14, s5 11 and 12.
Order 3 is of a customer and brand 15 of a supplier that the tables do not hold.
"""

import datetime
import random

import pytest

from tests.oracle_compare import duck, rows_of

C1, C2, S0, S5 = "00000000000200", "00000001000100", "50000000000100", "50000002000200"
LISTS = {"c1": [11, 13], "c2": [12, 15], "s0": [11, 12, 13, 14], "s5": [11, 12]}
IDS = {"c1": C1, "c2": C2, "s0": S0, "s5": S5}
PRIMARY = "050000A"


def brands(company):
    return [f"Brand#{b}" for b in LISTS[company]]


def lists(*companies):
    return [(c, ",".join(brands(c))) for c in companies]


def write(spark, at, tables):
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def sql_of(at):
    con = duck("/nowhere")
    for table in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{at}/{table}.parquet/*.parquet')")
    return con


@pytest.fixture(scope="module")
def sold(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("whole")), {
        "nation": ([(1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c1", 1, 5.0, "AUTO"), (2, "c2", 1, 5.0, "AUTO")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "s0", 1, 7.0), (5, "s5", 1, 7.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(b, f"Brand#{b}", "T") for b in range(11, 16)], "p_partkey long, p_brand string, p_type string"),
        "orders": ([(1, 1), (2, 2), (3, 3)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(1, 11, 0, 10.0), (1, 13, 0, 20.0), (2, 12, 5, 300.0), (2, 15, 9, 400.0),
                      (3, 12, 0, 1.0), (3, 14, 0, 1.0), (3, 11, 5, 1.0)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double"),
        "events": ([(1, datetime.datetime(2023, 5, 1), 2, "signup")], "event_id long, ts timestamp, user_id long, event_type string"),
    })


# query -> columns looked at, and all its rows
WHOLE = {
    "g2_company_codes": (("cnpj", "code"), [(IDS[c], code) for c in LISTS for code in [PRIMARY, *brands(c)]]),
    "g3_code_signature": (("cnpj", "codigos", "n_codigos"),
                          [(IDS[c], ",".join([PRIMARY, *brands(c)]), 1 + len(LISTS[c])) for c in LISTS]),
    "m1_most_similar": (("cnpj", "cnpj_mais_similar", "similaridade"), [(S0, C1, 1.0), (S5, C1, 2 / 3)]),
    "m2_fact_companies": (("cnpj", "cnpj_mais_similar", "similaridade"), [(C1, None, None), (C2, None, None), (S0, C1, 1.0), (S5, C1, 2 / 3)]),
    "q3_legal_nature": (("nome_fantasia", "cnae_fiscal_secundaria"), lists("c2", "s0")),      # head offices only
    "b1_star_view": (("cnpj", "uf", "cnpj_mais_similar", "similaridade"),
                     [(C1, "U1", None, None), (C2, "U1", None, None), (S0, "U1", C1, 1.0), (S5, "U1", C1, 2 / 3)]),
    "b5_potential_revenue_by_region": (("uf", "prospects", "receita_potencial"), [("U1", 2, 60.0)]),      # twice what c1 bought
    "s1_registry_csv_roundtrip": (("nome_fantasia", "cnae_fiscal_secundaria"), lists(*LISTS)),
    "s7_parquet_roundtrip": (("cnpj", "cnpj_mais_similar", "similaridade"), [(C1, None, None), (C2, None, None), (S0, C1, 1.0), (S5, C1, 2 / 3)]),
    "s9_table_append": (("nome_fantasia", "cnae_fiscal_secundaria"), lists(*LISTS)),
    "s9_table_replace": (("nome_fantasia", "cnae_fiscal_secundaria"), lists("c1", "s5")),      # branches replace head offices
}


def rows(columns, found):
    return rows_of(list(columns), [tuple(r) for r in found])


@pytest.mark.parametrize("name", WHOLE)
def test_spark_works_on_whole_lists(spark, sold, name):
    from marketscope.plans.queries import QUERIES

    columns, want = WHOLE[name]
    assert rows(columns, QUERIES[name](spark, sold).select(*columns).collect()) == rows(columns, want)


@pytest.mark.parametrize("name", WHOLE)
def test_sql_works_on_whole_lists(sold, name):
    from marketscope.plans.oracle import oracle_queries

    columns, want = WHOLE[name]
    found = sql_of(sold).execute(f"SELECT {', '.join(columns)} FROM ({oracle_queries()[name]}) q").fetchall()
    assert rows(columns, found) == rows(columns, want)


def test_whole_lists_that_overlap_in_part(spark, tmp_path):
    """Suppliers that sold different brands: many scores, most below 1, the same in Spark and in the SQL."""
    from marketscope.plans.oracle import oracle_queries
    from marketscope.plans.queries import QUERIES

    r = random.Random(4)
    bought = [(c, b, 999) for c in range(1, 61) for b in r.sample(range(1, 26), r.randint(5, 9))]      # from a supplier not in the tables
    sells = [(0, b, s) for s in range(1, 41) for b in r.sample(range(1, 26), r.randint(3, 12))]         # to a customer not in the tables
    at = write(spark, str(tmp_path), {
        "nation": ([(1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"c{c}", 1, 5.0, "ABFHM"[c % 5:]) for c in range(1, 61)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(s, f"s{s}", 1, 7.0) for s in range(1, 41)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(b, f"Brand#{10 + b}", "T") for b in range(1, 26)], "p_partkey long, p_brand string, p_type string"),
        "orders": ([(c, c) for c in range(61)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(o, b, s, 1.0) for o, b, s in bought + sells],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double"),
        "events": ([(1, datetime.datetime(2023, 5, 1), 2, "signup")], "event_id long, ts timestamp, user_id long, event_type string"),
    })
    columns = ("cnpj", "cnpj_mais_similar", "similaridade")
    found = QUERIES["m1_most_similar"](spark, at).select(*columns).collect()
    assert len({x.similaridade for x in found}) >= 10 and sum(x.similaridade < 1 for x in found) > 0.8 * len(found) == 32
    want = sql_of(at).execute(f"SELECT {', '.join(columns)} FROM ({oracle_queries()['m1_most_similar']}) q").fetchall()
    assert rows(columns, found) == rows(columns, want)
