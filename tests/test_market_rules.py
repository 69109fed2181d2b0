from pyspark.sql import functions as F

from marketscope.functions import full_id
from marketscope.operators import market
from marketscope.plans.queries import model
from marketscope.sources import schemas as S

SF = "/root/testdata/sf0.001"


def _active(spark, rows):
    return spark.createDataFrame(rows, "cnpj string, cnae_fiscal string, municipio string, "
                                       "cnpj_basico string, nome_fantasia string")


def test_blank_code_parity_and_opt_out(spark):
    active = _active(spark, [("c1", "", "m", "r1", "a"), ("c2", "", "m", "r2", "b"),
                             ("c3", "0111", "m", "r3", "c"), ("c4", "0222", "m", "r4", "d")])
    sales = spark.createDataFrame([("i", "f", "fc", "c1", "x", None), ("i", "f", "fc", "c3", "x", None)],
                                  S.VENDAS_SCHEMA)
    codes = market.client_codes(active, sales)
    assert sorted(r.cnae for r in codes.collect()) == ["", "0111"]          # '' is not NULL
    assert sorted(r.cnpj for r in market.target_market(active, codes).collect()) == ["c1", "c2", "c3"]
    fixed = market.client_codes(active, sales, drop_blank_codes=True)
    assert sorted(r.cnpj for r in market.target_market(active, fixed).collect()) == ["c3"]


def test_target_rows_keep_every_row_of_a_target_id(spark):
    # the same id twice: one row in a customer code, one not -> both kept
    active = _active(spark, [("c1", "0111", "m", "r1", "a"), ("c1", "0999", "m", "r1", "a2"),
                             ("c2", "0999", "m", "r2", "b")])
    codes = spark.createDataFrame([("0111",)], "cnae string")
    rows = market.target_rows(active, market.target_market(active, codes))
    assert sorted(r.nome_fantasia for r in rows.collect()) == ["a", "a2"]


def test_full_id_null_propagates(spark):
    df = spark.createDataFrame([("1", "0001", None), ("1", "0001", "00")],
                               "cnpj_basico string, cnpj_ordem string, cnpj_dv string")
    assert [r.c for r in df.select(full_id().alias("c")).collect()] == [None, "100010" + "0"]


def test_dim_municipality_grain_and_fact_size(spark):
    m = model(spark, SF)
    dim = m.dim_municipio
    assert dim.count() == 135 and dim.select("municipio").distinct().count() == 24
    assert m.fact.count() == m.targets.count() == 146
    assert m.fact.where(F.col("atual_cliente") == 1).where(F.col("cnpj_mais_similar").isNotNull()).count() == 0
