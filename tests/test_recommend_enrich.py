from decimal import Decimal

from marketscope.operators import enrich, recommend
from marketscope.sources import schemas as S


def sales(spark, rows):
    return spark.createDataFrame(rows, S.VENDAS_SCHEMA)


def test_sales_sum_rules(spark):
    df = sales(spark, [
        ("i1", "f", "fc", "c1", "cl", Decimal("1.10")),
        ("i1", "f", "fc", "c1", "cl", Decimal("2.20")),
        ("i2", None, "fc", "c1", "cl", Decimal("5.00")),   # NULL key: dropped
        ("i3", "f", "fc", "c1", "cl", None),               # all-NULL sum: 0.0
    ])
    got = {r["it-codigo"]: r.valor for r in recommend.sales_by_item(df).collect()}
    assert got == {"i1": 3.3, "i3": 0.0}
    assert recommend.sales_by_item(sales(spark, [])).count() == 0


def test_top5_tie_at_rank_five(spark):
    rows = [(f"i{k}", "f", "fc", "c1", "cl", Decimal(v)) for k, v in
            [(1, "10"), (2, "9"), (3, "8"), (4, "7"), (6, "5"), (5, "5")]]
    top = recommend.top_products(sales(spark, rows)).collect()
    assert sorted(r["it-codigo"] for r in top) == ["i1", "i2", "i3", "i4", "i5"]


def test_flags_and_regime(spark):
    rows = spark.createDataFrame([("c1", "r1"), ("c2", "r2"), ("c3", "r3")], "cnpj string, cnpj_basico string")
    leads = spark.createDataFrame([("c1", None), ("c1", None), (None, None)], S.LEADS_SCHEMA)
    flagged = {r.cnpj: r.possui_lead for r in enrich.membership_flag(rows, leads, "possui_lead").collect()}
    assert flagged == {"c1": 1, "c2": 0, "c3": 0}
    simples = spark.createDataFrame([("r1", "S", "", "", "S", "", ""), ("r2", "N", "", "", "N", "", "")],
                                    S.REGISTRY_SCHEMAS["simples"])
    reg = {r.cnpj: r.id_regime_tributario for r in enrich.regime_enrichment(rows, simples).collect()}
    assert reg == {"c1": 1, "c2": 3, "c3": None}


def test_fact_size_blank_vs_missing(spark):
    active = spark.createDataFrame([("c1", "x", "m", "r1", "n1"), ("c2", "x", "m", "r2", "n2")],
                                   "cnpj string, cnae_fiscal string, municipio string, cnpj_basico string, nome_fantasia string")
    targets = active.select("cnpj")
    empresas = spark.createDataFrame([("r1", "A", "", "", "", "", 0.0)],
                                     "cnpj_basico string, razao_social string, natureza_juridica string, "
                                     "qualificacao_responsavel string, porte_empresa string, "
                                     "ente_federativo_responsavel string, capital_social double")
    simples = spark.createDataFrame([], S.REGISTRY_SCHEMAS["simples"])
    leads = spark.createDataFrame([], S.LEADS_SCHEMA)
    vend = spark.createDataFrame([], S.VENDAS_SCHEMA)
    fact = {r.cnpj: r for r in enrich.fact_base(active, targets, empresas, simples, leads, vend).collect()}
    assert fact["c1"].porte_empresa == "" and fact["c2"].porte_empresa == "00"
    assert fact["c1"].id_regime_tributario is None
