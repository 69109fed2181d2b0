import os

import pytest

from marketscope.plans import medallion
from marketscope.plans.queries import QUERIES
from marketscope.sources import export, fixtures, registry
from marketscope.sources import schemas as S

SF = "/root/testdata/sf0.001"


def _export_registry(spark, folder, zipped):
    raw = fixtures.raw_tables(spark, SF)
    for name, df in raw.items():
        archive = name.capitalize() if zipped else None
        export.write_registry_files(df.repartition(2), folder, S.REGISTRY_SUFFIX[name], archive=archive)


@pytest.mark.parametrize("zipped", [False, True])
def test_load_and_run_matches_queries(spark, tmp, zipped):
    src, tables_dir, out = (os.path.join(tmp, d) for d in ("src", "tables", "out"))
    _export_registry(spark, src, zipped)
    bad = ['"99";"short"\n', '"98";' + ";".join(['"x"'] * 11) + '\n']
    if not zipped:
        for name, line in zip((".EMPRECSV", ".SOCIOCSV"), bad):
            with open(os.path.join(src, "X.K03200Y9.D30610" + name), "w") as fh:
                fh.write(line)
    medallion.load_registry(spark, src, tables_dir, zipped=zipped)
    rejected = [(r.tabela, r.motivo, r.registro + "\n") for r in spark.read.parquet(f"{tables_dir}/_rejeitados").collect()]
    assert sorted(rejected) == ([] if zipped else [("empresas", "campos a menos", bad[0]), ("socios_original", "campos a mais", bad[1])])
    load = spark.read.parquet(f"{tables_dir}/_carga").groupBy("tabela").sum("linhas").collect()
    raw = {n: df.count() for n, df in fixtures.raw_tables(spark, SF).items()}
    assert dict(map(tuple, load)) == {n: raw[n] + (not zipped and n in ("empresas", "socios_original")) for n in medallion.BIG_TABLES}
    meta = {r.referencia: r.valor for r in spark.read.parquet(f"{tables_dir}/_referencia").collect()}
    assert meta == {"CNPJ": "10/06/2023", "cnpj_qtde": "160"}

    inp = fixtures.inputs(spark, SF)
    sales = registry.read_sales_csv(spark, export.write_header_csv(inp.vendas, os.path.join(tmp, "vendas")))
    leads = registry.read_leads_csv(spark, export.write_header_csv(inp.leads, os.path.join(tmp, "leads")))
    times = medallion.run(spark, tables_dir, sales, leads, out)
    assert times["total"] > 0

    def same(path, query):
        got = sorted(map(tuple, spark.read.parquet(f"{out}/{path}").collect()), key=repr)
        want = sorted(map(tuple, QUERIES[query](spark, SF).collect()), key=repr)
        assert got == want, path

    same("gold/fato_empresas", "m2_fact_companies")
    same("gold/fato_recomendacao_produto", "w1_top5_products")
    same("gold/dim_municipio", "d2_dim_municipality")
    same("gold/dim_cnae", "d1_dim_activity")
    same("silver/cnpjs_alvo", "j5_target_market")
    same("silver/clientes_cnaes", "j4_client_codes")
