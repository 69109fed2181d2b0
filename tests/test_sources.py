import os
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketscope.sources import manifest, registry, tables, zipsource
from marketscope.sources import schemas as S
from marketscope.sources.export import write_registry_files


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as fh:
        fh.write(text.encode("latin-1"))


def test_registry_csv_edge_cases(spark, tmp):
    # fields: quoted id, quoted blank, unquoted blank, doubled quotes + accents;
    # a quoted newline and ';' inside quotes; text NA
    line1 = '"1";"";;"AÇÃO ""X""";"NA";"02";"";"";"";"";"";"0111301";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";""'
    line2 = '"2";"a;b";"x\ny";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";""'
    _write(tmp, "F.K03200Y0.D30610.ESTABELE", line1 + "\n" + line2 + "\n")
    _write(tmp, "other.csv", "ignored\n")
    rows = sorted(registry.read_registry_csv(spark, tmp, "estabelecimento").collect(), key=lambda r: r.cnpj_basico)
    assert len(rows) == 2
    r1, r2 = rows
    assert [r1.cnpj_basico, r1.cnpj_ordem, r1.cnpj_dv, r1.matriz_filial, r1.nome_fantasia] == ["1", "", "", 'AÇÃO "X"', "NA"]
    assert r2.cnpj_ordem == "a;b" and r2.cnpj_dv == "x\ny"
    assert all(v is not None for v in r1)  # blanks are '' in big tables


def test_code_table_na_rules(spark, tmp):
    _write(tmp, "F.MUNICCSV", '"0001";"NA"\n"0002";""\n"0003";"SÃO PAULO"\n')
    got = {r.codigo: r.descricao for r in registry.read_code_table(spark, tmp, "municipio").collect()}
    assert got == {"0001": None, "0002": None, "0003": "SÃO PAULO"}


def test_export_and_zip_roundtrip(spark, tmp):
    raw = spark.createDataFrame([("1", "EMPRESA Ç", "2062", "05", "100,5", "01", ""),
                                 ("2", 'DUPLA "ASPAS"', "2143", "05", "", "", "")], S.REGISTRY_SCHEMAS["empresas"])
    summary = write_registry_files(raw.repartition(2), tmp, ".EMPRECSV", archive="Empresas").collect()
    assert sum(r.linhas for r in summary) == 2
    assert all(zipfile.is_zipfile(os.path.join(tmp, r.arquivo)) for r in summary)
    back = zipsource.read_registry_zip(spark, tmp, S.REGISTRY_SCHEMAS["empresas"], ".EMPRECSV")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))
    loaded = registry.load_empresas(back).orderBy("cnpj_basico").collect()
    assert [r.capital_social for r in loaded] == [100.5, 0.0]


def test_zip_parts_keep_records(spark, tmp):
    import io
    records = [f'"{i}";"a ""{i}"" x";"line\n{i};";"";"";"";""\n'.encode("latin-1") for i in range(50)]
    text = b"".join(records)
    starts = {sum(map(len, records[:i])) for i in range(51)}
    for part_bytes, block in [(1, 1), (1, 7), (64, 16), (200, 33), (10**6, 100)]:
        parts = {}
        for n, data in zipsource.record_parts(io.BytesIO(text), part_bytes, block):
            parts[n] = parts.get(n, b"") + data
        assert b"".join(parts[n] for n in sorted(parts)) == text
        assert {sum(len(parts[k]) for k in range(n)) for n in parts} <= starts
        assert part_bytes > 1 or len(parts) > 1
    with zipfile.ZipFile(os.path.join(tmp, "Empresas0.zip"), "w") as z:
        z.writestr("K.K03200Y0.D30610.EMPRECSV", text)
        z.writestr("K.K03200Y1.D30610.EMPRECSV", b"")
        z.writestr("other.txt", b"ignored")
    schema = T.StructType([*S.REGISTRY_SCHEMAS["empresas"].fields, T.StructField("arquivo", T.StringType())])
    back = zipsource.read_registry_zip(spark, tmp, schema, ".EMPRECSV", part_bytes=300)
    rows = sorted(back.collect(), key=lambda r: int(r[0]))
    assert [tuple(r)[:4] for r in rows] == [(str(i), f'a "{i}" x', f"line\n{i};", "") for i in range(50)]
    assert {r.arquivo for r in rows} == {"K.K03200Y0.D30610.EMPRECSV"}
    assert zipsource.read_registry_zip(spark, tmp, schema, ".NONE").collect() == []


def test_snapshot_metadata_default(spark, tmp):
    raw = spark.createDataFrame([("1",) + ("",) * 6], S.REGISTRY_SCHEMAS["empresas"])
    write_registry_files(raw, tmp, ".EMPRECSV", snapshot="XX")
    dated = registry.with_snapshot_date(registry.read_registry_csv(spark, tmp, "empresas"))
    meta = {r.referencia: r.valor for r in registry.snapshot_metadata(dated, raw).collect()}
    assert meta == {"CNPJ": "xx/xx/2024", "cnpj_qtde": "1"}


def test_manifest(spark, tmp):
    assert len(manifest.expected_archives()) == 37
    for n in ["Empresas0.zip", "Empresas1.zip", "Cnaes.zip", "Extra.zip"]:
        _write(tmp, n, "x")
    rows = {r.familia: r for r in manifest.load_manifest(spark, tmp).collect()}
    assert rows["Empresas"].esperados == 10 and rows["Empresas"].encontrados == 2
    assert rows["Cnaes"].completo and not rows["Socios"].completo
    assert rows["Extra"].esperados == 0


def test_empty_table_and_append(spark, tmp):
    schema = S.REGISTRY_SCHEMAS["simples"]
    empty = tables.create_empty_table(spark, os.path.join(tmp, "e"), schema)
    assert empty.count() == 0 and empty.schema == schema
    a = spark.createDataFrame([("1",) + ("N",) * 6], schema)
    b = spark.createDataFrame([("2",) + ("S",) * 6], schema)
    both = tables.append_all(spark, [a, b], os.path.join(tmp, "app"))
    assert sorted(r.cnpj_basico for r in both.collect()) == ["1", "2"]


def test_sorted_table_prunes(spark, tmp):
    df = spark.range(0, 1000).select(F.lpad(F.col("id").cast("string"), 14, "0").alias("cnpj"))
    path = tables.write_table(df, os.path.join(tmp, "t"), sort_by="cnpj", files=4)
    plan = spark.read.parquet(path).where(F.col("cnpj") == "00000000000191")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(cnpj), EqualTo(cnpj,00000000000191)]" in plan


def test_bucketed_join_reads_without_shuffle(spark, tmp):
    from marketscope.sources import fixtures
    from marketscope.operators import enrich, market
    r = fixtures.registry(spark, "/root/testdata/sf0.001")
    tables.save_registry(r, tmp, buckets=4)
    opened = tables.open_registry(spark, tmp)
    spark.catalog.clearCache()
    # a fresh declaration (as another session would do) keeps the bucket spec
    for name in tables.BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {tables.catalog_name(name, tmp + '/' + name)}")
    opened = tables.open_registry(spark, tmp)
    rows = market.active(opened.estabelecimento)
    j = enrich.regime_enrichment(enrich.company_enrichment(rows, opened.empresas), opened.simples)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert len(exchanges) == 1, plan          # only the establishments move
    assert "SelectedBucketsCount" in plan
    assert j.count() == rows.count()


def test_strict_mode_rejects_malformed_lines(spark, tmp):
    import pytest
    _write(tmp, "F.SIMPLES.CSV.0", '"1";"S";"";"";"N";"";""\n"2";"S"\n')
    assert registry.read_registry_csv(spark, tmp, "simples").count() == 2
    with pytest.raises(Exception):
        registry.read_registry_csv(spark, tmp, "simples", strict=True).collect()


def test_package_shipped_to_workers(spark):
    import zipfile as zf
    from marketscope import session
    session._SHIPPED.discard(spark.sparkContext.applicationId)
    session.ship_package(spark)
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("marketscope.zip")]
    assert shipped
    path = shipped[-1].removeprefix("file:")
    names = zf.ZipFile(path).namelist()
    assert "marketscope/sources/zipsource.py" in names and "marketscope/session.py" in names


def test_manifest_complete_snapshot(spark, tmp):
    for n in manifest.expected_archives():
        _write(tmp, n, "x")
    rows = manifest.load_manifest(spark, tmp).collect()
    assert len(rows) == 10 and all(r.completo for r in rows)
    assert sum(r.encontrados for r in rows) == 37


def test_sales_csv_dialect(spark, tmp):
    """Doubled quotes, commas, backslashes, a quoted newline, NA spellings; values keep their decimals."""
    import os

    from marketscope.sources import registry
    os.makedirs(f"{tmp}/v")
    with open(f"{tmp}/v/vendas.csv", "w", encoding="utf-8") as f:
        f.write('it-codigo,familia,familia_comercial,cnpj,cliente,valor\n'
                '1,F1,C1,001,"ACME ""BR"", LTDA",10.005\n'
                '2,NA,C1,002,"C:\\dir\\",7\n'
                '3,F1,C1,003,"two\nlines",12345678901234567.5\n'
                '4,F1,C1,004,São,abc\n'
                'nan,F1,C1,005,x,\n')
    rows = registry.read_sales_csv(spark, f"{tmp}/v").collect()
    assert [(r["it-codigo"], r.familia, r.cliente, None if r.valor is None else str(r.valor)) for r in rows] == [
        ("1", "F1", 'ACME "BR", LTDA', "10.005000"), ("2", None, "C:\\dir\\", "7.000000"),
        ("3", "F1", "two\nlines", "12345678901234567.500000"), ("4", "F1", "São", None), (None, "F1", "x", None)]
    assert [r.valor for r in registry.unparsed_sales(spark, f"{tmp}/v").collect()] == ["abc"]


def test_snapshot_metadata_takes_the_earliest_date(spark):
    from marketscope.sources import registry
    dated = spark.createDataFrame([("09/11/2023",), ("10/06/2023",), (None,)], "snapshot_date string")
    out = {r.referencia: r.valor for r in registry.snapshot_metadata(dated, spark.range(3)).collect()}
    assert out == {"CNPJ": "10/06/2023", "cnpj_qtde": "3"}
