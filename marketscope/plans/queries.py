"""Named queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All of them read the fixture registry derived from the tables in ``sf_dir``
and run over whole tables. Parameters of the point lookups are fixture ids
(the lookup by id is the feature being tested, not a way to shrink input).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.functions import (
    division, full_id, lenient_bigint, lenient_real, section_of, tax_regime,
)
from marketscope.operators import dims, enrich, kpis, lookups, market, recommend, similarity
from marketscope.plans.model import MarketModel
from marketscope.session import shared_dir
from marketscope.sources import export, fixtures, manifest, registry, splitcsv, tables, zipsource
from marketscope.sources import schemas as S
from marketscope.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixture parameters of the lookups (ids of customer 6 / supplier 3).
PROFILE_CNPJ = "00000003000100"
PARTNER_ID = "00000000000003"
PARTNER_NAME = "Supplier#000000003"
LEGAL_NATURES = ["2143", "2330"]
CITY, STATE, CEP_PREFIX = "NATION_3", "U3", "72"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_MODELS: dict[tuple[str, str], MarketModel] = {}


def model(spark: SparkSession, sf_dir: str) -> MarketModel:
    """One model per application and folder: what it writes (fact base, similarity) exists once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MODELS:
        _MODELS[key] = MarketModel(spark, *fixtures.load(spark, sf_dir))
    return _MODELS[key]


# ------------------------------------------------------------- projections
@query
def p1_active_establishments(spark, sf_dir):
    return model(spark, sf_dir).active


@query
def e1_full_id(spark, sf_dir):
    e = fixtures.raw_tables(spark, sf_dir)["estabelecimento"]
    return e.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", full_id().alias("cnpj"))


@query
def e3_capital(spark, sf_dir):
    raw = fixtures.raw_tables(spark, sf_dir)["empresas"]
    return raw.select("cnpj_basico", "capital_social_str", lenient_real("capital_social_str").alias("capital_social"))


@query
def e4_tax_regime(spark, sf_dir):
    s = fixtures.registry(spark, sf_dir).simples
    return s.select("cnpj_basico", "opcao_simples", "opcao_mei", tax_regime().alias("id_regime_tributario"))


@query
def e7_membership_flags(spark, sf_dir):
    m = model(spark, sf_dir)
    rows = m.active.select("cnpj")
    rows = enrich.membership_flag(rows, m.inputs.leads, "possui_lead")
    return enrich.membership_flag(rows, m.inputs.vendas, "atual_cliente")


@query
def e9_sections(spark, sf_dir):
    cnae = fixtures.registry(spark, sf_dir).cnae
    d = division("codigo")
    sigla, desc = section_of(d)
    return cnae.select("codigo", d.alias("divisao"), sigla.alias("sigla_secao"), desc.alias("desc_secao"))


@query
def e11_id_as_bigint(spark, sf_dir):
    e = fixtures.registry(spark, sf_dir).estabelecimento
    return e.select("cnpj", lenient_bigint("cnpj").alias("cnpj_int"))


# ------------------------------------------------------------------- joins
@query
def j1_company_enrichment(spark, sf_dir):
    m = model(spark, sf_dir)
    j = enrich.company_enrichment(m.active, m.registry.empresas)
    return j.withColumn("porte_empresa", F.coalesce("porte_empresa", F.lit("00")))


@query
def j2_regime_enrichment(spark, sf_dir):
    m = model(spark, sf_dir)
    return enrich.regime_enrichment(m.active.select("cnpj", "cnpj_basico"), m.registry.simples)


@query
def j4_client_codes(spark, sf_dir):
    return model(spark, sf_dir).client_codes


@query
def j5_target_market(spark, sf_dir):
    return model(spark, sf_dir).targets


@query
def j6_prospects(spark, sf_dir):
    return market.prospects(model(spark, sf_dir).fact_base)


@query
def j8_partner_head_office(spark, sf_dir):
    return fixtures.registry(spark, sf_dir).socios


# ---------------------------------------------------- aggregates, generators
@query
def a1_sales_by_item(spark, sf_dir):
    return recommend.sales_by_item(fixtures.inputs(spark, sf_dir).vendas)


@query
def a2_distinct_clients(spark, sf_dir):
    i = fixtures.inputs(spark, sf_dir)
    return (market.distinct_keys(i.vendas).select(F.lit("vendas").alias("origem"), "cnpj")
            .unionByName(market.distinct_keys(i.leads).select(F.lit("leads").alias("origem"), "cnpj")))


@query
def g1_explode_codes(spark, sf_dir):
    return similarity.explode_codes(fixtures.registry(spark, sf_dir).estabelecimento)


@query
def g2_company_codes(spark, sf_dir):
    return model(spark, sf_dir).codes


@query
def g3_code_signature(spark, sf_dir):
    return similarity.code_signature(model(spark, sf_dir).codes)


@query
def w1_top5_products(spark, sf_dir):
    return model(spark, sf_dir).top_products


# -------------------------------------------------------------- dimensions
@query
def d1_dim_activity(spark, sf_dir):
    return model(spark, sf_dir).dim_cnae


@query
def d2_dim_municipality(spark, sf_dir):
    return model(spark, sf_dir).dim_municipio


@query
def d3_dim_size(spark, sf_dir):
    """D3 with its use: every size member and the fact companies in it."""
    m = model(spark, sf_dir)
    return dims.with_member_counts(m.dim_porte, m.fact_base, "porte_empresa")


@query
def d4_dim_regime(spark, sf_dir):
    """D4 with its use: every regime member and the fact companies in it."""
    m = model(spark, sf_dir)
    return dims.with_member_counts(m.dim_regime, m.fact_base, "id_regime_tributario")


# -------------------------------------------------------------- similarity
@query
def m0_similarity_pairs(spark, sf_dir):
    m = model(spark, sf_dir)
    return similarity.similarity_pairs(m.codes, m.clients, m.prospects)


@query
def m0_set_members(spark, sf_dir):
    m = model(spark, sf_dir)
    return similarity.set_members(m.codes, m.clients, m.prospects)


@query
def m1_most_similar(spark, sf_dir):
    return model(spark, sf_dir).similar_table


@query
def m2_fact_companies(spark, sf_dir):
    return model(spark, sf_dir).fact


# ----------------------------------------------------------------- lookups
@query
def q1_company_profile(spark, sf_dir):
    return lookups.company_profile(fixtures.registry(spark, sf_dir), PROFILE_CNPJ)


@query
def q2_city_postal_lookup(spark, sf_dir):
    return lookups.city_postal_lookup(fixtures.registry(spark, sf_dir), CITY, STATE, CEP_PREFIX)


CLUSTERED_FILES = 200
_CLUSTERED: dict[tuple[str, str], str] = {}


def clustered_path(spark: SparkSession, sf_dir: str) -> str:
    """The establishments in files clustered by place, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CLUSTERED:
        e = fixtures.registry(spark, sf_dir).estabelecimento
        _CLUSTERED[key] = tables.write_clustered(e, shared_dir(spark, "estabelecimento_places"), tables.location_key(), CLUSTERED_FILES)
    return _CLUSTERED[key]


@query
def q2_clustered_lookup(spark, sf_dir):
    """The lookup by city, state and postal prefix on establishments clustered by place."""
    reg = replace(fixtures.registry(spark, sf_dir), estabelecimento=spark.read.parquet(clustered_path(spark, sf_dir)))
    return lookups.city_postal_lookup(reg, CITY, STATE, CEP_PREFIX)


@query
def q3_legal_nature(spark, sf_dir):
    return lookups.companies_by_legal_nature(fixtures.registry(spark, sf_dir), LEGAL_NATURES)


@query
def q4a_by_partner_id(spark, sf_dir):
    return lookups.companies_of_partner_id(fixtures.registry(spark, sf_dir), PARTNER_ID)


@query
def q4b_by_partner_name(spark, sf_dir):
    return lookups.companies_of_partner_name(fixtures.registry(spark, sf_dir), PARTNER_NAME)


@query
def q5_partners_of(spark, sf_dir):
    return lookups.partners_of(fixtures.registry(spark, sf_dir), PROFILE_CNPJ)


# -------------------------------------------------------------------- BI
def _star(m: MarketModel) -> DataFrame:
    return m.star(m.fact)


@query
def b1_star_view(spark, sf_dir):
    return _star(model(spark, sf_dir))


@query
def b2_kpis_overall(spark, sf_dir):
    return kpis.measures_of(model(spark, sf_dir).sums_table, "total")


@query
def b3_coverage_by_activity(spark, sf_dir):
    return kpis.measures_of(model(spark, sf_dir).sums_table, "atividade", kpis.ACTIVITY)


@query
def b4_volume_by_size_segment(spark, sf_dir):
    return kpis.segment_volume_of(model(spark, sf_dir).sums_table)


@query
def b5_potential_revenue_by_region(spark, sf_dir):
    m = model(spark, sf_dir)
    return kpis.potential_revenue_by_region(_star(m), m.top_products)


@query
def b6_market_rollup(spark, sf_dir):
    return kpis.rollup_of(model(spark, sf_dir).sums_table)


@query
def b7_products_for_prospects(spark, sf_dir):
    m = model(spark, sf_dir)
    return recommend.products_for_prospects(m.similar_table, m.top_products)


# ------------------------------------------------------- sources and sinks
# Each writes fixture data in the registry's own format to a fresh folder
# under the shared checkpoint folder, then reads it back with the reader
# under test.
def _exported(spark, sf_dir, table: str, archive: str | None = None, df: DataFrame | None = None):
    raw = df if df is not None else fixtures.raw_tables(spark, sf_dir)[table]
    path = shared_dir(spark, f"export_{table}")
    suffix = S.REGISTRY_SUFFIX[table]
    export.write_registry_files(raw, path, suffix, archive=archive)
    return path


@query
def s1_registry_csv_roundtrip(spark, sf_dir):
    path = _exported(spark, sf_dir, "estabelecimento")
    return registry.read_registry_csv(spark, path, "estabelecimento")


@query
def s1_split_read(spark, sf_dir):
    """Every row has a quoted line break, separator and doubled quotes; each file is read by several tasks."""
    raw = fixtures.raw_tables(spark, sf_dir)["estabelecimento"]
    odd = raw.withColumn("complemento", F.concat(F.lit('SALA "'), "cnpj_ordem", F.lit('";\n'), "nome_fantasia"))
    path = _exported(spark, sf_dir, "estabelecimento", df=odd)
    return splitcsv.read_registry_split(spark, path, "estabelecimento", range_bytes=64 << 10)


_SALES_LOADS: dict[tuple[str, str], splitcsv.Load] = {}


def _sales_load(spark: SparkSession, sf_dir: str) -> splitcsv.Load:
    """Sales lines of which some are malformed (by item number), loaded once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SALES_LOADS:
        def quoted(c):
            return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

        vendas = fixtures.inputs(spark, sf_dir).vendas
        kind = F.col("`it-codigo`").cast("bigint") % 50
        value = (F.when(kind == 2, "a combinar").when(kind == 3, "NA")
                 .otherwise((F.col("valor") * F.lit(0.125).cast("decimal(3,3)")).cast("string")))
        client = F.when(kind == 4, F.concat(F.lit('"'), "cliente", F.lit('",\n2'))).otherwise(F.col("cliente"))
        fields = [*[quoted(F.col(f"`{c}`")) for c in S.VENDAS_SCHEMA.names[:4]], quoted(client)]
        line = F.concat_ws(",", *fields, F.when(kind != 0, value), F.when(kind == 1, F.lit("?")))
        path = shared_dir(spark, "vendas_lines")
        vendas.select(line.alias("value")).write.mode("overwrite").text(path)
        _SALES_LOADS[key] = splitcsv.load_sales_csv(spark, path, shared_dir(spark, "vendas_load"),
                                                    splitcsv.Dialect(",", "UTF-8", False), range_bytes=1 << 20)
    return _SALES_LOADS[key]


@query
def s4_sales_accepted(spark, sf_dir):
    return _sales_load(spark, sf_dir).accepted.drop("arquivo")


@query
def s4_sales_rejected(spark, sf_dir):
    return _sales_load(spark, sf_dir).rejected.select("motivo", "campos", "registro")


@query
def s4_load_counts(spark, sf_dir):
    """Accepted and rejected lines by reason; together all lines."""
    counts = _sales_load(spark, sf_dir).counts()
    return counts.groupBy(F.coalesce("motivo", F.lit("aceito")).alias("situacao")).agg(F.sum("linhas").cast("bigint").alias("linhas"))


@query
def s2_code_table(spark, sf_dir):
    path = _exported(spark, sf_dir, "municipio")
    return registry.read_code_table(spark, path, "municipio")


@query
def s3_zip_scan(spark, sf_dir):
    path = _exported(spark, sf_dir, "empresas", archive="Empresas")
    return zipsource.read_registry_zip(spark, path, S.REGISTRY_SCHEMAS["empresas"], S.REGISTRY_SUFFIX["empresas"])


@query
def s4_sales_csv(spark, sf_dir):
    path = export.write_header_csv(fixtures.inputs(spark, sf_dir).vendas, shared_dir(spark, "vendas_csv"))
    return registry.read_sales_csv(spark, path).withColumn("valor", F.col("valor").cast("decimal(18,2)"))


@query
def s5_leads_csv(spark, sf_dir):
    path = export.write_header_csv(fixtures.inputs(spark, sf_dir).leads, shared_dir(spark, "leads_csv"))
    return registry.read_leads_csv(spark, path)


@query
def s6_table_scan(spark, sf_dir):
    root = shared_dir(spark, "registry")
    tables.save_registry(fixtures.registry(spark, sf_dir), root)
    return market.active(tables.open_registry(spark, root).estabelecimento)


@query
def s7_parquet_roundtrip(spark, sf_dir):
    path = tables.write_table(model(spark, sf_dir).fact, shared_dir(spark, "fato_empresas"))
    return tables.read_table(spark, path)


@query
def s9_table_append(spark, sf_dir):
    e = fixtures.registry(spark, sf_dir).estabelecimento
    heads, branches = e.where(F.col("matriz_filial") == "1"), e.where(F.col("matriz_filial") != "1")
    return tables.append_all(spark, [heads, branches], shared_dir(spark, "estabelecimento_append"))


@query
def s9_table_replace(spark, sf_dir):
    """A table written once is replaced by the next write (no row of the first one stays)."""
    e = fixtures.registry(spark, sf_dir).estabelecimento
    path = shared_dir(spark, "estabelecimento_replace")
    for chunk in (e.where(F.col("matriz_filial") == "1"), e.where(F.col("matriz_filial") != "1")):
        tables.write_table(chunk, path)
    return tables.read_table(spark, path)


@query
def s9_atomic_replace(spark, sf_dir):
    """A catalog table is replaced by switching its location to a copy written aside."""
    e = fixtures.registry(spark, sf_dir).estabelecimento
    root = shared_dir(spark, "estabelecimento_versions")
    name = tables.catalog_name("estabelecimento", root)
    for chunk in (e.where(F.col("matriz_filial") == "1"), e.where(F.col("matriz_filial") != "1")):
        out = tables.replace_table(chunk, name, root)
    return out


@query
def s10_empty_table(spark, sf_dir):
    """A table created empty with a fixed schema, then filled."""
    path = shared_dir(spark, "socios_original")
    tables.create_empty_table(spark, path, S.REGISTRY_SCHEMAS["socios_original"])
    return tables.read_table(spark, tables.write_table(fixtures.raw_tables(spark, sf_dir)["socios_original"], path, mode="append"))


@query
def s12_snapshot_reload(spark, sf_dir):
    """Two snapshots of the companies in one table; the later one is loaded twice and stands there once."""
    raw = fixtures.raw_tables(spark, sf_dir)["empresas"]
    path, table = shared_dir(spark, "empresas_snapshots"), shared_dir(spark, "empresas_table")
    for snapshot, part in (("D30513", raw.where("natureza_juridica <> '2062'")), ("D30610", raw)):
        export.write_registry_files(part, f"{path}/{snapshot}", S.REGISTRY_SUFFIX["empresas"], snapshot=snapshot)
    for snapshot in ("D30513", "D30610", "D30610"):
        rows = registry.read_registry_csv(spark, f"{path}/{snapshot}", "empresas")
        tables.write_snapshot(rows, table, registry.snapshot_date(F.col("_metadata.file_name")))
    return spark.read.parquet(table).select("snapshot", "cnpj_basico", "razao_social", "capital_social_str")


@query
def s14_archive_manifest(spark, sf_dir):
    """Two complete families of archives (ten parts each, as a snapshot has) in one folder; the others are missing."""
    raw = fixtures.raw_tables(spark, sf_dir)
    path = shared_dir(spark, "archives")
    for table, family in (("empresas", "Empresas"), ("socios_original", "Socios")):
        export.write_registry_files(raw[table].repartition(dict(manifest.ARCHIVE_FAMILIES)[family]), path,
                                    S.REGISTRY_SUFFIX[table], archive=family)
    return manifest.load_manifest(spark, path).drop("bytes")


@query
def s12_snapshot_date(spark, sf_dir):
    path = _exported(spark, sf_dir, "empresas")
    dated = registry.with_snapshot_date(registry.read_registry_csv(spark, path, "empresas"))
    return dated.groupBy("snapshot_date").agg(F.count(F.lit(1)).cast("bigint").alias("linhas"))


@query
def s13_snapshot_metadata(spark, sf_dir):
    path = _exported(spark, sf_dir, "empresas")
    dated = registry.with_snapshot_date(registry.read_registry_csv(spark, path, "empresas"))
    return registry.snapshot_metadata(dated, fixtures.registry(spark, sf_dir).estabelecimento)


@query
def s15_row_counts(spark, sf_dir):
    r = fixtures.registry(spark, sf_dir)
    return registry.row_counts({"empresas": r.empresas, "estabelecimento": r.estabelecimento,
                                "socios": r.socios})


@query
def u1_union_chunks(spark, sf_dir):
    raw = fixtures.raw_tables(spark, sf_dir)["estabelecimento"]
    first = _exported(spark, sf_dir, "estabelecimento", df=raw.where(F.col("matriz_filial") == "1"))
    second = _exported(spark, sf_dir, "estabelecimento", df=raw.where(F.col("matriz_filial") != "1"))
    one, two = (splitcsv.read_registry_split(spark, path, "estabelecimento") for path in (first, second))
    return one.unionByName(two)


@query
def s16_stream_ingest(spark, sf_dir):
    path = _exported(spark, sf_dir, "estabelecimento")
    return spark.read.parquet(ingest.ingest(spark, path, "estabelecimento"))
