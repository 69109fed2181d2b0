"""End-to-end runs: registry load (extract & load) and bronze/silver/gold.

``load_registry`` turns a folder of registry files (CSV or zip archives) into
Parquet tables, including the derived ``socios``, the exploded secondary
codes, the ``_referencia`` metadata, and the lines it rejected. ``run`` computes the market tables
from those Parquet tables and the company's sales and leads files.

Every stage is written once and read back by the next: a written table cuts
the lineage (a lost executor re-runs one stage, not the whole chain) and
gives the next stage exact sizes. Output folders are overwritten; stage
times are returned, the way the source script prints them.

    python -m marketscope.plans.medallion load  <registry_dir> <tables_dir> [--zip]
    python -m marketscope.plans.medallion run   <tables_dir> <vendas.csv> <leads.csv> <out_dir>
"""

from __future__ import annotations

import sys
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.operators import similarity
from marketscope.plans.model import MarketModel
from marketscope.session import shared_dir
from marketscope.sources import registry as R
from marketscope.sources import schemas as S
from marketscope.sources import splitcsv, tables, zipsource
from marketscope.sources.registry import Inputs

BIG_TABLES = ("empresas", "estabelecimento", "socios_original", "simples")
CODE_TABLES = ("cnae", "motivo", "municipio", "natureza_juridica", "pais", "qualificacao_socio")


def _staged(spark: SparkSession, source: str, zipped: bool, table: str, pad_short: bool) -> splitcsv.Load:
    """One big table's files, read once by byte ranges into accepted rows and rejected lines."""
    suffix = S.REGISTRY_SUFFIX[table]
    folder, pattern = (zipsource.inflate(spark, source, suffix), "*.csv") if zipped else (source, "*" + suffix)
    return splitcsv.load_registry_csv(spark, folder, table, shared_dir(spark, f"load_{table}"), pattern=pattern, pad_short=pad_short)


def _code_tables(spark: SparkSession, source: str, zipped: bool):
    raw = {}
    # the snapshot date is in the file names: listed, not read
    suffix = S.REGISTRY_SUFFIX["empresas"]
    if zipped:
        names = spark.createDataFrame([(m.member,) for m in zipsource.list_members(spark, source, suffix)], "arquivo string")
    else:
        names = (spark.read.format("binaryFile").option("pathGlobFilter", "*" + suffix).load(source)
                 .select(F.element_at(F.split("path", "/"), -1).alias("arquivo")))
    dated = names.select(R.snapshot_date(F.col("arquivo")).alias("snapshot_date"))
    for name in CODE_TABLES:
        if zipped:
            df = zipsource.read_registry_zip(spark, source, S.CODE_SCHEMA, S.REGISTRY_SUFFIX[name])
            raw[name] = df.select(*[R.na_to_null(c) for c in S.CODE_COLUMNS])
        else:
            raw[name] = R.read_code_table(spark, source, name)
    return raw, dated


def load_registry(spark: SparkSession, source: str, out: str, zipped: bool = False, buckets: int | None = None,
                  pad_short: bool = False) -> dict[str, float]:
    """Registry files -> Parquet tables under ``out``; returns stage seconds.

    Raw files are parsed once, into staged copies; sorted and bucketed tables are written from
    those. Lines that do not fit go to ``_rejeitados`` (tabela, arquivo, posicao, campos, motivo,
    registro); ``_carga`` counts accepted and rejected lines by table, file and reason
    (``pad_short`` accepts lines with too few fields, the rest blank). ``empresas`` and
    ``simples`` are bucketed by root id into ``buckets`` files (default: one for each
    BUCKET_BYTES of the larger staged table), so the joins on the root id read them without a shuffle.
    """
    times = {}
    t0 = time.time()
    root = out.rstrip("/")
    staged = {name: _staged(spark, source, zipped, name, pad_short) for name in BIG_TABLES}
    rejected = [load.rejected.withColumn("tabela", F.lit(name)) for name, load in staged.items()]
    reduce(DataFrame.unionByName, rejected).write.mode("overwrite").parquet(f"{root}/_rejeitados")
    counts = [load.counts().withColumn("tabela", F.lit(name)) for name, load in staged.items()]
    reduce(DataFrame.unionByName, counts).coalesce(1).write.mode("overwrite").parquet(f"{root}/_carga")
    raw, dated = _code_tables(spark, source, zipped)
    times["staged"] = time.time() - t0

    t0 = time.time()
    # The big tables are written first; everything derived reads those copies.
    accepted = {name: load.accepted.drop("arquivo") for name, load in staged.items()}
    buckets = buckets or max(tables.bucket_count(accepted[name]) for name in tables.BUCKETED)
    for name in ("empresas", "estabelecimento", "simples", "socios_original"):
        df = {"empresas": R.load_empresas, "estabelecimento": R.load_estabelecimento}.get(name, lambda d: d)(accepted[name])
        if name in tables.BUCKETED:
            tables.write_bucketed_table(df, f"{root}/{name}", name, tables.BUCKETED[name], buckets)
        else:
            tables.write_table(df, f"{root}/{name}", sort_by=tables.SORT_KEYS.get(name, "cnpj_basico"),
                               bloom=tables.BLOOM_COLUMNS.get(name, ()))
    tables.write_layout(spark, root, buckets)
    for name in CODE_TABLES:
        tables.write_table(raw[name].coalesce(1), f"{root}/{name}")
    times["load"] = time.time() - t0

    t0 = time.time()
    estab = spark.read.parquet(f"{root}/estabelecimento")
    socios = R.head_office_partners(spark.read.parquet(f"{root}/socios_original"), estab)
    tables.write_table(socios, f"{root}/socios", sort_by="cnpj", bloom=tables.BLOOM_COLUMNS["socios"])
    tables.write_table(similarity.explode_codes(estab), f"{root}/cnae_secundaria", sort_by="cnpj")
    R.snapshot_metadata(dated, estab).coalesce(1).write.mode("overwrite").parquet(f"{root}/_referencia")
    times["derived"] = time.time() - t0
    return times


def _write(df: DataFrame, path: str, sort_by: str | None = None) -> DataFrame:
    if sort_by:
        df = df.sortWithinPartitions(sort_by)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run(spark: SparkSession, tables_dir: str, sales: DataFrame, leads: DataFrame, out: str,
        drop_blank_codes: bool = False) -> dict[str, float]:
    """Bronze / silver / gold market tables under ``out``; returns stage seconds."""
    reg = tables.open_registry(spark, tables_dir)
    root = out.rstrip("/")
    times = {}

    t0 = time.time()
    bronze = _write(MarketModel(spark, reg, Inputs(sales, leads)).active,
                    f"{root}/bronze/estabelecimento_clean")
    times["bronze"] = time.time() - t0

    m = MarketModel(spark, reg, Inputs(sales, leads), drop_blank_codes, active=bronze)
    t0 = time.time()
    m.__dict__["client_codes_table"] = _write(m.client_codes, f"{root}/silver/clientes_cnaes", "cnae")
    times["silver_codes"] = time.time() - t0
    t0 = time.time()
    m.__dict__["targets"] = _write(m.targets, f"{root}/silver/cnpjs_alvo", "cnpj")
    times["silver_targets"] = time.time() - t0

    t0 = time.time()
    _write(m.top_products, f"{root}/gold/fato_recomendacao_produto")
    times["gold_recommendation"] = time.time() - t0

    t0 = time.time()
    # secondary codes come from the table the loader wrote, when present
    secondary = tables.if_present(lambda: spark.read.parquet(f"{tables_dir.rstrip('/')}/cnae_secundaria"))
    if secondary is not None:
        m.__dict__["secondary"] = secondary
    # intermediate: the shared checkpoint folder, not the output
    m.__dict__["fact_base_table"] = _write(m.fact_base, shared_dir(spark, "fato_base"))
    times["gold_fact_base"] = time.time() - t0

    t0 = time.time()
    _write(m.dim_cnae, f"{root}/gold/dim_cnae")
    _write(m.dim_municipio, f"{root}/gold/dim_municipio")
    _write(m.dim_porte.coalesce(1), f"{root}/gold/dim_porte_empresa")
    _write(m.dim_regime.coalesce(1), f"{root}/gold/dim_regime_tributario")
    times["dimensions"] = time.time() - t0

    t0 = time.time()
    _write(m.fact, f"{root}/gold/fato_empresas")
    times["similarity_and_fact"] = time.time() - t0
    times["total"] = sum(times.values())
    return times


def main(argv: list[str]) -> None:
    from marketscope.session import get_session
    spark = get_session()
    if argv[1] == "load":
        print(load_registry(spark, argv[2], argv[3], zipped="--zip" in argv))
    elif argv[1] == "run":
        sales = R.read_sales_csv(spark, argv[3])
        leads = R.read_leads_csv(spark, argv[4])
        print(run(spark, argv[2], sales, leads, argv[5]))
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv)
