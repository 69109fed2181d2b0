"""Fact enrichment: company name/size, tax regime, lead and customer flags.

Both registry joins are on ``cnpj_basico``; Spark keeps the left side's hash
partitioning between them, so the second join shuffles only ``simples``. The
flag joins are on ``cnpj`` against distinct key sets (sized by AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketscope.functions import size_or_unknown, tax_regime
from marketscope.operators.market import distinct_keys, target_market, target_rows


def company_enrichment(rows: DataFrame, empresas: DataFrame) -> DataFrame:
    """Left join company name and size on the root id (misses stay NULL)."""
    return rows.join(empresas.select("cnpj_basico", "razao_social", "porte_empresa"),
                     "cnpj_basico", "left")


def regime_table(simples: DataFrame) -> DataFrame:
    """E4 on the regime table: (cnpj_basico, id_regime_tributario)."""
    return simples.select("cnpj_basico", tax_regime().alias("id_regime_tributario"))


def regime_enrichment(rows: DataFrame, simples: DataFrame) -> DataFrame:
    """Left join the tax regime; companies absent from ``simples`` stay NULL."""
    return rows.join(regime_table(simples), "cnpj_basico", "left")


def membership_flag(rows: DataFrame, keys: DataFrame, flag: str, key: str = "cnpj") -> DataFrame:
    """0/1 int flag = ``key`` is in the distinct non-NULL keys of ``keys``."""
    marked = distinct_keys(keys, key).withColumn(flag, F.lit(1))
    return (rows.join(marked, key, "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(0)).cast("int")))


def fact_base(active_df: DataFrame, targets: DataFrame, empresas: DataFrame, simples: DataFrame,
              leads: DataFrame, sales: DataFrame) -> DataFrame:
    """M2 without similarity: target rows enriched, flagged, size defaulted.

    ``targets`` are the target ids. What is joined on ``cnpj`` (the targets, both flags) comes first, so
    the rows are dealt by it once; the two registry joins then share one partitioning on ``cnpj_basico``
    (with the bucketed registry tables neither of those moves).
    """
    rows = target_rows(active_df, targets)
    rows = membership_flag(rows, leads, "possui_lead")
    rows = membership_flag(rows, sales, "atual_cliente")
    rows = regime_enrichment(company_enrichment(rows, empresas), simples)
    return rows.select(
        "cnpj", "cnae_fiscal", "municipio", "cnpj_basico", "nome_fantasia", "razao_social",
        size_or_unknown("porte_empresa").alias("porte_empresa"), "id_regime_tributario",
        "possui_lead", "atual_cliente")


def attach_similarity(fact: DataFrame, similar: DataFrame) -> DataFrame:
    """Left join (cnpj_mais_similar, similaridade); customers get NULL."""
    return fact.join(similar.select("cnpj", "cnpj_mais_similar", "similaridade"), "cnpj", "left")


def fact_companies(active_df: DataFrame, targets: DataFrame, empresas: DataFrame, simples: DataFrame,
                   leads: DataFrame, sales: DataFrame, similar: DataFrame) -> DataFrame:
    """M2: the gold fact, :func:`fact_base` with the most-similar columns attached."""
    return attach_similarity(fact_base(active_df, targets, empresas, simples, leads, sales), similar)
