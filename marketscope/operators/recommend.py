"""Product recommendation: sales totals and top-k items per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketscope.sources.schemas import SALES_KEYS


def sales_by_item(sales: DataFrame) -> DataFrame:
    """A1: total ``valor`` by (cnpj, it-codigo, familia, familia_comercial).

    Rows with a NULL key are dropped (as a pandas group-by does); an all-NULL
    sum is 0. Summed exactly as decimal, returned as double. Partial
    aggregation runs before the shuffle.
    """
    keys = [F.col(f"`{k}`") for k in SALES_KEYS]
    cond = None
    for k in keys:
        cond = k.isNotNull() if cond is None else cond & k.isNotNull()
    return (sales.where(cond).groupBy(*keys)
            .agg(F.coalesce(F.sum("valor"), F.lit(0)).cast("double").alias("valor")))


def top_products(sales: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest items per customer.

    Ties keep the smaller (it-codigo, familia, familia_comercial), the order a
    first-seen rank gives on sorted groups. ``row_number() <= k`` lets
    Catalyst insert a WindowGroupLimit below the window, so each task keeps
    only k rows per customer before sorting.
    """
    totals = sales_by_item(sales)
    w = Window.partitionBy("cnpj").orderBy(
        F.col("valor").desc(), F.col("`it-codigo`"), F.col("familia"), F.col("familia_comercial"))
    return (totals.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).drop("rank"))


def customer_value(top: DataFrame) -> DataFrame:
    """Total of a customer's recommended items: (cnpj, valor_top)."""
    return top.groupBy("cnpj").agg(F.sum(F.col("valor").cast("decimal(28,2)")).cast("double").alias("valor_top"))


def products_for_prospects(similar: DataFrame, top: DataFrame) -> DataFrame:
    """Each prospect gets the top items of its most similar customer.

    A customer's items are one array before the join, so a customer that a third of all prospects
    resemble is one row there, whose many matches AQE can split; the items are unfolded afterwards.
    """
    items = (top.groupBy(F.col("cnpj").alias("cnpj_mais_similar"))
             .agg(F.collect_list(F.struct("`it-codigo`", "familia", "familia_comercial", "valor")).alias("itens")))
    return (similar.where(F.col("cnpj_mais_similar").isNotNull())
            .select("cnpj", "cnpj_mais_similar", "similaridade")
            .join(items, "cnpj_mais_similar", "inner")
            .select("cnpj", "cnpj_mais_similar", "similaridade", F.inline("itens")))
