"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketscope.functions import REGIME_ROWS, SIZE_ROWS, classify_section


def dim_activity(cnae: DataFrame, lenient: bool = False) -> DataFrame:
    """Codes with their section letter and label (E8 + E9, no Python UDF)."""
    sigla, desc = classify_section("codigo", lenient)
    return cnae.select("codigo", "descricao", sigla.alias("sigla_secao"), desc.alias("desc_secao"))


def dim_municipality(estabelecimento: DataFrame, municipio: DataFrame, status: str = "02") -> DataFrame:
    """DISTINCT (municipio, descricao_municipio, uf, cep) of active rows.

    The grain is the postal code, not the municipality.
    """
    rows = (estabelecimento
            .where((F.col("situacao_cadastral") == status) & F.col("municipio").isNotNull()
                   & F.col("uf").isNotNull())
            .select("municipio", "uf", "cep"))
    names = municipio.select(F.col("codigo").alias("municipio"), F.col("descricao").alias("descricao_municipio"))
    # Pre-aggregate before the join: the distinct (municipio, uf, cep) set is
    # far smaller than the establishments, and the municipality table is a
    # bounded code table.
    return (rows.distinct().join(names, "municipio", "inner")
            .select("municipio", "descricao_municipio", "uf", "cep").distinct())


def municipality_names(dim_municipio: DataFrame) -> DataFrame:
    """One row per municipality (name and state), for star joins."""
    return dim_municipio.groupBy("municipio").agg(
        F.min("descricao_municipio").alias("descricao_municipio"), F.min("uf").alias("uf"))


def dim_size(spark: SparkSession) -> DataFrame:
    """D3: literal size dimension."""
    schema = T.StructType([T.StructField("porte_empresa", T.StringType(), False),
                           T.StructField("descricao_porte_empresa", T.StringType(), False)])
    return spark.createDataFrame(SIZE_ROWS, schema)


def dim_regime(spark: SparkSession) -> DataFrame:
    """Literal tax-regime dimension."""
    schema = T.StructType([T.StructField("id_regime_tributario", T.IntegerType(), False),
                           T.StructField("descricao_regime_tributario", T.StringType(), False)])
    return spark.createDataFrame(REGIME_ROWS, schema)


def with_member_counts(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """A dimension with the number of fact rows per member (0 when unused).

    The fact is pre-aggregated to one row per key before the join, so the
    dimension side stays literal-sized.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("empresas"))
    return (dim.join(counts, key, "left")
            .withColumn("empresas", F.coalesce(F.col("empresas"), F.lit(0).cast("bigint"))))
