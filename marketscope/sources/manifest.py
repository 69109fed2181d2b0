"""Completeness check of a registry download.

Fixed values: archive families of one snapshot and how many numbered parts
each has (a family with one part has no number): 37 archives in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_FAMILIES = [
    ("Cnaes", 1), ("Empresas", 10), ("Estabelecimentos", 10), ("Motivos", 1),
    ("Municipios", 1), ("Naturezas", 1), ("Paises", 1), ("Qualificacoes", 1),
    ("Simples", 1), ("Socios", 10),
]


def expected_archives() -> list[str]:
    names = []
    for family, parts in ARCHIVE_FAMILIES:
        names += [f"{family}.zip"] if parts == 1 else [f"{family}{i}.zip" for i in range(parts)]
    return names


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per family: expected and found archives, found bytes and a completeness flag.

    The listing uses the binaryFile source without its ``content`` column, so
    no archive is read. Returns rows; it never prompts.
    """
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("arquivo"), "length"))
    expected = spark.createDataFrame([(n,) for n in expected_archives()], "arquivo string")
    family = F.regexp_extract("arquivo", r"^([A-Za-z]+)", 1)
    joined = expected.withColumn("esperado", F.lit(1)).join(
        found.withColumn("encontrado", F.lit(1)), "arquivo", "full")
    return (joined.groupBy(family.alias("familia"))
            .agg(F.count("esperado").cast("bigint").alias("esperados"),
                 F.count("encontrado").cast("bigint").alias("encontrados"),
                 F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"))
            .withColumn("completo", F.col("esperados") == F.col("encontrados")))
