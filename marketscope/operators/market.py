"""Target market: active establishments, customer codes, target companies.

Sets of keys never travel through the driver: membership is a semi-join
against a one-column DataFrame, so it works for any number of keys. Whether a
key set is broadcast is decided by Spark from its measured size (static
statistics, then AQE at run time), with a shuffle join beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketscope.operators.semijoin import bloom_semi_join
from marketscope.sources.schemas import BRONZE_COLUMNS

ACTIVE = "02"


def active(estabelecimento: DataFrame, status: str = ACTIVE,
           columns: list[str] | None = None) -> DataFrame:
    """Establishments with the given registration status, bronze columns.

    The equality filter and the column list reach the Parquet scan
    (PushedFilters / ReadSchema).
    """
    return (estabelecimento.where(F.col("situacao_cadastral") == F.lit(status))
            .select(*(columns or BRONZE_COLUMNS)))


def distinct_keys(df: DataFrame, column: str = "cnpj", alias: str | None = None) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return (df.select(F.col(column).alias(alias or column))
            .where(F.col(alias or column).isNotNull()).distinct())


def client_codes(active_df: DataFrame, sales: DataFrame, drop_blank_codes: bool = False) -> DataFrame:
    """Distinct primary codes of active establishments that are customers.

    Active rows are thinned out by a Bloom filter of the customer ids before they are dealt by id.
    Output column ``cnae``. A blank code ('') is kept in parity mode (it is not
    NULL); ``drop_blank_codes`` removes it.
    """
    codes = (bloom_semi_join(active_df, sales, "cnpj")
             .select(F.col("cnae_fiscal").alias("cnae"))
             .where(F.col("cnae").isNotNull()))
    if drop_blank_codes:
        codes = codes.where(F.col("cnae") != "")
    return codes.distinct()


def target_market(active_df: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct ids of active establishments whose primary code is a customer code."""
    keys = codes.select(F.col("cnae").alias("cnae_fiscal"))
    return distinct_keys(active_df.join(keys, "cnae_fiscal", "left_semi"), "cnpj")


def target_rows(active_df: DataFrame, targets: DataFrame) -> DataFrame:
    """Active rows whose id is a target (all rows of a repeated id are kept).

    The target ids are distinct (combined map-side, so copies of one id never
    pile up); the semi-join is broadcast when they are small and otherwise a
    sort-merge join whose hot id AQE splits.
    """
    return active_df.join(targets.select("cnpj"), "cnpj", "left_semi")


def prospects(fact: DataFrame) -> DataFrame:
    """Targets that are not current customers."""
    return fact.where(F.col("atual_cliente") == 0)
