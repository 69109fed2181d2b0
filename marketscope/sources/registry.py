"""Registry readers (S1, S2, S4, S5), loaded-table derivations and snapshot metadata.

The registry arrives as headerless ``;``-separated latin-1 files, several per
table, recognised by a file-name suffix. Big tables keep "missing" as the empty
string; code tables turn the usual NA spellings into NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketscope.functions import full_id, lenient_real
from marketscope.sources import schemas as S


@dataclass
class Registry:
    """Loaded registry tables (after the loader's derived columns)."""

    empresas: DataFrame
    estabelecimento: DataFrame
    socios: DataFrame
    simples: DataFrame
    cnae: DataFrame
    motivo: DataFrame
    municipio: DataFrame
    natureza_juridica: DataFrame
    pais: DataFrame
    qualificacao_socio: DataFrame

    def register(self, prefix: str = "") -> None:
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(prefix + f.name)


@dataclass
class Inputs:
    """The company's own files: sales history and CRM leads."""

    vendas: DataFrame
    leads: DataFrame


# --------------------------------------------------------------------------- CSV
def registry_csv_options(multiline: bool = True, strict: bool = False) -> dict[str, str]:
    # Doubled quotes and quoted newlines need escape='"' and multiLine; a
    # multiLine file is read by one task, so callers repartition right after.
    # Permissive mode reads a malformed line with missing fields (they become
    # ''); strict mode fails the load on it.
    return {
        "sep": ";", "header": "false", "encoding": "ISO-8859-1", "quote": '"',
        "escape": '"', "multiLine": str(multiline).lower(), "mode": "FAILFAST" if strict else "PERMISSIVE",
    }


def read_registry_csv(spark: SparkSession, path: str, table: str, suffix: str | None = None,
                      multiline: bool = True, partitions: int | None = None,
                      strict: bool = False) -> DataFrame:
    """Every file under ``path`` ending in the table's suffix, blanks as ''."""
    suffix = suffix or S.REGISTRY_SUFFIX[table]
    df = (spark.read.schema(S.REGISTRY_SCHEMAS[table])
          .options(**registry_csv_options(multiline, strict))
          .option("pathGlobFilter", "*" + suffix)
          .csv(path)
          .na.fill(""))
    if multiline and partitions:
        df = df.repartition(partitions)
    return df


# pandas' default NA spellings (fixed values): a code-table cell equal to one
# of these is read as missing.
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(c: str) -> Column:
    col = F.col(f"`{c}`")
    return F.when(col.isin(PANDAS_NA_VALUES), F.lit(None).cast("string")).otherwise(col).alias(c)


def read_code_table(spark: SparkSession, path: str, table: str | None = None,
                    suffix: str | None = None) -> DataFrame:
    """(codigo, descricao) code table; NA spellings become NULL."""
    suffix = suffix or S.REGISTRY_SUFFIX[table]
    df = (spark.read.schema(S.CODE_SCHEMA)
          .options(**registry_csv_options(True))
          .option("pathGlobFilter", "*" + suffix)
          .csv(path))
    return df.select(*[na_to_null(c) for c in S.CODE_COLUMNS])


def company_csv_options(multiline: bool = True, encoding: str = "UTF-8") -> dict[str, str]:
    """The company's own files: comma, header, doubled quotes, newlines inside quotes.

    ``multiline=False`` lets a large file without quoted newlines be split.
    """
    return {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": str(multiline).lower(),
            "encoding": encoding}


def read_sales_csv(spark: SparkSession, path: str, multiline: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Sales history; NA spellings are NULL, the value keeps its decimals."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in S.VENDAS_SCHEMA])
    raw = spark.read.schema(text).options(**company_csv_options(multiline, encoding)).csv(path)
    keys = [na_to_null(c) for c in S.VENDAS_SCHEMA.names if c != "valor"]
    return raw.select(*keys, F.expr("try_cast(valor AS DECIMAL(28,6))").alias("valor"))


def unparsed_sales(spark: SparkSession, path: str, multiline: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """The sales lines whose value is neither missing nor a number, as text."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in S.VENDAS_SCHEMA])
    raw = spark.read.schema(text).options(**company_csv_options(multiline, encoding)).csv(path)
    return raw.where(F.expr("valor IS NOT NULL AND try_cast(valor AS DECIMAL(28,6)) IS NULL") & ~F.col("valor").isin(PANDAS_NA_VALUES))


def read_leads_csv(spark: SparkSession, path: str, multiline: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Leads; NA spellings are NULL."""
    raw = spark.read.schema(S.LEADS_SCHEMA).options(**company_csv_options(multiline, encoding)).csv(path)
    return raw.select(*[na_to_null(c) for c in S.LEADS_SCHEMA.names])


# ------------------------------------------------------------------ derivations
def load_empresas(raw: DataFrame) -> DataFrame:
    """Capital text -> double appended as ``capital_social``; text dropped."""
    keep = [c for c in S.EMPRESAS_COLUMNS if c != "capital_social_str"]
    return raw.select(*keep, lenient_real("capital_social_str").alias("capital_social"))


def load_estabelecimento(raw: DataFrame) -> DataFrame:
    """Full id appended as ``cnpj``."""
    return raw.select(*S.ESTABELECIMENTO_COLUMNS, full_id().alias("cnpj"))


def head_office_partners(socios_original: DataFrame, estabelecimento: DataFrame) -> DataFrame:
    """Partners keyed by the full id of their company's head office.

    The source's left join filtered on the right side (matriz_filial = '1') is
    an inner join; partners of companies without a head office drop out.
    """
    heads = (estabelecimento.where(F.col("matriz_filial") == "1")
             .select("cnpj_basico", "cnpj"))
    return socios_original.join(heads, "cnpj_basico", "inner").select(*S.SOCIOS_TABLE_COLUMNS)


def registry_from_raw(raw: dict[str, DataFrame]) -> Registry:
    """Apply the loader's derivations to raw registry frames."""
    estab = load_estabelecimento(raw["estabelecimento"])
    return Registry(
        empresas=load_empresas(raw["empresas"]),
        estabelecimento=estab,
        socios=head_office_partners(raw["socios_original"], estab),
        simples=raw["simples"],
        cnae=raw["cnae"], motivo=raw["motivo"], municipio=raw["municipio"],
        natureza_juridica=raw["natureza_juridica"], pais=raw["pais"],
        qualificacao_socio=raw["qualificacao_socio"],
    )


# -------------------------------------------------------------- snapshot metadata
_SNAPSHOT_FIELD = r"^[^.]*\.[^.]*\.D([^.])([^.]{2})([^.]{2})(\.|$)"


def snapshot_date(file_name: Column) -> Column:
    """Third '.' field ``DYMMDD`` of a registry file name -> 'DD/MM/202Y'.

    NULL when the field is not 6 characters starting with 'D'.
    """
    y = F.regexp_extract(file_name, _SNAPSHOT_FIELD, 1)
    m = F.regexp_extract(file_name, _SNAPSHOT_FIELD, 2)
    d = F.regexp_extract(file_name, _SNAPSHOT_FIELD, 3)
    return F.when(y != "", F.concat(d, F.lit("/"), m, F.lit("/202"), y))


def with_snapshot_date(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Attach the snapshot date parsed from each row's source file name."""
    return df.withColumn(column, snapshot_date(F.col("_metadata.file_name")))


#: fixed value: what the reference row holds where no file name has a date
NO_SNAPSHOT = "xx/xx/2024"


def snapshot_metadata(dated: DataFrame, estabelecimento: DataFrame, default: str = NO_SNAPSHOT,
                      date_column: str = "snapshot_date") -> DataFrame:
    """The ``_referencia`` table: snapshot date and establishment count, as text.

    ``dated`` carries the date parsed from its source file names (see
    :func:`with_snapshot_date`); ``default`` is kept when no name has one.
    """
    # the earliest by calendar, not by the day-first text; text that is no date only counts alone
    day = F.to_date(F.try_to_timestamp(date_column, F.lit("dd/MM/yyyy")))
    date = (dated.groupBy(date_column).agg(F.lit(1))
            .agg(F.coalesce(F.min_by(date_column, day), F.min(date_column)).alias("valor"))
            .select(F.lit("CNPJ").alias("referencia"),
                    F.coalesce(F.col("valor"), F.lit(default)).alias("valor")))
    counted = (estabelecimento.agg(F.count(F.lit(1)).cast("string").alias("valor"))
               .select(F.lit("cnpj_qtde").alias("referencia"), "valor"))
    return date.unionByName(counted)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (tabela, linhas) row per table, each a global count."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).cast("bigint").alias("linhas")).select(
            F.lit(name).alias("tabela"), "linhas")
        out = one if out is None else out.unionByName(one)
    return out
