"""Parquet tables: sinks, appends, empty tables, create-as-select.

The registry's SQLite indexes are replaced by file layout: tables are range-
partitioned and sorted by their lookup key before writing, so a point lookup
reads few files and Parquet min/max statistics skip the other row groups.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketscope.sources.registry import Registry

# Lookup key of each registry table (what the source indexed).
SORT_KEYS = {
    "empresas": "cnpj_basico",
    "estabelecimento": "cnpj",
    "socios": "cnpj",
    "simples": "cnpj_basico",
}


# Ids looked up one at a time in tables sorted by another column.
BLOOM_COLUMNS = {
    "empresas": ("cnpj_basico",),
    "estabelecimento": ("cnpj", "cnpj_basico"),
    "socios": ("cnpj_cpf_socio", "nome_socio", "cnpj_basico"),
}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", sort_by: str | None = None,
                files: int | None = None, bloom: tuple[str, ...] = (), row_group_bytes: int | None = None) -> str:
    """Write Parquet (modes: overwrite, append, ignore, error).

    ``bloom`` columns get Bloom filters in the files: a lookup by one of them reads the row
    groups that may hold the id, whatever the sort order (the source's other indexes).
    """
    if sort_by:
        df = (df.repartitionByRange(files, sort_by) if files else df.repartitionByRange(sort_by))
        df = df.sortWithinPartitions(sort_by)
    writer = df.write.mode(mode)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def interleaved(columns: list[Column], bits: int = 16) -> Column:
    """Z-order key: the lowest ``bits`` bits of whole-number columns, interleaved; the first column's lead."""
    out = F.lit(0).cast("long")
    n = len(columns)
    if n * bits > 63:
        raise ValueError(f"{n} columns of {bits} bits do not fit a long")
    for k, c in enumerate(columns):
        value = F.greatest(F.lit(0), F.least(F.coalesce(c, F.lit(0)), F.lit((1 << bits) - 1))).cast("long")
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(value, b).bitwiseAND(1), n * b + n - 1 - k))
    return out


def location_key() -> Column:
    """Clustering key of establishments over (uf, municipio, cep), each spread over 16 bits.

    Codes and postal codes are numbers; a state's letters are taken as base 36 digits.
    """
    state = F.conv(F.upper("uf"), 36, 10).cast("long") * 50
    city = F.expr("try_cast(municipio as long)") * 6
    postal = (F.expr("try_cast(cep as long)") / 1600).cast("long")
    return interleaved([state, city, postal])


def write_clustered(df: DataFrame, path: str, key: Column, files: int) -> str:
    """``files`` files clustered by ``key``, each sorted by it, so that a lookup by any of its columns skips files."""
    name = "__ms_cluster"
    (df.withColumn(name, key).repartitionByRange(files, name).sortWithinPartitions(name).drop(name)
     .write.mode("overwrite").parquet(path))
    return path


def write_snapshot(df: DataFrame, path: str, snapshot: Column, column: str = "snapshot") -> str:
    """Rows under one folder per snapshot date; loading a snapshot again replaces that folder alone."""
    df.withColumn(column, snapshot).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    return path


def replace_table(df: DataFrame, name: str, root: str) -> DataFrame:
    """Replace a catalog table as a whole or not at all.

    Rows are written to a folder of their own; only then the table's location is switched to it and the old
    folder dropped. A failed write leaves the table as it was.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").parquet(path)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
        return spark.table(name)
    old = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    schema = spark.table(name).schema
    if schema.simpleString() != df.schema.simpleString():
        raise ValueError(f"{name} has other columns: {schema.simpleString()}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    _delete(spark, old)
    return spark.table(name)


def _delete(spark: SparkSession, path: str) -> None:
    """Drop a folder this package wrote, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (lazy; filters and columns are pushed into it)."""
    return spark.read.parquet(path)


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table ``read`` opens, or None where its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def create_empty_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An empty table with a fixed schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append_all(spark: SparkSession, chunks: list[DataFrame], path: str) -> DataFrame:
    """Append chunks one after another to the same table, then read it."""
    for i, chunk in enumerate(chunks):
        chunk.write.mode("overwrite" if i == 0 else "append").parquet(path)
    return spark.read.parquet(path)


# Root-level tables: one row per root id, so bucketing them by it is uniform
# (no hot bucket) and their joins on the root id need no shuffle of them.
BUCKETED = {"empresas": "cnpj_basico", "simples": "cnpj_basico"}


#: stored bytes up to which a written table is broadcast (Parquet: memory may take several times that)
BROADCAST_BYTES = 16 << 20


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if its files measure at most ``limit`` bytes.

    For code lists and dimensions joined on a skewed key: the big side then never moves. A larger
    table is left to Spark, which shuffles both sides and splits hot keys.
    """
    return F.broadcast(df) if stored_bytes(df) <= limit else df


#: size of a bucket's file at most, about
BUCKET_BYTES = 128 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files a scanned table is stored in (a listing; partitions filtered out do not count)."""
    files = [f.rsplit("/", 1) for f in df.inputFiles()]
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load(sorted({folder for folder, _ in files}))
    return listed.agg({"length": "sum"}).first()[0] or 0


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a stored table, from its bytes."""
    return max(1, -(-stored_bytes(df) // bucket_bytes))


def catalog_name(table: str, path: str) -> str:
    return f"ms_{table}_{hashlib.sha1(path.encode()).hexdigest()[:12]}"


def write_bucketed_table(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` into ``buckets`` files (an
    external catalog table at ``path``); returns the table."""
    name = catalog_name(table, path)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # one task per bucket: each bucket is one file, not one per writer task
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return spark.table(name)


def bucketed_table(spark: SparkSession, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Declare (if needed) and return the bucketed table written at ``path``."""
    name = catalog_name(table, path)
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def save_registry(r: Registry, root: str, buckets: int | None = None) -> dict[str, str]:
    """Write every registry table under ``root`` (big ones clustered by key)."""
    out = {}
    for name in ("empresas", "estabelecimento", "socios", "simples", "cnae", "motivo", "municipio",
                 "natureza_juridica", "pais", "qualificacao_socio"):
        path = f"{root.rstrip('/')}/{name}"
        if buckets and name in BUCKETED:
            write_bucketed_table(getattr(r, name), path, name, BUCKETED[name], buckets)
        else:
            write_table(getattr(r, name), path, sort_by=SORT_KEYS.get(name), bloom=BLOOM_COLUMNS.get(name, ()))
        out[name] = path
    if buckets:
        write_layout(r.empresas.sparkSession, root, buckets)
    return out


def write_layout(spark: SparkSession, root: str, buckets: int) -> None:
    """Record the bucket layout next to the tables (read back by open_registry)."""
    rows = [(t, k, buckets) for t, k in BUCKETED.items()]
    (spark.createDataFrame(rows, "tabela string, chave string, buckets int").coalesce(1)
     .write.mode("overwrite").json(f"{root.rstrip('/')}/_layout"))


def read_layout(spark: SparkSession, root: str) -> dict[str, tuple[str, int]]:
    schema = "tabela string, chave string, buckets int"
    layout = if_present(lambda: spark.read.schema(schema).json(f"{root.rstrip('/')}/_layout"))
    rows = layout.collect() if layout is not None else []   # no layout: plain tables
    return {r.tabela: (r.chave, r.buckets) for r in rows}


def open_registry(spark: SparkSession, root: str) -> Registry:
    """Registry tables as Parquet scans (bucketed ones through the catalog)."""
    layout = read_layout(spark, root)

    def t(name):
        path = f"{root.rstrip('/')}/{name}"
        if name in layout:
            key, buckets = layout[name]
            return bucketed_table(spark, name, path, key, buckets)
        return spark.read.parquet(path)
    return Registry(**{name: t(name) for name in (
        "empresas", "estabelecimento", "socios", "simples", "cnae", "motivo", "municipio",
        "natureza_juridica", "pais", "qualificacao_socio")})
