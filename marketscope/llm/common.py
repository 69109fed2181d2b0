"""Helpers shared by the operators: row keys, written tables, connected components.

Row identity. A document is addressed by ``KEY`` = (``ID``, ``HASH``, ``HASH2``): its id (null
ids share the smallest long) and 128 bits of two hashes of its text, so that texts of one id,
or of none, stay apart. Repeated rows (same id, same text) share one key, get the same
result and stay repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.session import shared_dir, ship_package

ROW, ID, HASH, HASH2, TEXT = "__ms_row", "__ms_id", "__ms_hash", "__ms_hash2", "__ms_text"
KEY = (ID, HASH, HASH2)
NULL_ID = -(1 << 63)


#: rows of an Arrow batch at most: what a Python worker holds of its input at once
ARROW_ROWS = 2500


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and bound the batches they are handed."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_column(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def real_id(column: Column) -> Column:
    """The id as given: null where the row had none."""
    return F.when(column != NULL_ID, column)


def text_hashes(text: Column) -> list[Column]:
    """HASH and HASH2 of a text: xxHash64 under two seeds."""
    return [F.xxhash64(text).alias(HASH), F.xxhash64(F.lit(1), text).alias(HASH2)]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """(ID, HASH, HASH2, TEXT[, ROW]); null text counts as empty, ROW packs the whole input row.

    Input columns of any other name stay inside ROW, so they cannot clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cols = [id_column(id_col).alias(ID), *text_hashes(text), text.alias(TEXT)]
    if keep_row:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    return docs.select(*cols)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}") + "/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: (node, root), root = smallest node reachable.

    Alternating large-star and small-star steps. Each step is a group-by minimum
    (combined map-side, so a hub costs one row per task) and an equi-join that brings the
    minimum back to the edges, in which AQE splits the edges of a hub beyond its skew
    threshold; every step is written to the shared folder. Nodes without an edge are not returned.
    """
    pairs = F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    cur = written(edges.where(F.col(a) != F.col(b)).select(pairs.alias("p")).select("p.*").distinct(), "edges")
    state = _signature(cur)
    while state[0]:
        cur = written(_star(_star(cur, large=True), large=False), "edges")
        new = _signature(cur)
        if new == state:
            break
        state = new
    members = cur.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("lo", "hi")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:      # every neighbour above u is linked to the smallest of u and its neighbours
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        out = (both.where("v > u").join(low, "u")
               .select(F.least("m", "u").alias("lo"), F.col("v").alias("hi")))
    else:          # u and its smaller neighbours are linked to the smallest of them
        down = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        out = (down.join(low, "u").where("v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
               .unionByName(low.select(F.col("m").alias("lo"), F.col("u").alias("hi"))))
    return out.where("lo <> hi").distinct()
