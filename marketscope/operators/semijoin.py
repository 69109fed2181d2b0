"""Semi-joins whose big side is thinned out before it moves.

The key set, usually far smaller than the table it selects from, is summed up in a Bloom
filter: an array of 64-bit words in a one-row table. The big side is filtered with it in its
scan stage, as an ordinary condition on a scalar subquery, and only what passes is
shuffled for the exact semi-join. False positives cost a shuffled row, never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketscope.session import shared_dir

BITS_PER_KEY = 10
#: 4 MB, whatever the number of keys; fuller filters let more rows through
MAX_BITS = 1 << 25
PROBES = 3


def _bits(keys: int) -> int:
    return min(max(1 << (keys * BITS_PER_KEY).bit_length(), 1 << 10), MAX_BITS)


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(PROBES)]


def bloom_filter(keys: DataFrame, column: str) -> DataFrame:
    """One row: bits (array of 64-bit words), size in bits; written, so that it is built once.

    Words are or-ed map-side: a task sends no more rows than the filter has words.
    """
    bits = _bits(keys.count())
    place = F.explode(F.array(*_places(F.col(column), bits)))
    words = (keys.select(place.alias("p")).select((F.col("p") / 64).cast("long").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "w").join(words, "w", "left")
    row = every.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("s"))
    path = shared_dir(keys.sparkSession, "bloom")
    row.select(F.col("s.b").alias("bits"), F.lit(bits).cast("long").alias("size")).coalesce(1).write.mode("overwrite").parquet(path)
    return keys.sparkSession.read.schema("bits array<long>, size long").parquet(path)


def may_contain(bloom: DataFrame, key: Column) -> Column:
    """Whether the filter may hold ``key``: a condition without a join."""
    bits = bloom.select("bits").scalar()
    size = bloom.select("size").first()[0]
    found = F.lit(True)
    for p in _places(key, size):
        found = found & (F.get(bits, (p / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0)
    return found


def bloom_semi_join(big: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """``big`` left-semi-joined with the distinct, non-null ``keys``; the rows of ``big`` are thinned out first."""
    path = shared_dir(keys.sparkSession, "keys")
    keys.select(F.col(key or on).alias(on)).where(F.col(on).isNotNull()).distinct().write.mode("overwrite").parquet(path)
    stored = keys.sparkSession.read.schema(f"`{on}` {big.schema[on].dataType.simpleString()}").parquet(path)
    return big.where(may_contain(bloom_filter(stored, on), F.col(on))).join(stored, on, "left_semi")
