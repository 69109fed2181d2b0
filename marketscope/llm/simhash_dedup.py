"""Operator 4: SimHash near-dedup with multi-index hashing.

Fingerprint: texts are lower-cased (A-Z), split at ``[\\x20\\x09-\\x0D]+`` into words
and shingled; each shingle, repeats included, is hashed with XXH64 (seed 42); a
bit is 1 if it is set in more than half the hashes. A text with fewer words than
the shingle length is one shingle; a text without words has fingerprint zero.

Search: distinct fingerprints are cut into segments. Two fingerprints at most
``max_bits`` apart agree within a small radius on some segment (radius a on the
first max_bits mod m + 1 segments, a - 1 on the others, a = max_bits div m), so
each fingerprint looks up the Hamming ball of that radius around each of its
segment values, and the complete distance of every match is verified.

Large groups: no bucket is expanded into all pairs. First each fingerprint is
only compared with one representative per bucket (the smallest under two
orders); these links give provisional components. Then only pairs of different
provisional components are verified: in a bucket, members of its largest
component are compared with the members of others, never with each other. Pairs
left out are already in one component, so components are exact.

Defined cases: null text counts as empty; null ids are the smallest (component_id
null if one is reachable); repeated rows share a result and stay repeated; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import ID, KEY, ROW, components, id_column, keyed, real_id, text_hashes, written

SEED = 42
BITS = 64
SEGMENTS = 3


def shingle_hashes(text: str, shingle: int) -> list[int]:
    # bytes.lower() maps A-Z only, bytes.split() splits at exactly [\x20\x09-\x0D]+
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [h(b" ".join(words), SEED)]
    joined, starts, at = b" ".join(words), [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    return [h(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])]


def simhash(text: str, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint."""
    hashes = shingle_hashes(text, shingle)
    if not hashes:
        return 0
    raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(raw), 4096):
        counts += np.unpackbits(raw[i:i + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(raw)).tobytes(), "big")


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, shingle) for t in texts.tolist()], dtype=np.uint64).astype(np.int64))
    return fingerprint


def segment_plan(max_bits: int, segments: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment; segments with a negative radius are not searched."""
    segments = min(segments, BITS)
    a, extra = divmod(max_bits, segments)
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    plan, shift = [], 0
    for i, w in enumerate(widths):
        plan.append((shift, w, a if i <= extra else a - 1))
        shift += w
    return [p for p in plan if p[2] >= 0]


def ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _entries(fps: DataFrame, plan: list[tuple[int, int, int]], probes: bool, extra: list[str]) -> DataFrame:
    """(seg, val, fp, extra): every fingerprint's own segment values, or with ``probes`` the ball around them."""
    arms = []
    for i, (shift, width, radius) in enumerate(plan):
        val = F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)
        if probes:
            masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
            arms.append(_around(masks, i, val))
        else:
            arms.append(F.array(F.struct(F.lit(i).alias("seg"), val.alias("val"))))
    return fps.select("fp", *extra, F.explode(F.concat(*arms)).alias("e")).select("e.seg", "e.val", "fp", *extra)


def _around(masks: Column, seg: int, val: Column) -> Column:
    return F.transform(masks, lambda m: F.struct(F.lit(seg).alias("seg"), val.bitwiseXOR(m).alias("val")))


def _met(probes: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Equi-join of exploded rows, by sort-merge: Spark sizes them as the rows before the explode and may broadcast them."""
    return probes.join(table.hint("merge"), key)


def near_links(fps: DataFrame, max_bits: int, segments: int = SEGMENTS) -> DataFrame:
    """Edges (a, b) whose components are those of the full "max_bits or fewer" graph over distinct fingerprints."""
    plan, key = segment_plan(max_bits, segments), ["seg", "val"]
    def near(other: str) -> Column:
        return (F.bit_count(F.col("fp").bitwiseXOR(F.col(other))) <= max_bits) & (F.col("fp") != F.col(other))

    table = _entries(fps, plan, False, [])
    star = table.groupBy(*key).agg(F.min("fp").alias("r1"), F.min_by("fp", F.xxhash64("fp")).alias("r2"))
    stars = (_met(_entries(fps, plan, True, []), star, key).where(near("r1") | near("r2"))
             .select("fp", F.explode(F.array_distinct(F.array("r1", "r2"))).alias("other")).where(near("other")))
    stars = written(stars.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct(), "star-links")
    labelled = written(fps.join(components(stars).withColumnRenamed("node", "fp"), "fp", "left")
                       .select("fp", F.coalesce("root", "fp").alias("comp")), "provisional")
    # per bucket its largest provisional component; members of it meet only members of others.
    # A bucket of one or two fingerprints is known by its ends, so its distances are verified in the lookup
    table = _entries(labelled, plan, False, ["comp"])
    major = (table.groupBy(*key, "comp").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
             .groupBy(*key).agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.count("*").alias("comps"),
                                F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    rows = _met(table, major.select(*key, "major"), key).select(
        *key, (F.col("comp") == F.col("major")).alias("in_major"), F.col("fp").alias("other"), F.col("comp").alias("other_comp"))
    sides = F.when(F.col("comp") == F.col("major"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    alone = (F.col("comps") == 1) & (F.col("comp") == F.col("major"))
    probes = (_met(_entries(labelled, plan, True, ["comp"]), major, key)
              .where(~alone & ((F.col("n") > 2) | near("lo") | near("hi")))
              .select(*key, "fp", "comp", F.explode(sides).alias("in_major")))
    cross = (_met(probes, rows, [*key, "in_major"])
             .where((F.col("comp") != F.col("other_comp")) & near("other"))
             .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct())
    return stars.unionByName(cross)


def near_dedup(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = SEGMENTS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, component_size: one row per input row."""
    prints = _prints(docs, [id_column().alias(ID)], shingle)
    labelled = _labelled(prints, F.col(ID), max_bits, segments)
    totals = labelled.groupBy("root").agg(F.min("first").alias("component"), F.sum("n").alias("size"))
    # a row of each fingerprint or document on both sides: sort-merge, so that none is gathered in the driver
    by_fp = labelled.select("fp", "root").join(totals.hint("merge"), "root").drop("root")
    return prints.join(by_fp.hint("merge"), "fp").select(
        real_id(F.col(ID)).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        real_id(F.col("component")).alias("component_id"), F.col("size").alias("component_size"))


def _prints(docs: DataFrame, key: list[Column], shingle: int) -> DataFrame:
    """(key, fp): the fingerprint of every row."""
    return written(docs.select(*key, fingerprint_udf(shingle)(F.coalesce("text", F.lit(""))).alias("fp")), "simhash")


def _labelled(prints: DataFrame, key: Column, max_bits: int, segments: int) -> DataFrame:
    """(fp, root, first, n): each fingerprint's component root, smallest key and number of rows."""
    fps = written(prints.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("n")), "simhash-distinct")
    roots = components(near_links(fps.select("fp"), max_bits, segments))
    labelled = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return written(labelled, "simhash-labels")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = SEGMENTS) -> DataFrame:
    """``docs`` with one row of each component: the smallest by id, then by the hashes of its text.

    Components are told apart by their fingerprint root, never by an id: rows of one id
    (or of none) with different texts may belong to several.
    """
    prints = _prints(docs, [id_column().alias(ID), *text_hashes(F.coalesce("text", F.lit("")))], shingle)
    first = _labelled(prints, F.struct(*KEY), max_bits, segments).groupBy("root").agg(F.min("first").alias("first"))
    rows = keyed(docs, keep_row=True).select(*KEY, ROW)
    # sort-merge: first has a row of each component; the rows of a key meet for dropDuplicates in any case
    return rows.join(first.select("first.*").hint("merge"), list(KEY), "left_semi").dropDuplicates(list(KEY)).select(f"{ROW}.*")
