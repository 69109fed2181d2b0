"""Operator 1: exact dedup by composable polynomial fingerprints.

A text, without the characters of ``[\\x20\\x09-\\x0D]``, is hashed chunk by chunk;
chunk hashes combine by length-shifted arithmetic, H(ab) = H(a) * B**len(b) + H(b),
so any cut of a huge text gives the same fingerprint. Texts of equal fingerprint
and length are then compared chunk by chunk with their group's representative;
a text that differs leaves the group (keyed by its SHA-256) and is compared again.

Scale: one pass writes (id, fingerprint) rows; groups are counted by a combined
group-by. Only texts in groups of two or more reach the comparison join, whose
key is salted by member, so a group holding a third of all rows spreads over
ceil(size / SALT_MEMBERS) keys.

Defined cases: null text is the empty text; null ids count as larger than any id
when ties are broken (a row with an id stays); repeated rows (same id, same text)
each count in group_size and all carry ``kept`` if they are the kept row; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import ID, NULL_ID, id_column, real_id, written

SPACES = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 16
SALT_MEMBERS = 256
PRIMES = (2147483647, 2147483629)     # two primes under 2**31: products fit in 64 bits
BASES = (1103515245, 1566083941)


class PolyHash:
    """Polynomial hash of bytes modulo each prime, composable over any chunking."""

    def __init__(self, primes: tuple[int, ...] = PRIMES, chunk_bytes: int = CHUNK_BYTES):
        self.primes, self.chunk = primes, chunk_bytes
        self.powers = []
        for p, base in zip(primes, BASES):
            pw = np.empty(chunk_bytes, dtype=np.uint64)
            x = 1
            for i in range(chunk_bytes):
                pw[chunk_bytes - 1 - i] = x
                x = x * base % p
            self.powers.append(pw)

    def chunk_hash(self, data: bytes) -> tuple[int, ...]:
        """Hash of one chunk of at most ``chunk`` bytes; chunks can be hashed anywhere, in any order."""
        raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
        n = len(raw)
        return tuple(int(raw @ pw[self.chunk - n:]) % p for pw, p in zip(self.powers, self.primes))

    def combine(self, left: tuple[int, ...], right: tuple[int, ...], right_bytes: int) -> tuple[int, ...]:
        return tuple((a * pow(base, right_bytes, p) + b) % p
                     for a, b, p, base in zip(left, right, self.primes, BASES))

    def of_chunks(self, chunks: list[bytes]) -> tuple[int, ...]:
        total: tuple[int, ...] = (0,) * len(self.primes)
        for c in chunks:
            total = self.combine(total, self.chunk_hash(c), len(c))
        return total


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, SPACES)


def chunks_of(data: bytes, size: int) -> list[bytes]:
    return [data[i:i + size] for i in range(0, len(data), size)]


def fingerprint_udf(primes: tuple[int, ...], chunk_bytes: int):
    @pandas_udf("n_points long, n_bytes long, fp long, sha string")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        poly = PolyHash(primes, chunk_bytes)
        for texts in batches:
            rows = []
            for text in texts.tolist():
                data = normalised(text)
                hi, lo = poly.of_chunks(chunks_of(data, chunk_bytes))
                rows.append((len(text), len(data), (hi << 31) | lo, hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_points", "n_bytes", "fp", "sha"])
    return fingerprint


def chunk_udf(chunk_bytes: int):
    @pandas_udf("array<binary>")
    def chunk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([chunks_of(normalised(t), chunk_bytes) for t in texts.tolist()])
    return chunk


def exact_dedup(docs: DataFrame, primes: tuple[int, ...] = PRIMES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    fingerprint = fingerprint_udf(primes, chunk_bytes)
    src = docs.select(id_column().alias(ID), F.coalesce("text", F.lit("")).alias("text"))
    prints = written(src.select(ID, fingerprint("text").alias("f")).select(ID, "f.*"), "fingerprints")
    split = None                 # (fp, n_bytes, sha) of texts that differ from their group's representative
    while True:
        keys, tagged = ["fp", "n_bytes", "tag"], prints.withColumn("tag", F.lit(""))
        if split is not None:
            tagged = (prints.join(split.withColumn("tag", F.col("sha")), ["fp", "n_bytes", "sha"], "left")
                      .withColumn("tag", F.coalesce("tag", F.lit(""))))
        # largest (code points, -id): null ids have the smallest long, so they must come last
        order = F.struct("n_points", (F.col(ID) != NULL_ID).alias("has_id"), F.bitwise_not(ID).alias("neg"), "sha")
        groups = written(tagged.groupBy(*keys).agg(F.count("*").alias("size"), F.max(order).alias("best")), "groups")
        differ = _unequal(src, groups.where("size > 1"), fingerprint, split, chunk_bytes)
        if differ.isEmpty():
            break
        split = differ if split is None else split.unionByName(differ).distinct()
    best_id = F.when(F.col("best.has_id"), F.bitwise_not("best.neg"))
    return tagged.join(groups.select(*keys, "size", "best"), keys).select(
        real_id(F.col(ID)).alias("doc_id"), best_id.alias("keep_id"), F.col("size").alias("group_size"),
        (F.col(ID) == F.coalesce(best_id, F.lit(NULL_ID))).alias("kept"), F.col("sha").alias("text_sha256"))


def _unequal(src: DataFrame, groups: DataFrame, fingerprint, split: DataFrame | None, chunk_bytes: int) -> DataFrame:
    """(fp, n_bytes, sha) of members whose text differs from the representative's in some chunk."""
    members = src.select(ID, "text", fingerprint("text").alias("f")).select(ID, "text", "f.fp", "f.n_bytes", "f.sha")
    if split is None:
        members = members.withColumn("tag", F.lit(""))
    else:
        members = (members.join(split.withColumn("tag", F.col("sha")), ["fp", "n_bytes", "sha"], "left")
                   .withColumn("tag", F.coalesce("tag", F.lit(""))))
    salts = F.greatest(F.lit(1), F.ceil(F.col("size") / SALT_MEMBERS)).cast("int")
    rows = (members.join(groups.select("fp", "n_bytes", "tag", salts.alias("salts"), F.col("best.sha").alias("rep")),
                         ["fp", "n_bytes", "tag"])
            .withColumn("chunks", chunk_udf(chunk_bytes)("text")).drop("text"))
    rows = written(rows, "members")
    keys = ["fp", "n_bytes", "tag", "salt", "no"]
    reps = (rows.where("sha = rep").groupBy("fp", "n_bytes", "tag", "salts").agg(F.first("chunks").alias("chunks"))
            .select("fp", "n_bytes", "tag", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "chunks")
            .select("fp", "n_bytes", "tag", "salt", F.posexplode("chunks").alias("no", "rep_chunk")))
    own = (rows.withColumn("salt", F.pmod(F.hash(ID), "salts"))
           .select("fp", "n_bytes", "tag", "salt", "sha", F.posexplode("chunks").alias("no", "chunk")))
    return (own.join(reps, keys).where("chunk <> rep_chunk").select("fp", "n_bytes", "sha").distinct())
