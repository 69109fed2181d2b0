"""Operator 3: substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes (each step shifts the state by one bit and
adds a table value, so the 32-bit state is a function of the last 32 bytes). A
position is a cut if its state is the smallest within ``reach`` bytes on either
side: cuts depend on nearby bytes only, so an insertion moves at most the chunks
it touches, and every chunk is longer than ``reach`` bytes. Chunks longer than
MAX_CHUNK (text without a cut, such as one repeated letter) are split there.

Chunks are compared by 128-bit digest. The first of equal chunks, in order of
(doc_id, place), stays; later ones are cut out of their texts.

Scale: chunk rows are recomputed from the scan instead of stored. The group-by on
digest combines map-side, so a passage that a third of all documents share costs
one row per task; the join back only carries digests met twice, and AQE splits a
hot digest. Spans are gathered per document (bounded by its own text).

Defined cases: null text counts as empty; null ids come first; repeated rows
(same id, same text) share one key, so none of them is cut because of the other;
an empty table gives an empty result; other input columns are passed through by
``substring_dedup`` and ignored by the chunk rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import HASH, HASH2, ID, KEY, TEXT, keyed, real_id

REACH = 32
MAX_CHUNK = 4096
#: The gear table follows from this seed: 256 values of a 64-bit linear congruence, upper halves.
GEAR_SEED = 20240229
#: a chunk's bytes [start, stop) are one long, start in the upper half: places in a text compare as such
CHUNKS = f"{ID} long, {HASH} long, {HASH2} long, span long, d1 long, d2 long"


def gear_table(seed: int = GEAR_SEED) -> np.ndarray:
    x, out = seed, np.empty(256, dtype=np.uint32)
    for i in range(256):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out[i] = x >> 32
    return out


GEAR = gear_table()


def gear_states(data: np.ndarray) -> np.ndarray:
    """State after each byte: sum of table values of the last 32 bytes, each shifted by its age."""
    h = GEAR[data]
    for s in (1, 2, 4, 8, 16):
        if len(h) > s:
            h[s:] += h[:-s] << np.uint32(s)
    return h


def cuts(data: np.ndarray, reach: int = REACH, max_chunk: int = MAX_CHUNK) -> np.ndarray:
    """Chunk ends (exclusive), the last one is the text's end; none for an empty text. Cuts fall between code points."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    found = np.empty(0, dtype=np.int64)
    if n > 2 * reach:
        h = gear_states(data)
        low, width = h, 1                        # low[i] = min(h[i : i + width])
        while width < reach:
            step = min(width, reach - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        mid = h[reach:n - reach]
        is_cut = (mid < low[:n - 2 * reach]) & (mid < low[reach + 1:reach + 1 + n - 2 * reach])
        found = np.flatnonzero(is_cut) + reach + 1
    ends = np.append(found[found < n], n)
    starts = np.concatenate(([0], ends[:-1]))
    if (ends - starts).max() > max_chunk:
        ends = np.concatenate([np.append(np.arange(a + max_chunk, b, max_chunk), b) for a, b in zip(starts, ends)])
    inner = ends[:-1]
    for _ in range(3):                           # move off UTF-8 continuation bytes
        inner = np.where((data[np.minimum(inner, n - 1)] & 0xC0) == 0x80, inner + 1, inner)
    return np.append(np.unique(inner[inner < n]), n)


def chunk_rows(docs: DataFrame, reach: int = REACH, max_chunk: int = MAX_CHUNK) -> DataFrame:
    """One row per chunk: document key, byte range, 128-bit digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [c.to_numpy() for c in batch.columns[:3]]
            out, held = [], 0
            for i, text in enumerate(batch.column(3).to_pylist()):
                raw = text.encode()
                ends = cuts(np.frombuffer(raw, dtype=np.uint8), reach, max_chunk)
                if not len(ends):
                    continue
                starts = np.concatenate(([0], ends[:-1]))
                digest = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())])
                d = np.frombuffer(digest, dtype="<i8").reshape(-1, 2)
                span = (starts.astype(np.int64) << 32) | ends
                out.append((*(np.full(len(ends), k[i]) for k in keys), span, d[:, 0], d[:, 1]))
                held += len(ends)
                if held >= 100_000:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)

    return keyed(docs).select(*KEY, TEXT).mapInArrow(rows, CHUNKS)


def _batch(parts: list[tuple]) -> pa.RecordBatch:
    cols = [pa.array(np.ascontiguousarray(np.concatenate(c))) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(cols, names=[*KEY, "span", "d1", "d2"])


def repeated_spans(docs: DataFrame, reach: int = REACH, max_chunk: int = MAX_CHUNK) -> DataFrame:
    """(ID, HASH, HASH2, spans): byte ranges of each document's chunks that occurred earlier; documents without one are absent."""
    chunks = chunk_rows(docs, reach, max_chunk)
    place = F.struct(*KEY, "span")
    first = chunks.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    later = chunks.join(first, ["d1", "d2"]).where(place != F.col("first"))
    span = F.struct(F.shiftright("span", 32).cast("int").alias("start"), F.col("span").bitwiseAND((1 << 32) - 1).cast("int").alias("stop"))
    return later.groupBy(*KEY).agg(F.sort_array(F.collect_set(span)).alias("spans"))


def cut_spans_udf():
    @pandas_udf("string")
    def cut_spans(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """Text without the given byte ranges (ascending, disjoint)."""
        for texts, spans in batches:
            out = []
            for text, ranges in zip(texts.tolist(), spans.tolist()):
                raw, at, parts = text.encode(), 0, []
                for r in ranges:
                    parts.append(raw[at:r["start"]])
                    at = r["stop"]
                out.append(b"".join([*parts, raw[at:]]).decode())
            yield pd.Series(out, dtype=object)
    return cut_spans


def substring_dedup(docs: DataFrame, reach: int = REACH, max_chunk: int = MAX_CHUNK) -> DataFrame:
    """doc_id, text without repeated chunks, removed_bytes, removed_chunks, changed: one row per input row."""
    spans = repeated_spans(docs, reach, max_chunk)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]))
    joined = keyed(docs).select(*KEY, TEXT).join(spans, list(KEY), "left")
    return joined.select(
        real_id(F.col(ID)).alias("doc_id"),
        F.when(F.col("spans").isNull(), F.col(TEXT)).otherwise(
            cut_spans_udf()(F.when(F.col("spans").isNotNull(), F.col(TEXT)).otherwise(""), F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")))).alias("text"),
        F.coalesce(size, F.lit(0)).alias("removed_bytes"),
        F.coalesce(F.size("spans"), F.lit(0)).alias("removed_chunks"),
        F.col("spans").isNotNull().alias("changed"))


__all__ = ["chunk_rows", "cuts", "repeated_spans", "substring_dedup"]
