"""Operator 6: line dedup by winnowing.

A text's lines (split at ``\\n``, compared without surrounding spaces and with inner
spaces made one) that hold a word are hashed. The window of a line is the shortest run
of such lines from there on with at least ``min_words`` words; its smallest line hash is
selected. Only selected lines are fingerprints: one row each, however many windows
selected it. Equal runs of ``min_words`` words hold equal windows, so they share a fingerprint.

Places of one fingerprint are joined with its first place, in order of (doc_id, line), and
with the first place that has the same lines around it; the match is extended line by line both
ways. It takes no more than ``min_words`` - 1 words of neighbours either side: beyond those,
a repeated run has its next fingerprint. A run of at least ``min_words`` words that occurred
earlier is deleted; overlapping ones join. A line's first copy is never deleted.

What follows: every later copy of a line with ``min_words`` words goes, and the shorter lines around
it that repeat with it; a run of shorter lines only goes as far as those two earlier
places hold it.

Scale: the shuffle carries one row per fingerprint, with two line hashes a side at most by
default, combined map-side to first places; a place is compared with two earlier places, never
with all, so a line in a third of all documents costs one row per task there, and AQE splits
it in the join. Spans are gathered per document.

Defined cases: null text stays null and has no lines; null ids come first; repeated
rows (same id, same text) share one key and are not compared with each other;
an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import HASH, HASH2, ID, KEY, ROW, TEXT, keyed, real_id

#: a single line of so many words is a window: shorter ones (names, headings, answers) go only with their neighbours
MIN_WORDS = 3
_NAMES = (*KEY, "kind", "d1", "d2", "at", "lines", "words", "numbers")
_TYPES = (*(pa.int64(),) * 3, pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
_SCHEMA = (f"{ID} long, {HASH} long, {HASH2} long, kind byte, d1 long, d2 long, at int, lines array<long>, words array<int>, "
           "numbers array<int>")
ALONE, AMONG = 0, 1          # kinds of key: the fingerprint, the fingerprint among its neighbours


def line_hashes(text: str) -> tuple[list[int], list[bytes], list[int]]:
    """Line numbers, 128-bit digests and word counts of the lines that hold a word."""
    numbers, digests, words = [], [], []
    for no, line in enumerate(text.split("\n")):
        parts = line.split()
        if parts:
            numbers.append(no)
            digests.append(xxhash.xxh3_128_digest(" ".join(parts)))
            words.append(len(parts))
    return numbers, digests, words


def selected(digests: list[bytes], words: list[int], min_words: int) -> list[int]:
    """Winnowing: the place of the smallest digest of each line's window, each place once, ascending."""
    places, j, total = set(), 0, 0
    for i in range(len(words)):
        while j < len(words) and total < min_words:
            total += words[j]
            j += 1
        if total < min_words:
            break
        places.add(i if j == i + 1 else digests.index(min(digests[i:j]), i, j))
        total -= words[i]
    return sorted(places)


def around(words: list[int], p: int, min_words: int) -> tuple[int, int]:
    """The lines [lo, hi) around place p: as many on each side as hold fewer than ``min_words`` words."""
    lo = hi = p
    room = min_words - 1
    while lo and words[lo - 1] <= room:
        lo -= 1
        room -= words[lo]
    room, hi = min_words - 1, p + 1
    while hi < len(words) and words[hi] <= room:
        room -= words[hi]
        hi += 1
    return lo, hi


def fingerprints(text: str, min_words: int) -> Iterator[tuple]:
    """(kind, digest, place within its neighbours, their hashes, word counts and line numbers) of each fingerprint."""
    numbers, digests, words = line_hashes(text)
    short = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
    for p in selected(digests, words, min_words):
        lo, hi = around(words, p, min_words)
        neighbours = (p - lo, short[lo:hi], words[lo:hi], numbers[lo:hi])
        yield (ALONE, digests[p], *neighbours)
        if hi - lo > 1:
            yield (AMONG, xxhash.xxh3_128_digest(bytes([p - lo & 0xFF]) + digests[p] + b"".join(digests[lo:hi])), *neighbours)


def fingerprint_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per key of every fingerprint of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
                for kind, digest, *rest in fingerprints(text, min_words):
                    out.append((*key, kind, int.from_bytes(digest[:8], "little", signed=True),
                                int.from_bytes(digest[8:], "little", signed=True), *rest))
                if len(out) >= 50_000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return keyed(docs).select(*KEY, TEXT).mapInArrow(rows, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=list(_NAMES))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(ID, HASH, HASH2, spans): line ranges of each document's runs that occurred earlier; documents without one are absent."""
    rows = fingerprint_rows(docs, min_words)
    place, key = F.struct(*KEY, F.col("numbers")[F.col("at")].alias("line")), ["kind", "d1", "d2"]
    first = (rows.groupBy(*key).agg(F.min(F.struct(place.alias("place"), F.col("at").alias("first_at"), F.col("lines").alias("first_lines")))
                                    .alias("first"), F.max(place).alias("last"))
             .where("first.place <> last").select(*key, "first.*"))
    later = rows.join(first, key).where(place != F.col("place"))
    back, on = (_extent(step) for step in (-1, 1))
    runs = later.withColumn("lo", F.col("at") - back).withColumn("n", back + on + 1)
    enough = F.aggregate(F.slice("words", F.col("lo") + 1, F.col("n")), F.lit(0), lambda a, w: a + w) >= min_words
    spans = runs.where(enough).select(*KEY, F.col("numbers")[F.col("lo")].alias("start"),
                                      (F.col("numbers")[F.col("lo") + F.col("n") - 1] + 1).alias("stop"))
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def _extent(step: int) -> Column:
    """Equal lines next to the fingerprint, on (step 1) or back (-1), here and at the first place."""
    def side(lines: str, at: str) -> Column:
        there = F.col(lines)
        return F.slice(there, F.col(at) + 2, F.size(there)) if step > 0 else F.reverse(F.slice(there, F.lit(1), F.col(at)))

    same = F.zip_with(side("lines", "at"), side("first_lines", "first_at"), lambda a, b: F.coalesce(a == b, F.lit(False)))
    unlike = F.array_position(same, False)           # 0: none
    return F.when(unlike > 0, unlike - 1).otherwise(F.size(same)).cast("int")


def merged(ranges: list) -> list[tuple[int, int]]:
    """Ascending ranges joined into disjoint runs."""
    out: list[tuple[int, int]] = []
    for r in ranges:
        if out and r["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r["stop"]))
        else:
            out.append((r["start"], r["stop"]))
    return out


def delete_runs_udf():
    @pandas_udf("text string, removed_lines int, runs array<struct<start:int,stop:int>>")
    def delete_runs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            out = []
            for text, ranges in zip(texts.tolist(), spans.tolist()):
                runs, lines, at, kept = merged(ranges), text.split("\n"), 0, []
                for a, b in runs:
                    kept += lines[at:a]
                    at = b
                out.append(("\n".join(kept + lines[at:]), sum(b - a for a, b in runs), [{"start": a, "stop": b} for a, b in runs]))
            yield pd.DataFrame(out, columns=["text", "removed_lines", "runs"])
    return delete_runs


def _edited(docs: DataFrame, min_words: int) -> DataFrame:
    """(ID, ROW, e): e holds the edited text of the documents that lose lines."""
    joined = keyed(docs, keep_row=True).drop(TEXT).join(repeated_lines(docs, min_words), list(KEY), "left")
    some = F.col("spans").isNotNull()                # texts without spans are not sent to Python
    edit = delete_runs_udf()(F.when(some, F.col(f"{ROW}.text")).otherwise(""), F.coalesce("spans", F.array().cast(
        "array<struct<start:int,stop:int>>")))
    return joined.select(ID, ROW, F.when(some, edit).alias("e"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without later repeated runs, removed_lines, runs (line ranges): one row per input row."""
    return _edited(docs, min_words).select(
        real_id(F.col(ID)).alias("doc_id"), F.coalesce("e.text", F.col(f"{ROW}.text")).alias("text"),
        F.coalesce("e.removed_lines", F.lit(0)).alias("removed_lines"), F.col("e.runs").alias("runs"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with edited texts; n_chars, where present, follows the text of edited rows."""
    edited = _edited(docs, min_words)
    cols = []
    for c in docs.columns:
        old = F.col(f"{ROW}.`{c}`")
        if c == "text":
            old = F.coalesce("e.text", old)
        elif c == "n_chars":
            old = F.coalesce(F.char_length("e.text").cast(docs.schema[c].dataType), old)
        cols.append(old.alias(c))
    return edited.select(*cols)
