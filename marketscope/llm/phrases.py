"""Operator 11: phrase collocation mining by multikey quicksort of suffix pointers.

Texts become pieces and words; a suffix is the word sequence from one place to the end
of its piece, as far as MAX_WORDS words. Counts are per language.

1. Single words are counted. Suffixes end before the first word that is too rare to
   stand in any candidate; a Bloom filter of the frequent words, of bounded size, tells
   in place (a false positive only costs a longer suffix: counting stays exact).
2. Equal suffixes of a batch are combined, then all are routed globally by their leading
   words: by the first two, by three where those two are very common, by all where those
   three are. So a task holds every occurrence of the prefixes it may abandon.
3. In a task, pointers to the suffixes are sorted by multikey three-way quicksort: a range
   is split by its pivot's word at one depth into less, equal, greater; the equal
   part's size is that prefix's count and goes one word deeper; parts lighter than
   ``least`` are abandoned. The few prefixes routed by more words than they have send
   one partial sum a task, added up afterwards.
4. Frequent phrases are scored at every cut, covered ones dropped, the best ranked, in
   DataFrame operations.

Scale: two scans; the shuffle carries distinct suffixes of frequent words, over
partitions in proportion to the number of words (WORDS_PER_TASK each). Very common
prefixes: a batch reports those with a share of 1 / (4 HOT) and more, so that any prefix
with a share of 1 / HOT in the corpus is in the sum of reports; at most 2 HOT prefixes
of a length pass. Ranking takes each task's best rows only (``WindowGroupLimit``).

Defined cases: null or empty texts, and texts without words, add nothing; null lang counts
as ``und``; repeated rows count as often as they stand; ties in rank cannot be (phrases
differ); an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketscope.llm.common import written

LEAST = 30
MAX_WORDS = 4
COVERED = 80                 # percent of a phrase's count that a longer candidate must reach to cover it
SCORE_SCALE = 2_000_000
TOP = 2000
BATCH_BYTES = 4 << 20
WORDS_PER_TASK = 1_000_000
HOT = 20_000
BLOOM_BITS = 16              # per frequent word
BLOOM_MAX_BITS = 1 << 27     # 16 MB, whatever the vocabulary
BLOOM_HASHES = 6
UNKNOWN = "und"

_TABLE = bytearray(range(256))
for _b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_b] = _b + 32
for _b in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_b] = 10
_TABLE[9] = 32
SEPARATORS = bytes(_TABLE)   # lower case; piece ends become \n, tabs spaces: two separators are left


class Tokens:
    """The words of some texts: ``ids`` into ``words``, piece numbers, language numbers."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        data = b"\n".join(texts).translate(SEPARATORS)
        a = np.frombuffer(data, dtype=np.uint8)
        gap = np.ones(len(a) + 2, dtype=np.int8)
        gap[1:-1] = (a == 32) | (a == 10)
        edges = np.flatnonzero(np.diff(gap)).astype(np.int32)          # start, end, start, end, ...
        starts = edges[::2]
        self.piece = np.cumsum(a == 10, dtype=np.int32)[starts]
        runs = pa.Array.from_buffers(pa.binary(), max(len(edges) - 1, 0), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = runs.take(pa.array(np.arange(0, len(runs), 2))).dictionary_encode()
        self.words, self.ids = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
        names = sorted(set(langs))
        self.langs = pa.array(names, pa.string())
        code = {n: i for i, n in enumerate(names)}
        ends = np.cumsum([len(t) + 1 for t in texts])                  # translate keeps lengths
        counts = np.diff(np.searchsorted(starts, ends), prepend=0)
        self.lang = np.repeat(np.array([code[x] for x in langs], dtype=np.int64), counts)

    def lang_words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (language, word) keys, the key number of every place, counts."""
        return np.unique(self.lang * max(len(self.words), 1) + self.ids, return_inverse=True, return_counts=True)

    def follows(self, k: int) -> np.ndarray:
        """Whether the place k words on is in the same piece."""
        out = np.zeros(len(self.ids), dtype=bool)
        if len(self.ids) > k:
            out[:-k] = self.piece[:-k] == self.piece[k:]
        return out


def batches_of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    texts, langs, size = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            texts.append(text)
            langs.append(lang)
            size += len(text)
            if size >= BATCH_BYTES:
                yield Tokens(texts, langs)
                texts, langs, size = [], [], 0
    if size:
        yield Tokens(texts, langs)


def _phrases(words: pa.Array, ids: list[np.ndarray]) -> pa.Array:
    """Space-joined words; id -1 ends a phrase."""
    cols = [words.take(pa.array(i, mask=i < 0)) for i in ids]
    return pc.binary_join_element_wise(*cols, " ", null_handling="skip")


def combined(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of distinct pairs, counts) of two key columns."""
    a, b = (np.unique(k, return_inverse=True) for k in (first, second))
    _, at, n = np.unique(a[1] * max(len(b[0]), 1) + b[1], return_index=True, return_counts=True)
    return at, n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, words, cnt): all words, per language their number (words = 0), common leading pairs and triples."""
    for t in batches_of_text(batches):
        if not len(t.ids):
            continue
        v = max(len(t.words), 1)
        keys, _, n = t.lang_words()
        lang, word = keys // v, keys % v
        parts = [(lang, [word], n)]
        everywhere = np.bincount(t.lang)
        some = np.flatnonzero(everywhere)
        parts.append((some, [], everywhere[some]))
        ids = t.ids
        for k in (1, 2):
            at = np.flatnonzero(t.follows(k))
            lead = (t.lang[at] * v + ids[at]) * v + ids[at + 1]
            where, n = combined(lead, ids[at + 2] if k == 2 else np.zeros(len(at), dtype=np.int64))
            often = n * 4 * HOT >= len(ids)
            where, n = at[where[often]], n[often]
            parts.append((t.lang[where], [ids[where + j] for j in range(k + 1)], n))
        for langs, cols, n in parts:
            phrase = _phrases(t.words, cols) if cols else pa.array([""] * len(n), pa.string())
            yield pa.RecordBatch.from_arrays(
                [t.langs.take(pa.array(langs)), phrase, pa.array(np.full(len(n), len(cols), dtype=np.int32)), pa.array(n.astype(np.int64))],
                names=["lang", "phrase", "words", "cnt"])


# ---- Bloom filter of the frequent words

def bloom_hashes(langs: list[str], words: list[str], bits: int) -> np.ndarray:
    """BLOOM_HASHES bit positions of each (language, word)."""
    seeds = {x: xxhash.xxh32_intdigest(x) for x in set(langs)}
    h = np.array([xxhash.xxh64_intdigest(w, seeds[x]) for x, w in zip(langs, words)], dtype=np.uint64)
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((one[:, None] + two[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)


def bloom_filter(frequent: DataFrame) -> np.ndarray:
    """The filter as bytes: its parts are set in tasks, or-ed by slot, and brought together."""
    count = frequent.count()
    bits = min(max(1 << (count * BLOOM_BITS).bit_length(), 1 << 10), BLOOM_MAX_BITS)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = bloom_hashes(b.column("lang").to_pylist(), b.column("phrase").to_pylist(), bits).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5, pa.int64()), pa.array(np.int64(1) << (at & 31), pa.int64())],
                                             names=["slot", "mask"])

    got = (frequent.select("lang", "phrase").mapInArrow(slots, "slot long, mask long")
           .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas())
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[got["slot"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).astype(np.uint32)
    return out


def may_hold(bloom: np.ndarray, langs: list[str], words: list[str]) -> np.ndarray:
    at = bloom_hashes(langs, words, len(bloom) * 32)
    return ((bloom[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)).all(axis=1)


# ---- suffixes

def suffixes(docs: DataFrame, bloom: np.ndarray, hot: dict[int, list[str]]) -> DataFrame:
    """lang, phrase (2 to MAX_WORDS words), cnt, deal: distinct suffixes of each batch; deal = leading words to route by."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((bloom, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, hot = shared.value
        common = {k: pa.array(hot[k], pa.string()) for k in hot}
        for t in batches_of_text(batches):
            v = max(len(t.words), 1)
            keys, place, _ = t.lang_words()
            if not len(keys):
                continue
            names, words = t.langs.to_pylist(), t.words.to_pylist()
            kept = may_hold(bloom, [names[k] for k in (keys // v).tolist()], [words[k] for k in (keys % v).tolist()])[place]
            n = len(kept)
            reach = kept.copy()
            cols = [t.ids]
            for k in range(1, MAX_WORDS):
                ahead = np.zeros(n, dtype=bool)
                ahead[:-k or None] = kept[k:] if k < n else False
                reach = reach & t.follows(k) & ahead
                col = np.full(n, -1, dtype=np.int64)
                col[reach] = t.ids[np.flatnonzero(reach) + k]
                cols.append(col)
            at = np.flatnonzero(cols[1] >= 0)
            if not len(at):
                continue
            cols = [c[at] for c in cols]
            lead = (t.lang[at] * v + cols[0]) * v + cols[1]
            where, cnt = combined(lead, (cols[2] + 1) * (v + 1) + cols[3] + 1)
            cols, lang = [c[where] for c in cols], t.langs.take(pa.array(t.lang[at][where]))
            deal = np.full(len(where), 2, dtype=np.int32)
            for k in (2, 3):                        # a hot triple's leading pair is hot too
                heads = pc.binary_join_element_wise(lang, _phrases(t.words, cols[:k]), " ")
                deal += np.asarray(pc.is_in(heads, common[k])) & (deal == k) & (cols[k - 1] >= 0)
            yield pa.RecordBatch.from_arrays([lang, _phrases(t.words, cols), pa.array(cnt.astype(np.int64)), pa.array(deal)],
                                             names=["lang", "phrase", "cnt", "deal"])

    return docs.mapInArrow(run, "lang string, phrase string, cnt long, deal int")


def multikey_quicksort(codes: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(pointer, depth, weight) of every prefix of the rows of ``codes`` that weighs ``least`` or more.

    ``codes``: one row a suffix, -1 beyond its end. Pointers are sorted three ways at
    one depth at a time; ranges lighter than ``least`` are abandoned.
    """
    out: list[tuple[int, int, int]] = []
    if not len(codes):
        return out
    stack = [(np.arange(len(codes)), 0)]
    deepest = codes.shape[1]
    while stack:
        pointers, depth = stack.pop()
        k = codes[pointers, depth]
        mid = sorted((k[0], k[len(k) // 2], k[-1]))[1]
        same = k == mid
        if same.all():
            parts = ((pointers, True),)
        else:
            less = k < mid
            parts = ((pointers[less], False), (pointers[same], True), (pointers[~(less | same)], False))
        for part, equal in parts:
            if not len(part):
                continue
            size = int(weight[part].sum())
            if size < least or equal and mid < 0:
                continue
            if not equal:
                stack.append((part, depth))
                continue
            out.append((int(part[0]), depth + 1, size))
            if depth + 1 < deepest:
                stack.append((part, depth + 1))
    return out


def _sorted_counts(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.combine_chunks()
        lang = table.column("lang").combine_chunks().dictionary_encode()
        split = pc.split_pattern(table.column("phrase").combine_chunks(), " ")
        words = split.flatten().dictionary_encode()
        sizes = np.diff(split.offsets.to_numpy())
        codes = np.full((table.num_rows, MAX_WORDS + 1), -1, dtype=np.int32)
        codes[:, 0] = lang.indices.to_numpy()
        codes[:, 1:][np.arange(MAX_WORDS)[None, :] < sizes[:, None]] = words.indices.to_numpy()
        weight, deal = table.column("cnt").to_numpy(), table.column("deal").to_numpy()
        rows: list[tuple[int, int, int]] = []       # pointer, words, count
        for d in (2, 3, 4):
            mine = np.flatnonzero(deal == d)
            rows += [(int(mine[p]), depth - 1, n) for p, depth, n in multikey_quicksort(codes[mine], weight[mine], least) if depth - 1 >= d]
            for k in range(2, d):                   # shorter prefixes are spread over tasks: partial sums
                heads, inverse = np.unique(codes[mine, :k + 1], axis=0, return_inverse=True)
                total = np.bincount(inverse.ravel(), weight[mine], len(heads)).astype(np.int64)
                first = np.zeros(len(heads), dtype=np.int64)
                first[inverse.ravel()] = mine
                rows += list(zip(first.tolist(), [k] * len(heads), total.tolist()))
        for a in range(0, len(rows), 50_000):
            p, k, n = (np.array(c) for c in zip(*rows[a:a + 50_000]))
            dictionary = words.dictionary
            cols = [dictionary.take(pa.array(codes[p, j + 1], mask=k <= j)) for j in range(MAX_WORDS)]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(codes[p, 0])), pc.binary_join_element_wise(*cols, " ", null_handling="skip"),
                 pa.array(k.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "phrase", "words", "cnt"])
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, words_per_task: int = WORDS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of all phrases of 1 to MAX_WORDS words met ``least`` times or more; (lang, n)."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "lang string, phrase string, words int, cnt long"
    counts = written(texts.mapInArrow(_counts, schema).groupBy("lang", "phrase", "words").agg(F.sum("cnt").alias("a"))
                     .where((F.col("words") != 1) | (F.col("a") >= least)), "words")
    n = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    total = n.agg(F.sum("n")).first()[0] or 0
    common = counts.where((F.col("words") >= 2) & (F.col("a") * (2 * HOT) >= total)).select(
        "words", F.concat_ws(" ", "lang", "phrase").alias("head")).collect()       # at most 2 HOT of each length
    hot = {k: [r["head"] for r in common if r["words"] == k] for k in (2, 3)}
    singles = counts.where("words = 1")
    found = suffixes(texts, bloom_filter(singles), hot)
    route = [F.when(F.col("deal") == d, F.substring_index("phrase", " ", d)) for d in (2, 3)]
    dealt = found.repartition(max(-(-total // words_per_task), 1), "lang", F.coalesce(*route, F.col("phrase")))
    longer = (dealt.mapInArrow(_sorted_counts(least), schema).groupBy("lang", "phrase", "words").agg(F.sum("cnt").alias("a"))
              .where(F.col("a") >= least))
    return written(singles.unionByName(longer), "phrases"), n


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score: candidates with their lowest-scoring cut."""
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    cut = phrases.where("words >= 2").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - words)")
    both = (cut.withColumn("part", first).join(parts.withColumnRenamed("count", "l"), ["lang", "part"])
            .withColumn("part", rest).join(parts.withColumnRenamed("count", "r"), ["lang", "part"]))
    score = F.expr(f"(cast(a as decimal(19, 0)) * {SCORE_SCALE}) div (cast(l as decimal(19, 0)) + r)")
    best = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """``candidates`` without those that stand inside a longer one nearly as frequent."""
    w = F.split("phrase", " ")
    inside = candidates.where("words >= 3").select("lang", F.col("a").alias("b"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    gone = F.col("b") * 100 >= F.col("a") * covered
    return candidates.join(most, ["lang", "phrase"], "left").where(~F.coalesce(gone, F.lit(False))).drop("b")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, words_per_task: int = WORDS_PER_TASK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    phrases, n = frequent_phrases(docs, least, words_per_task)
    left = uncovered(scored(phrases)).drop("words")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
