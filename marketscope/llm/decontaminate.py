"""Operator 5: benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts become words (lower-cased letters and digits), words become 32-bit hashes.

Embedding. The CGK walk reads a sequence with a pointer: step j emits the symbol
under it and advances by the bit a shared random function gives (j, symbol). Equal
suffixes met at the same step stay equal, so few edits leave most emitted symbols
equal: edit distance becomes Hamming distance.

Search. A table samples some steps of a window's walk; a text window whose samples equal
those of an item's, in any table of any of WALKS walks, makes that item a candidate
there. Windows start along whole texts and along whole items, so any stretch of an item
that the edits leave alone can meet its copy, wherever it lies. TABLES are given by item length:
the fewer words, the shorter the stretches between edits, and the fewer steps are walked and
sampled. A walk as long as the item would embed all of it, but at a fifth of its words
edited next to no such window keeps its samples (recall 0.18 to 0.92, see the README), so
windows follow the stretches instead. Starts are defined by content: a window counts
only where its walk moves on by ``reach`` words or more, since one that lingers samples a word or
two and meets everything.

Items below MIN_WORDS words, and such as have no window, are found by their words: with d edits
allowed one of the first d + 1 words is left alone.

Verification. Myers' bit-parallel search gives the exact smallest edit distance, in
words, of the item against any stretch of the text around the candidate, unless more
of the item's words than edits are allowed are not there at all. A match has
distance <= max_edit * item words.

Recall: measured at 10, 15 and 20 % of the words edited, items of 8 to 500 words (see the
README); exact copies are always found.

Scale: the items are a stated query set, read in blocks of at most BLOCK_BYTES (the
number of blocks follows from their measured size), one block in the driver at a time.
A block is broadcast and its index built once in a Python worker; all documents are scanned in place,
without a shuffle. With several blocks the matches of each are written before the next is read.

Defined cases: null or empty texts have no match; null item texts and items without
a word are never matched; repeated rows each get their matches; an empty
benchmark matches nothing; other columns are kept or ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import written
from marketscope.llm.pool import RunPool, gather, spans

MIN_WORDS = 8
WALKS = 5
#: items from so many words on: tables a walk, steps of a walk, sampled steps, words a walk moves on at least
TABLES = ((8, 3, 8, 5, 3), (12, 2, 10, 7, 4), (24, 1, 12, 9, 5))
MAX_EDIT = 0.2
BLOCK_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
CACHE_WORDS = 300_000
SEED = 7
WORD = re.compile(r"[^\W_]+")
MATCH = "array<struct<item_id:long,item_words:int,start_word:int,end_word:int,distance:int>>"
IS_SPACE = np.array([c in b" \t\n\x0b\x0c\r" for c in range(256)])


def _hashes(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each token, in a row, and how many each has."""
    out: list[int] = []
    sizes = np.ones(len(tokens), dtype=np.int64)
    for i, raw in enumerate(tokens):
        token = raw.lower()                              # ASCII letters only, enough for ASCII tokens
        if token.isalnum():
            out.append(xxhash.xxh32_intdigest(token, SEED) | 1)
            continue
        found = WORD.findall(raw.decode().lower())
        sizes[i] = len(found)
        out += [xxhash.xxh32_intdigest(w, SEED) | 1 for w in found]
    return np.array(out, dtype=np.uint32), sizes


class WordHashes:
    """The words of whole batches of texts as 32-bit hashes, never 0."""

    def __init__(self) -> None:
        self.pool = RunPool(CACHE_WORDS, _hashes)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words of the texts in a row, and where each text's begin and end."""
        raw = [t.encode() for t in texts]
        data = b"\n".join([*raw, b""])
        a = np.frombuffer(data, dtype=np.uint8)
        space = IS_SPACE[a] if len(a) else np.zeros(0, dtype=bool)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))    # start, end, start, ...
        tokens = spans(data, edges)
        numbers = self.pool.numbers(tokens.take(pa.array(np.arange(0, len(tokens), 2))))
        places, ends = gather(self.pool.sizes, numbers)
        words = self.pool.runs[places]
        self.pool.forget()
        stops = np.searchsorted(edges[::2], np.cumsum([len(r) + 1 for r in raw]))
        return words, np.concatenate(([0], np.concatenate(([0], ends))[stops])).astype(np.int64)


class Tables:
    """Sampled steps of each table and the walk that fills them."""

    def __init__(self, walks: int, classes: list[tuple[int, int, int, int, int]]):
        rng = np.random.default_rng(SEED)
        steps = max((c[2] for c in classes), default=0)
        self.walks, self.steps = walks, steps
        # one odd multiplier per walk and 16 steps: a fresh random bit per (step, symbol)
        self.mult = (rng.integers(0, 1 << 31, (walks, steps // 16 + 1), dtype=np.uint64) * 2 + 1).astype(np.uint32)
        # the last step is always sampled, so that a key depends on all of its walk
        self.samples = {(w, least, t): (set(rng.choice(s - 1, sample - 1, replace=False).tolist()) | {s - 1}, reach)
                        for w in range(walks) for least, tables, s, sample, reach in classes for t in range(tables)}

    def keys(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[tuple[int, int, int], np.ndarray, np.ndarray]]:
        """For each table (walk, class, no) the places in ``starts`` of its windows and their keys; ``words`` must end in padding."""
        for w in range(self.walks):
            pos = starts.copy()
            mine = [(k, s, max(s), reach, np.zeros(len(pos), dtype=np.uint32)) for k, (s, reach) in self.samples.items() if k[0] == w]
            for j in range(self.steps):
                if j % 16 == 0:
                    mixed = words * self.mult[w, j // 16]
                m = mixed[pos]
                for k, s, last, reach, acc in mine:
                    if j in s:
                        acc *= np.uint32(0x9E3779B1)
                        acc += m
                        acc ^= acc >> np.uint32(15)
                    if j == last:
                        at = np.flatnonzero(pos - starts >= reach)
                        yield k, at, acc[at]
                m >>= np.uint32(31 - j % 16)
                m &= np.uint32(1)
                pos += m


def myers(item: list[int], text: list[int]) -> list[int]:
    """Smallest edit distance of ``item`` to any stretch of ``text`` ending at each position."""
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    peq: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        peq[w] |= 1 << i
    pv, mv, score, out = full, 0, m, []
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        out.append(score)
    return out


def best_match(item: list[int], text: list[int], lo: int, hi: int, limit: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best stretch of text[lo:hi], or None above ``limit``."""
    scores = myers(item, text[lo:hi])
    if not scores or min(scores) > limit:
        return None
    d = min(scores)
    end = lo + scores.index(d) + 1
    back = myers(item[::-1], text[lo:end][::-1])      # the start: the shortest stretch that reaches d from the end
    start = end - (back.index(d) + 1) if d in back else lo
    return d, start, end


class Lookup:
    """Values of 32 bits and the (item, place) pairs stored under each."""

    def __init__(self, entries: list[tuple[int, int, int]]):
        rows = np.array(sorted(set(entries)), dtype=np.int64).reshape(-1, 3)
        self.items, self.places = rows[:, 1], rows[:, 2]
        self.values, self.first, self.count = np.unique(rows[:, 0].astype(np.uint32), return_index=True, return_counts=True)
        self.some = np.zeros(1 << 16, dtype=bool)        # by upper half: most values of a text end here
        self.some[self.values >> np.uint32(16)] = True

    def meet(self, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(at, item, place) of every stored pair whose value is met."""
        maybe = np.flatnonzero(self.some[values >> np.uint32(16)])
        where = np.minimum(np.searchsorted(self.values, values[maybe]), len(self.values) - 1)
        hit = self.values[where] == values[maybe]
        where, maybe = where[hit], maybe[hit]
        n = self.count[where]
        rows = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(at[maybe], n), self.items[rows], self.places[rows]


class Index:
    """Items of one block, their LSH tables, and the search over a batch of texts."""

    def __init__(self, items: list[tuple[int, str]], max_edit: float = MAX_EDIT, walks: int = WALKS, tables: tuple = TABLES):
        hashes, offsets = WordHashes().of([t for _, t in items])
        words = [(i, hashes[a:b]) for (i, _), a, b in zip(items, offsets, offsets[1:])]
        self.items = [(i, w.tolist()) for i, w in words if len(w)]
        self.max_edit = max_edit
        self.sizes = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.words = [set(w) for _, w in self.items]
        classes = {k: max(t for t in tables if t[0] <= n) for k, n in enumerate(self.sizes.tolist()) if n >= MIN_WORDS}
        self.tables = Tables(walks, sorted(set(classes.values())))
        pad = np.zeros(self.tables.steps + 1, dtype=np.uint32)
        entries: dict[tuple[int, int, int], list[tuple[int, int, int]]] = defaultdict(list)
        short = []
        for k, (_, w) in enumerate(self.items):
            windows = 0
            if k in classes:
                starts = np.arange(len(w) - MIN_WORDS // 2 + 1, dtype=np.int64)
                for key, at, values in self.tables.keys(np.concatenate((np.array(w, dtype=np.uint32), pad)), starts):
                    if key[1] == classes[k][0]:
                        entries[key] += [(v, k, p) for v, p in zip(values.tolist(), at.tolist())]
                        windows += int((at + key[1] <= len(w)).sum())
            if not windows:                              # too short, or no walk that stays within the item moves on enough
                short += [(w[p], k, p) for p in range(min(self.limit(k) + 1, len(w)))]
        self.lookups = {key: Lookup(e) for key, e in entries.items() if e}
        self.short = Lookup(short) if short else None
        self.verified = 0

    def limit(self, item: int) -> int:
        return int(self.max_edit * len(self.items[item][1]))

    def search(self, words: np.ndarray, offsets: np.ndarray) -> list[list[tuple]]:
        """Matches of each text: (item_id, item words, start, end, distance), one per item, the closest and first."""
        found: list[dict[int, tuple]] = [{} for _ in offsets[1:]]
        for doc, item, lo, hi in zip(*(c.tolist() for c in self._candidates(words, offsets))):
            self._verify(item, words, offsets[doc], offsets[doc + 1], lo, hi, found[doc])
        return [sorted((self.items[x][0], len(self.items[x][1]), s, e, d) for x, (d, s, e) in k.items()) for k in found]

    def _candidates(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, first word, word after the last) of the stretches an item may lie in."""
        n = len(words)
        met = []
        if n and self.lookups:
            padded = np.concatenate((words, np.zeros(self.tables.steps + 1, dtype=np.uint32)))
            for key, at, values in self.tables.keys(padded, np.arange(n, dtype=np.int64)):
                if key in self.lookups:
                    met.append(self.lookups[key].meet(values, at))
        if n and self.short:
            met.append(self.short.meet(words, np.arange(n, dtype=np.int64)))
        at, item, place = (np.concatenate(c) for c in zip(*met)) if met else (np.zeros(0, dtype=np.int64),) * 3
        if not len(at):
            return (at,) * 4
        doc = np.searchsorted(offsets, at, side="right") - 1
        guess = at - place                               # where the item would begin
        order = np.lexsort((guess, item, doc))
        doc, item, guess = doc[order], item[order], guess[order]
        size = self.sizes[item]
        slack = size + 1                                 # its copy starts within its own length of the guess
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (guess[1:] - guess[:-1] > 2 * slack[1:] + size[1:])
        first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(doc)) - 1
        return doc[first], item[first], guess[first] - slack[first], guess[last] + size[last] + slack[last]

    def _verify(self, item: int, words: np.ndarray, begin: int, stop: int, lo: int, hi: int, found: dict[int, tuple]) -> None:
        mine, lo, hi = self.items[item][1], max(begin, lo), min(stop, hi)
        text, limit = words[lo:hi].tolist(), self.limit(item)
        self.verified += 1
        if len(self.words[item].difference(text)) > limit:          # each word that is not there costs an edit
            return
        got = best_match(mine, text, 0, len(text), limit)
        if got:
            d, s, e = got
            got = (d, int(s + lo - begin), int(e + lo - begin))
            if item not in found or got < found[item]:
                found[item] = got


_INDEXES: dict[str, Index] = {}


def _index(block: str, shared: Broadcast, max_edit: float, walks: int, tables: tuple) -> Index:
    """The index of a broadcast block, built once in a Python worker; one block is kept."""
    if block not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[block] = Index(shared.value, max_edit, walks, tables)
    return _INDEXES[block]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of at most about ``block_bytes``, fetched one at a time; at least one, maybe empty."""
    src = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(-(-size // block_bytes), 1)
    for k in range(n):
        yield [(r[0], r[1]) for r in src.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toLocalIterator()]


def matches_column(docs: DataFrame, items: list[tuple[int, str]], text: Column, max_edit: float = MAX_EDIT, walks: int = WALKS,
                   tables: tuple = TABLES) -> Column:
    """Column of one block's matches in a text column."""
    shared, block = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    @pandas_udf(MATCH)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, hashes = _index(block, shared, max_edit, walks, tables), WordHashes()
        names = ("item_id", "item_words", "start_word", "end_word", "distance")
        for texts in batches:
            out = []
            for group in _groups([t or "" for t in texts.tolist()]):
                out += [[dict(zip(names, m)) for m in ms] for ms in index.search(*hashes.of(group))]
            yield pd.Series(out, dtype=object)

    return matches(text)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts of about BATCH_BYTES together, or one longer one."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def contamination(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, item_words, start_word, end_word, distance: one row per document and item it holds."""
    parts: list[DataFrame] = []
    for items in item_blocks(benchmark, block_bytes):
        if parts:                                        # more than one block: each is finished before the next is read
            parts[-1] = written(parts[-1], "contamination")
        parts.append(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.explode(matches_column(docs, items, F.col("text"), max_edit)).alias("m")).select("doc_id", "m.*"))
    return reduce(DataFrame.unionByName, parts)


def clean_documents(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns kept."""
    source = docs
    for items in item_blocks(benchmark, block_bytes):
        if docs is not source:
            docs = written(docs, "decontaminated")
        docs = docs.where(F.size(matches_column(docs, items, F.col("text"), max_edit)) == 0)
    return docs
