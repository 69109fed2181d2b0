"""Operator 7: language identification by a linear-chain conditional random field.

Every word (run of letters) of a text is labelled with a language; neighbours are
tied by learned transitions, so code-switched text is cut where the evidence is.
Emission features of a word: prefixes and suffixes of one to four letters, letter
bigrams and trigrams with word ends, the word itself (hashed), and for each
language membership in a lexicon learned from the sample. Posteriors come from
the forward-backward recursion over the whole text. A text's language is the
label with the largest mean posterior; the score is that mean.

Fit: on the driver from a bounded sample, SAMPLE_DOCS documents of each language
(smallest hash of doc_id) and SAMPLE_WORDS consecutive words of each, so its cost does
not depend on the input. Training sequences are spliced from spans of one to three
documents, which teaches the transitions. Log-likelihood is maximised with Adam.

Scale: the model (HASH_SIZE x languages floats, a few hundred KB) travels in a
closure; texts are labelled in place, without a shuffle; the recursion runs over
all texts of a batch at once.

Defined cases: a text that is null or has no letter (digits and other numerals are none) is ``und`` with score 0; without
any learned language every text is; with one, it is predicted for all others;
repeated rows get equal results; ties go to the first language in order of name; an
empty table gives an empty result; other columns are kept, whatever
their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import ROW

SAMPLE_DOCS = 250
SAMPLE_WORDS = 160
HASH_SIZE = 1 << 15
LENGTH = 40              # words of a training sequence
EPOCHS, BATCH, RATE, DECAY = 5, 64, 0.05, 1e-4
LEXICON_COUNT, LEXICON_SHARE = 4, 0.8
CACHE_WORDS = 150_000
BATCH_WORDS = 800_000
SEED = 11
UNKNOWN = "und"
LANG = "__ms_lang"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    words = WORD.findall(text.lower()) if text else []
    if not text or text.isascii() or all(map(str.isalpha, words)):
        return words
    # \w also matches numerals that are no digits (fractions, superscripts, Roman ones): they are no letters
    return [w for word in words for w in "".join(c if c.isalpha() else " " for c in word).split()]


def _mixed(salt: int, *symbols: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols, in [0, HASH_SIZE)."""
    h = np.full(len(symbols[0]), salt, dtype=np.uint64)
    for c in symbols:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(24)) % np.uint64(HASH_SIZE)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed affix, n-gram and word features of all words, word after word, and how many each has."""
    letters = np.array([len(w) for w in words], dtype=np.int64)
    c = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    starts = np.cumsum(letters + 2) - (letters + 2)
    owner = np.repeat(np.arange(len(words)), letters + 2)
    power = np.full(int(letters.max(initial=0)) + 2, 0x100000001B3, dtype=np.uint64).cumprod()
    whole = np.add.reduceat(c * power[np.arange(len(c)) - starts[owner]], starts)
    found = [(np.arange(len(words)), _mixed(1, whole))]
    for k in (1, 2, 3, 4):
        some = np.flatnonzero(letters >= k)
        first, last = starts[some] + 1, starts[some] + letters[some]
        found.append((some, _mixed(10 + k, *[c[first + j] for j in range(k)])))
        found.append((some, _mixed(20 + k, *[c[last - j] for j in range(k)])))
    for k in (2, 3):
        at = np.flatnonzero(owner[:len(c) - k + 1] == owner[k - 1:])
        found.append((owner[at], _mixed(30 + k, *[c[at + j] for j in range(k)])))
    owners = np.concatenate([o for o, _ in found])
    order = np.argsort(owners, kind="stable")
    return np.concatenate([f for _, f in found])[order], np.bincount(owners, minlength=len(words))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray = field(repr=False)        # (HASH_SIZE + labels, labels): hashed features, then lexicons
    transitions: np.ndarray = field(repr=False)    # (labels, labels) scores
    lexicon: dict[str, int] = field(repr=False)

    def feature_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Features and lexicon entries of the words, word after word, and how many each has."""
        flat, sizes = features(words)
        known = np.array([self.lexicon.get(w, -1) for w in words], dtype=np.int64)
        some = np.flatnonzero(known >= 0)
        flat = np.insert(flat, np.cumsum(sizes)[some], HASH_SIZE + known[some])
        sizes[some] += 1
        return flat, sizes

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores (words, labels)."""
        if not words:
            return np.zeros((0, len(self.labels)), dtype=np.float32)
        flat, sizes = self.feature_ids(words)
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0)


def posterior_means(model: Model, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean posterior of each label over each sequence, and, in a last column, the mean of each word's largest posterior.

    Forward-backward over all sequences at once. ``scores`` holds the sequences one after another; every length is at least 1.
    """
    k = len(model.labels)
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    n = lengths[order]
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(model.transitions - model.transitions.max()).astype(e.dtype)
    active = np.searchsorted(-n, -np.arange(n[0]), side="left")      # sequences longer than t
    alphas = np.empty_like(e)
    alpha = np.full((len(n), k), 1.0, dtype=e.dtype)
    for t in range(int(n[0])):
        m = active[t]
        at = first[:m] + t
        alpha = (alpha[:m] @ a if t else alpha[:m]) * e[at]
        alpha /= alpha.sum(axis=1, keepdims=True)
        alphas[at] = alpha
    sums = np.zeros((len(n), k + 1))
    beta = np.empty((0, k), dtype=e.dtype)
    back = a.T.copy()
    for t in range(int(n[0]) - 1, -1, -1):
        m = active[t]
        grown = np.ones((m, k), dtype=e.dtype)                       # sequences that end at t start with ones
        if len(beta):
            grown[:len(beta)] = (beta * e[first[:len(beta)] + t + 1]) @ back
            grown /= grown.sum(axis=1, keepdims=True)
        beta = grown
        post = alphas[first[:m] + t] * beta
        post /= post.sum(axis=1, keepdims=True)
        sums[:m, :k] += post
        sums[:m, k] += post.max(axis=1)
    out = np.empty((len(n), k + 1))
    out[order] = sums / n[:, None]
    return out


def fit(texts: list[tuple[str, str]], seed: int = SEED) -> Model:
    """Model from (language, text) pairs."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in texts})
    index = {lab: i for i, lab in enumerate(labels)}
    docs: list[list[list[str]]] = [[] for _ in labels]
    for lang, text in sorted(texts):
        words = words_of(text)
        if words:
            at = int(rng.integers(0, max(1, len(words) - SAMPLE_WORDS + 1)))
            docs[index[lang]].append(words[at:at + SAMPLE_WORDS])
    k = len(labels)
    counts = [Counter(w for d in ds for w in d) for ds in docs]
    total = sum(counts, Counter())
    lexicon = {w: i for i, c in enumerate(counts) for w, n in c.items()
               if n >= LEXICON_COUNT and n >= LEXICON_SHARE * total[w]}
    model = Model(labels, np.zeros((HASH_SIZE + k, k), dtype=np.float32), np.zeros((k, k), dtype=np.float32), lexicon)
    usable = [i for i, d in enumerate(docs) if d]
    if k < 2 or not usable:
        return model
    # sequences spliced from spans of up to three documents
    n_seq = sum(len(w) for d in docs for w in d) // LENGTH + 1
    seq_words, seq_labels = [], np.zeros((n_seq, LENGTH), dtype=np.int64)
    for s in range(n_seq):
        spans = int(rng.integers(1, 4))
        edges = np.sort(rng.integers(1, LENGTH, spans - 1)).tolist() + [LENGTH]
        row, at = [], 0
        for end in edges:
            lab = usable[int(rng.integers(len(usable)))]
            while at < end:
                d = docs[lab][int(rng.integers(len(docs[lab])))]
                start = int(rng.integers(0, len(d)))
                take = d[start:start + end - at]
                row += take
                seq_labels[s, at:at + len(take)] = lab
                at += len(take)
        seq_words.append(row)
    vocab = {w: i for i, w in enumerate(sorted({w for r in seq_words for w in r}))}
    flat, sizes = model.feature_ids(list(vocab))
    ids = np.split(flat, np.cumsum(sizes)[:-1])
    seq_ids = np.array([[vocab[w] for w in r] for r in seq_words])
    params = {"w": model.weights, "t": model.transitions}
    mom = {p: [np.zeros_like(v), np.zeros_like(v)] for p, v in params.items()}
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(n_seq), max(1, n_seq // BATCH)):
            step += 1
            grads = gradient(model, [ids[i] for i in seq_ids[rows].ravel()], seq_labels[rows])
            for p, v in params.items():
                g = grads[p] - DECAY * v
                m1, m2 = mom[p]
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                v += RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return model


def gradient(model: Model, ids: list[np.ndarray], gold: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log-likelihood of equally long sequences: observed minus expected counts."""
    n, length = gold.shape
    k = len(model.labels)
    sizes = np.array([len(i) for i in ids])
    flat = np.concatenate(ids)
    scores = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0).reshape(n, length, k).astype(np.float64)
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a = np.exp(model.transitions.astype(np.float64))
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        alpha[:, t] = alpha[:, t - 1] @ a * e[:, t]
        alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (beta[:, t + 1] * e[:, t + 1]) @ a.T
        beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    pairs = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    onehot = np.eye(k)[gold]
    diff = ((onehot - post) / n).reshape(-1, k)
    rows = np.repeat(diff, sizes, axis=0)
    size = len(model.weights)
    gw = np.stack([np.bincount(flat, rows[:, j], size) for j in range(k)], axis=1)
    gt = (np.einsum("ntj,ntk->jk", onehot[:, :-1], onehot[:, 1:]) - pairs.sum(axis=(0, 1))) / n
    return {"w": gw.astype(np.float32), "t": gt.astype(np.float32)}


def letter_blocks(words: list[str], letters: int = 200_000) -> Iterator[list[str]]:
    """Words of about so many letters together, or one longer one."""
    block, size = [], 0
    for w in words:
        block.append(w)
        size += len(w)
        if size >= letters:
            yield block
            block, size = [], 0
    if block:
        yield block


class Labeller:
    """Whole texts to (label, score), with a bounded cache of word emissions."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)), dtype=np.float32)

    def label(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, its mean posterior, mean of each word's largest posterior) of each text."""
        out: list[tuple[str, float, float]] = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        if not self.model.labels:
            return out
        rows, at, size = [], [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            if words:
                rows.append(self._ids(words))
                at.append(i)
                size += len(words)
            if size >= BATCH_WORDS or (i == len(texts) - 1 and rows):
                self._flush(rows, at, out)
                rows, at, size = [], [], 0
        return out

    def _ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        for w in new:
            known[w] = len(known)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))

    def _flush(self, rows: list[np.ndarray], at: list[int], out: list) -> None:
        if len(self.known) > len(self.scores):
            fresh = list(self.known)[len(self.scores):]
            blocks = [self.model.emissions(b) for b in letter_blocks(fresh)]
            self.scores = np.concatenate([self.scores, *blocks]).astype(np.float32)
        lengths = np.array([len(r) for r in rows])
        means = posterior_means(self.model, self.scores[np.concatenate(rows)], lengths)
        for i, m in zip(at, means):
            j = int(m[:-1].argmax())
            out[i] = (self.model.labels[j], float(min(1.0, max(0.0, m[j]))), float(min(1.0, max(0.0, m[-1]))))
        if len(self.known) > CACHE_WORDS:
            self._reset()


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """(lang, text) of at most ``per_language`` documents of each language, those with the smallest hash of doc_id."""
    rows = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id").alias("h"))
    slim = rows.groupBy("lang", "h").agg(F.lit(1))                    # the choice moves no text
    # dealt by (lang, h), then each task's smallest ones by language: grouping the window by another
    # expression than lang keeps Spark from dealing all rows by language at once
    window = Window.partitionBy(F.struct("lang")).orderBy("h")
    top = slim.withColumn("r", F.row_number().over(window)).where(F.col("r") <= per_language)
    chosen = F.lit(False)
    for lang, last in top.groupBy("lang").agg(F.max("h")).collect():
        chosen = chosen | ((F.col("lang") == lang) & (F.col("h") <= last))
    # one text per id: repeated rows must not fill the sample
    texts = rows.where(chosen).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return [(r[0], r[1]) for r in texts.orderBy("lang", "h").select("lang", "text").toLocalIterator()]


def language_column(model: Model, text: Column) -> Column:
    """struct<lang, score, certainty> of a text column.

    certainty: the way from a uniform guess (0) to certainty (1) of the words' own languages on
    average, whichever they are: code-switched text is as certain as text in one language.
    """
    uniform = 1 / max(len(model.labels), 1)

    @pandas_udf("lang string, score double, certainty double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model)
        for texts in batches:
            out = pd.DataFrame(labeller.label(texts.tolist()), columns=["lang", "score", "certainty"])
            if uniform < 1:
                out["certainty"] = (out["certainty"] - uniform).clip(lower=0.0) / (1 - uniform)
            yield out

    return label(text)


def held_out(docs_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; null ids are not held out."""
    return F.coalesce(F.crc32(docs_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_language(docs: DataFrame, train: DataFrame) -> DataFrame:
    """(ROW, LANG): each row of ``docs`` as a struct, so that no name clashes, and struct<lang, score, certainty>."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)
    return docs.select(row, language_column(fit(sample(train)), F.col("text")).alias(LANG))
