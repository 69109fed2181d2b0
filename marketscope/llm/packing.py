"""Operator 9: best-fit packing of token sequences by bin completion.

Documents are tokenised (ids of a public tokenizer plus an end id); longer ones than
``capacity`` are cut into pieces, the first of which may be shorter. Pieces of one
length are interchangeable, so the plan is made on the histogram of lengths (at most
``capacity`` rows, whatever the input), as a list of (filling, how many sequences).

Plan (bin completion, branch and bound): the largest open length starts a sequence,
a filling completes it and is used a number of times, and so on for what is left. The
incumbent is a best-fit decreasing packing of the whole histogram. A branch is
left when its waste exceeds what a packing with one sequence less could hold, when its
sequences and the pieces over half the capacity reach the incumbent, or when the same
pieces were open before with as few sequences; ``lower_bound`` ends the search. The first dive
takes the least-waste filling of every sequence (SEARCH_NODES nodes each; without a
proof of least waste beyond), as often as the histogram allows; later dives depart from earlier
ones by one other filling or number of times, those near the start first. Branches are the
undominated fillings: no open piece fits beside them, nor in the place of one or two
smaller pieces of theirs (the first SEARCH_NODES nodes of them).
After PLAN_NODES nodes (a length looked at in a sequence, or a step of the search for
fillings) the incumbent stands, and may then have more sequences than needed; without
either limit met the plan is a best one.

Assignment: pieces are numbered per length. Tasks number their own pieces while
tokenising; offsets of (task, length) follow from the counts of the written table, so
no length is gathered in one task. A number maps to its sequence and place by a
binary search in the plan, which is broadcast (bounded by capacity squared, in
practice a few thousand rows).

Defined cases: null text counts as empty (one end id); repeated rows are packed each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketscope.llm.common import written
from marketscope.llm.pool import RunPool, gather, spans

CAPACITY = 1024
END_ID = 2
SEARCH_NODES = 4_000
PLAN_NODES = 2_000_000
CACHE_WORDS = 300_000
GROUP_CHARS = 3_000_000
JOINED = 20
ODD_SPACE = re.compile(r"\s\s|^\s|\s$")
ASCII_WORD = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
PIECES = "task long, doc_id long, piece int, start long, length int, ids_crc32 long, rank long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of texts, the tokenizer's own, with an end id behind each text.

    The tokenizer's pattern never joins a character to the white space after it, nor a
    letter or digit to a full stop or comma. So where white space stands alone, a
    text is the concatenation of its words, each encoded with the white space before it,
    and of final full stops and commas. Words are cut out of a whole group of texts by
    byte position, made distinct, looked up in a cache and put back by array gather; only
    unknown words meet the tokenizer, several to a call, told apart again by the bytes of
    their tokens. The cache holds at most CACHE_WORDS words; beyond that the half used
    least goes, so frequent words stay. Any other text is encoded as a whole.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True      # their spelling in a text is ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)     # of each token; one letter a byte
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.end = np.array([end_id], dtype=np.uint32)
        self.pool = RunPool(CACHE_WORDS, self.learn)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def unknown(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that begin with white space, one after the other, and how many each has; JOINED words to a call."""
        joined = [b"".join(words[i:i + JOINED]).decode() for i in range(0, len(words), JOINED)]
        ids = _concatenated(self.whole(joined))
        ends, at = np.cumsum([len(w) for w in words], dtype=np.int64), np.cumsum(self.bytes[ids])
        cuts = np.searchsorted(at, ends)
        if not len(words) or len(at) and cuts[-1] < len(at) and (at[cuts] == ends).all():
            return ids, np.diff(cuts, prepend=-1)
        return self.apart(words)                         # tokens that do not spell bytes, or that span words

    def apart(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.whole([w.decode() for w in words])
        return _concatenated(found), np.array([len(x) for x in found], dtype=np.int64)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and marks, in a row, and how many each has."""
        spaced = np.array([w[0] in (32, 10) for w in words], dtype=bool)     # others: a text's first word, or a mark
        (some, some_sizes), (rest, rest_sizes) = (self.unknown([w for w, x in zip(words, spaced) if x]),
                                                  self.apart([w for w, x in zip(words, spaced) if not x]))
        sizes = np.concatenate((some_sizes, rest_sizes))
        order = np.argsort(np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced))))
        return np.concatenate((some, rest))[gather(sizes, order)[0]], sizes[order]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text and the end id."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [t for t in texts if t and not ODD_SPACE.search(t)]
        ids, ends = self._plain(plain)
        at, start = 0, 0
        for text in texts:
            if at < len(plain) and text is plain[at]:
                yield ids[start:ends[at]]
                start, at = ends[at], at + 1
            else:
                yield np.concatenate((*self.whole([text]), self.end))

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without odd white space one after the other, and where each ends."""
        raw = [t.encode() for t in texts]
        if not raw:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        data = b"".join(raw)
        a = np.frombuffer(data, dtype=np.uint8)
        stops = np.cumsum([len(r) for r in raw])
        first = np.zeros(len(a) + 1, dtype=bool)         # whether a word begins at a byte
        first[:-1] = (a == 32) | (a == 10)
        first[stops] = first[0] = True
        mark = np.flatnonzero((a == 46) | (a == 44))
        mark = mark[(mark > 0) & first[mark + 1]]
        first[mark[ASCII_WORD[a[mark - 1]]]] = True
        bounds = np.flatnonzero(first)
        numbers = self.pool.numbers(spans(data, bounds))
        # an end id behind each text
        at_stop = np.searchsorted(bounds, stops)
        place, ends = gather(np.append(self.pool.sizes, 1), np.insert(numbers, at_stop, len(self.pool.sizes)))
        ids = np.concatenate((self.pool.runs, self.end))[place]
        self.pool.forget()
        return ids, ends[at_stop + np.arange(len(raw))]


def _concatenated(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


@lru_cache(maxsize=2)
def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder per Python worker, kept from task to task."""
    return Encoder(path, end_id)


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones, behind a shorter first one."""
    if n <= capacity:
        return [n]
    short = n % capacity
    return [short] * (short > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with its number among the pieces of its length in its task."""
    names = ["task", "doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder, seen = encoder_of(tokenizer, end_id), defaultdict(int)
        for batch in batches:
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                at = 0
                for no, n in enumerate(cut_lengths(len(ids), capacity)):
                    out.append((task, doc, no, at, n, zlib.crc32(ids[at:at + n].astype("<u4", copy=False)), seen[n]))
                    seen[n] += 1
                    at += n
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(rows, PIECES)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: total length, or for each k the pieces over half and those from k on that fit beside none."""
    total = sum(n * c for n, c in counts.items())
    best, lengths = -(-total // capacity), sorted(n for n, c in counts.items() if c)
    large = [n for n in lengths if 2 * n > capacity]
    over, small = sum(counts[n] for n in large), 0
    rooms, at = 0, 0                                 # room beside the pieces over half that a piece of length k fits in
    for k in reversed([0] + [n for n in lengths if 2 * n <= capacity]):
        small += k * counts[k] if k else 0
        while at < len(large) and large[at] <= capacity - k:
            rooms += (capacity - large[at]) * counts[large[at]]
            at += 1
        best = max(best, over + max(0, -(-(small - rooms) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing packing of the whole histogram, as ``plan`` returns it."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)     # by room left
    for n in sorted((n for n, c in counts.items() if c), reverse=True):
        c = counts[n]
        while c:
            room = min((r for r in groups if r >= n and groups[r]), default=capacity)
            k = min(c, room // n)
            filling, bins = groups[room].pop() if groups[room] else ({}, c // k)
            m = min(bins, c // k)
            if bins > m and filling:
                groups[room].append((filling, bins - m))
            groups[room - n * k].append((filling | {n: k}, m))
            c -= m * k
    return [g for gs in groups.values() for g in gs]


def best_fit_filling(room: int, lengths: list[int], counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, times): the largest that fits, again and again."""
    out = []
    for n in reversed(lengths):
        k = min(counts[n], room // n)
        if k:
            out.append((n, k))
            room -= n * k
    return out


def complete(room: int, lengths: list[int], counts: dict[int, int], nodes: int = SEARCH_NODES) -> list[tuple[int, int]]:
    """Filling of ``room`` with least waste found by bin completion; ``lengths`` ascends, ``counts`` are the open pieces.

    Fillings are built in descending length, a dominated one (some piece could be
    exchanged for a larger open one that still fits) is never better than the
    one that dominates it, so only the largest lengths that fit are branched on first.
    """
    best = best_fit_filling(room, lengths, counts)
    best_waste = room - sum(n * k for n, k in best)
    prefix = [0]                                     # total of the open pieces up to each length
    for n in lengths:
        prefix.append(prefix[-1] + n * counts[n])
    budget = nodes

    def search(left: int, top: int, filled: list[tuple[int, int]]) -> bool:
        nonlocal best, best_waste, budget
        budget -= 1
        if left < best_waste:
            best, best_waste = list(filled), left
            if not left:
                return True
        top = min(top, bisect_right(lengths, left))
        for i in range(top - 1, -1, -1):
            n = lengths[i]
            # waste bound: even all open pieces up to n leave more waste than the incumbent
            if left - prefix[i + 1] >= best_waste or budget <= 0:
                return False
            for k in range(min(counts[n], left // n), 0, -1):
                filled.append((n, k))
                if search(left - n * k, i, filled):
                    return True
                filled.pop()
        return False

    if best_waste:
        search(room, len(lengths), [])
    return best


def dominated(filled: list[tuple[int, int]], left: int, lengths: list[int], counts: dict[int, int]) -> bool:
    """Whether one open piece could take the place of one or two smaller pieces of the filling.

    A packing with such a filling is no better than the one in which the larger piece stands here and the
    smaller ones stand in the larger one's place, so it need not be branched on.
    """
    used = dict(filled)
    spare = [n for n in lengths if counts[n] > used.get(n, 0)]

    def fits(least: int, most: int) -> bool:
        at = bisect_right(spare, least - 1)
        return at < len(spare) and spare[at] <= most

    own = sorted(used)
    return (any(fits(y + 1, y + left) for y in own)
            or any(fits(y + z, y + z + left) for i, y in enumerate(own) for z in own[i:] if y != z or used[y] > 1))


def fillings(room: int, lengths: list[int], counts: dict[int, int], most: int, nodes: int = SEARCH_NODES) -> tuple[list[tuple], int]:
    """(undominated fillings of ``room`` that leave at most ``most``, least waste first; search nodes used).

    No open piece fits beside such a filling, nor in the place of one or two of its pieces.
    """
    out, budget = [], nodes

    def search(left: int, top: int, filled: list[tuple[int, int]], passed: int) -> None:
        nonlocal budget
        budget -= 1
        top = min(top, bisect_right(lengths, left))
        if left <= most and left < passed and not dominated(filled, left, lengths, counts):
            out.append((left, tuple(filled)))
        for i in range(top - 1, -1, -1):
            n = lengths[i]
            if budget <= 0:
                return
            fit = min(counts[n], left // n)
            for k in range(fit, 0, -1):
                # an open piece left out on the way must not fit in the end
                search(left - n * k, i, filled + [(n, k)], min(passed, n) if k < counts[n] else passed)
            passed = min(passed, n)

    search(room, len(lengths), [], room + 1)
    out.sort(key=lambda f: f[0])
    return [f for _, f in out], nodes - budget


def shares(most: int) -> Iterator[int]:
    """most, its halves, then every other number of times."""
    halves, t = [], most
    while t:
        halves.append(t)
        t //= 2
    yield from halves
    yield from (t for t in range(most - 1, 0, -1) if t not in halves)


class Search:
    """Branch and bound over the fillings of successive sequences; see the module docstring."""

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int):
        self.counts, self.capacity, self.nodes = {n: c for n, c in counts.items() if c}, capacity, nodes
        self.total = sum(n * c for n, c in self.counts.items())
        self.bound = lower_bound(self.counts, capacity)
        self.best = best_fit(self.counts, capacity)
        self.size = sum(t for _, t in self.best)
        self.seen: dict[tuple, int] = {}

    def slack(self) -> int:
        """Waste a packing with fewer sequences than the incumbent has at most."""
        return (self.size - 1) * self.capacity - self.total

    def run(self) -> list[tuple[dict[int, int], int]]:
        level, first = [None], True
        while level and self.size > self.bound:
            following = []
            for node in level:
                for step in [None] if first else self.alternatives(node):
                    self.dive(node, step, following)
                    if self.size <= self.bound or self.nodes <= 0:
                        return self.best
            level, first = following, False
        return self.best

    def state(self, node: tuple | None) -> tuple[dict[int, int], list, int, int]:
        """Open pieces, steps, sequences and waste behind a node, which links (node before, filling, times)."""
        open_, steps, used, waste = dict(self.counts), [], 0, 0
        while node:
            node, filling, times = node
            steps.append((filling, times))
            waste += self.apply(open_, filling, times)
            used += times
        return open_, steps[::-1], used, waste

    def apply(self, open_: dict[int, int], filling: dict[int, int], times: int) -> int:
        """Take the pieces of ``times`` sequences from the open ones; returns the waste."""
        for n, k in filling.items():
            open_[n] -= k * times
            if not open_[n]:
                del open_[n]
        return (self.capacity - sum(n * k for n, k in filling.items())) * times

    def rest(self, open_: dict[int, int]) -> tuple[int, int, list[int]]:
        """Largest open length, the room beside it and the lengths that fit there; takes one such piece out."""
        lengths = sorted(open_)
        top = lengths[-1]
        open_[top] -= 1
        if not open_[top]:
            lengths.pop()
        return top, self.capacity - top, lengths[:bisect_right(lengths, self.capacity - top)]

    def greedy(self, open_: dict[int, int]) -> tuple[dict[int, int], int]:
        """The least-waste completion of the largest open length, as often as it can be used."""
        top, room, fit = self.rest(open_)
        filling = complete(room, fit, open_) if fit else []
        open_[top] += 1
        return self.step(open_, top, filling)

    def step(self, open_: dict[int, int], top: int, filling: Iterable[tuple[int, int]]) -> tuple[dict[int, int], int]:
        used: dict[int, int] = defaultdict(int, {top: 1})
        for n, k in filling:
            used[n] += k
        return dict(used), min(open_[n] // k for n, k in used.items())

    def alternatives(self, node: tuple | None) -> Iterator[tuple[dict[int, int], int]]:
        """Every other step from a node whose waste the incumbent's successor could hold."""
        open_, _, _, waste = self.state(node)
        taken = self.greedy(open_)
        top, room, fit = self.rest(open_)
        others, cost = fillings(room, fit, open_, self.slack() - waste)
        open_[top] += 1
        self.nodes -= cost
        steps = [self.step(open_, top, f) for f in others]
        # whole uses of every filling first, then the parts of them
        lazy = [(f, shares(t)) for f, t in steps]
        while lazy:
            left = []
            for f, times in lazy:
                t = next(times, None)
                if t is not None:
                    left.append((f, times))
                    if (f, t) != taken and waste + t * (self.capacity - sum(n * k for n, k in f.items())) <= self.slack():
                        yield f, t
            lazy = left

    def dive(self, node: tuple | None, step: tuple | None, following: list) -> None:
        """Complete sequences greedily behind ``step``; leaves when no packing smaller than the incumbent can come of it."""
        open_, steps, used, waste = self.state(node)
        first = self.size if node is None and step is None else 0       # the first dive is never cut by the node limit
        while True:
            if step is not None:
                steps.append(step)
                node = (node, *step)
                waste += self.apply(open_, *step)
                used += step[1]
            if waste > self.slack() or used + sum(c for n, c in open_.items() if 2 * n > self.capacity) >= self.size:
                return
            if not open_:
                self.best, self.size = steps, used
                return
            if self.nodes <= 0 and not first:
                return
            key = hash(frozenset(open_.items()))
            if self.seen.get(key, self.size) <= used:
                return
            self.seen[key] = used
            following.append(node)
            self.nodes -= 1 + len(open_)
            step = self.greedy(open_)


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = PLAN_NODES) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a sequence, number of such sequences), using up ``counts``."""
    return Search(counts, capacity, nodes).run()


def slots(steps: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first number, pieces per sequence, first sequence, offset in the sequence), by first number."""
    out, used, sequence = defaultdict(list), defaultdict(int), 0
    for filling, times in steps:
        at = 0
        for n in sorted(filling, reverse=True):
            out[n].append((used[n], filling[n], sequence, at))
            used[n] += filling[n] * times
            at += n * filling[n]
        sequence += times
    return {n: np.array(v, dtype=np.int64) for n, v in out.items()}


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    table = written(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "pieces")
    counted = written(table.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}     # at most capacity rows
    places = slots(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counted.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = table.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("rank") + F.col("before")).alias("number"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                rows = places[n]
                step = rows[np.searchsorted(rows[:, 0], number[mine], side="right") - 1]
                k = number[mine] - step[:, 0]
                sequence[mine] = step[:, 2] + k // step[:, 1]
                offset[mine] = step[:, 3] + k % step[:, 1] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(assign, schema)
