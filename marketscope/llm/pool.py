"""Runs of 32-bit numbers by byte string: what a token becomes, for whole batches of tokens at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def spans(data: bytes, bounds: np.ndarray) -> pa.Array:
    """The byte strings between neighbouring ``bounds``, without copying ``data``."""
    return pa.Array.from_buffers(pa.binary(), max(len(bounds) - 1, 0), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def gather(sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, in a pool of runs of ``sizes``, of the chosen runs one after the other, and where each ends."""
    n = sizes[chosen]
    ends = np.cumsum(n)
    starts = np.cumsum(sizes) - sizes
    return np.arange(int(n.sum())) + np.repeat(starts[chosen] - (ends - n), n), ends


class RunPool:
    """A bounded cache from byte strings to runs of numbers.

    Strings are looked up by the batch and learned by the batch; beyond ``limit`` strings
    the half used least is forgotten, so frequent ones stay.
    """

    def __init__(self, limit: int, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.limit, self.learn = limit, learn            # learn: strings -> (their runs in a row, the size of each)
        self.words = pa.array([], pa.binary())
        self.uses = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.runs = np.zeros(0, dtype=np.uint32)

    def numbers(self, tokens: pa.Array) -> np.ndarray:
        """The number of each token's run, as of now (``forget`` renumbers)."""
        coded = tokens.dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        if len(self.words):
            known = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy().astype(np.int64)
        else:
            known = np.full(len(distinct), -1, dtype=np.int64)
        fresh = np.flatnonzero(known < 0)
        strange = distinct.take(pa.array(fresh))
        runs, sizes = self.learn(strange.to_pylist())
        known[fresh] = len(self.words) + np.arange(len(fresh))
        self.words = pa.concat_arrays([self.words, strange])
        self.sizes, self.runs = np.concatenate((self.sizes, sizes)), np.concatenate((self.runs, runs))
        self.uses = np.concatenate((self.uses, np.zeros(len(fresh), dtype=np.int64)))
        self.uses[known] += np.bincount(codes, minlength=len(distinct))
        return known[codes]

    def forget(self) -> None:
        if len(self.words) > self.limit:
            keep = np.sort(np.argsort(-self.uses, kind="stable")[:self.limit // 2])
            self.runs = self.runs[gather(self.sizes, keep)[0]]
            self.words, self.uses, self.sizes = self.words.take(pa.array(keep)), self.uses[keep] >> 1, self.sizes[keep]
