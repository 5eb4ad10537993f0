"""Arrays of many runs laid end to end, for work on whole batches of texts at once."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np


class Codes(dict):
    """Numbers distinct keys in the order they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


def coded(keys: Sequence) -> tuple[np.ndarray, list]:
    """The code of every key, and the distinct keys by code."""
    codes = Codes()
    return np.fromiter(map(codes.__getitem__, keys), np.int64, len(keys)), list(codes)


def ends_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths, dtype=np.int64)


class Runs:
    """Runs of values by number: ``values[starts[k]:starts[k] + lengths[k]]``."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = ends_of(lengths) - lengths

    @classmethod
    def of(cls, runs: Sequence[Sequence[int]], dtype=np.int32) -> Runs:
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        return cls(np.fromiter(itertools.chain.from_iterable(runs), dtype, int(lengths.sum())), lengths)

    @classmethod
    def of_bytes(cls, texts: Sequence[bytes]) -> Runs:
        return cls(np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts)))

    def with_more(self, more: Runs) -> Runs:
        return Runs(np.concatenate([self.values, more.values]), np.concatenate([self.lengths, more.lengths]))

    def joined(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of ``codes`` end to end, and where each ends."""
        lengths = self.lengths[codes]
        ends = ends_of(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[codes] - (ends - lengths), lengths)
        return self.values[at], ends


def offsets(ends: np.ndarray, counted: np.ndarray | None = None) -> np.ndarray:
    """Arrow list offsets: 0, then the end of each list (or ``counted`` elements up to there)."""
    out = np.zeros(len(ends) + 1, np.int64)
    out[1:] = ends if counted is None else counted[ends]
    return out
