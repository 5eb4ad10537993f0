"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash of the vocabulary finds the id of a whole
pre-token that is a token itself.  Its table has exactly one slot a token, and
the bytes kept there tell a token from any other key.  Tier two: other
pre-tokens start as linked single bytes; a heap holds the rank of every pair of
neighbours, and the least rank (the leftmost of equals) is merged until no pair
is a token, in O(n log n) of the pre-token's bytes.

The hash is built once on the driver and broadcast: its size is that of the
vocabulary, whatever the data.  Texts are cut and looked up in runs of a
bounded number of pre-tokens, each distinct one once; nothing is shuffled.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posturn.llm.flat import Runs, coded, offsets

RANKS = "byte_bpe_50k.tiktoken"
#: Pre-tokens that are looked up together, at most.
RUN_PIECES = 200_000
#: Texts above so many characters are cut lazily, run by run.
LONG_TEXT = 1_000_000
#: Pre-tokens outside the vocabulary whose ids a worker keeps; further ones are merged again in each run.
KEPT_PIECES = 250_000

_U64 = (1 << 64) - 1
#: Multipliers that spread a hash once more, for each displacement another way.
_STEP, _SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Displacements that are tried together.
_TRIES = 256
_KEYS_PER_BUCKET = 4


def vocabulary_path(name: str) -> str:
    """The path of a public vocabulary file (a bare name), or the given path."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_ranks(name: str = RANKS) -> dict[bytes, int]:
    """Token bytes and their ranks (ids) from a file of base64 tokens and numbers."""
    with open(vocabulary_path(name), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PerfectHash:
    """A minimal perfect hash of ``keys``: distinct byte strings to distinct slots below their number.

    Keys fall into buckets by their hash.  Buckets, the fullest first, take
    the first displacement that sends all their keys to free slots; a lone key
    takes any free slot, kept as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        n = self.size = len(keys)
        self.buckets = max(1, n // _KEYS_PER_BUCKET)
        h = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, n)
        if len(np.unique(h)) < n:
            raise ValueError("two keys are equal or have the same 64-bit hash")
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        starts = np.cumsum(counts) - counts
        shift = np.zeros(self.buckets, np.int64)
        slot = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        by_size = np.argsort(-counts, kind="stable")
        for b in by_size[:np.count_nonzero(counts > 1)]:
            members = order[starts[b]:starts[b] + counts[b]]
            for first in itertools.count(0, _TRIES):
                tried = self._slots(h[members][None, :], np.arange(first, first + _TRIES)[:, None])
                ranked = np.sort(tried, axis=1)
                fits = free[tried].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    shift[b], slot[members] = first + k, tried[k]
                    free[tried[k]] = False
                    break
        lone = by_size[np.count_nonzero(counts > 1):np.count_nonzero(counts)]
        left = np.flatnonzero(free)
        shift[lone] = -left - 1
        slot[order[starts[lone]]] = left
        self.shifts = shift.tolist()
        self.keys: list[bytes] = [b""] * n
        for s, key in zip(slot.tolist(), keys):
            self.keys[s] = key
        self.slots = slot

    def _slots(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        mixed = (h ^ (shift.astype(np.uint64) * np.uint64(_STEP))) * np.uint64(_SPREAD)
        return ((mixed >> np.uint64(32)) % np.uint64(self.size)).astype(np.int64)

    def find(self, key: bytes) -> int:
        """The key's slot; -1 for any other key."""
        h = xxhash.xxh64_intdigest(key)
        shift = self.shifts[h % self.buckets]
        slot = -shift - 1 if shift < 0 else ((((h ^ (shift * _STEP & _U64)) * _SPREAD & _U64) >> 32) % self.size)
        return slot if self.keys[slot] == key else -1


class ByteBpe:
    """Encoder and decoder of a vocabulary of byte strings by rank.

    Every single byte must be a token, so that every text can be encoded.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        if min(ranks.values()) < 0 or len(set(ranks.values())) < len(ranks):
            raise ValueError("ranks must be distinct and not negative")
        tokens = list(ranks)
        self.hash = PerfectHash(tokens)
        by_slot = np.empty(len(tokens), np.int64)
        by_slot[self.hash.slots] = [ranks[t] for t in tokens]
        self.ranks = by_slot.tolist()
        self.pattern = pattern
        self._regex = self._bytes = self._pairs = None
        self._kept: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_regex": None, "_bytes": None, "_pairs": None, "_kept": {}}

    def rank(self, key: bytes) -> int:
        """The rank of ``key``; -1 if it is no token."""
        slot = self.hash.find(key)
        return self.ranks[slot] if slot >= 0 else -1

    def pieces(self, text: str) -> Iterator[str]:
        """The pre-tokens of ``text``, in order."""
        if self._regex is None:
            import regex

            self._regex = regex.compile(self.pattern)
        if len(text) <= LONG_TEXT:
            return iter(self._regex.findall(text))
        return (m.group() for m in self._regex.finditer(text))

    def ids(self, piece: str) -> Sequence[int]:
        """The ids of one pre-token."""
        ids = self._kept.get(piece)
        if ids is None:
            key = piece.encode()
            whole = self.rank(key)
            if whole >= 0:
                return (whole,)
            ids = tuple(self.merged(key))
            if len(self._kept) < KEPT_PIECES:
                self._kept[piece] = ids
        return ids

    def merged(self, piece: bytes) -> list[int]:
        """Ids by merging linked bytes, the pair of least rank first."""
        if self._pairs is None:  # ranks of merged pairs, by their bytes
            self._pairs = dict(zip(self.hash.keys, self.ranks))
        n, rank = len(piece), self._pairs.get
        after = list(range(1, n + 1))       # where the part that starts here ends
        before = list(range(-1, n - 1))     # where the part before it starts
        pair = [rank(piece[i:i + 2], -1) for i in range(n)]
        pair[-1] = -1
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = divmod(pop(heap), n)
            if pair[i] != r:
                continue  # the parts have changed since
            j = after[i]
            after[i] = end = after[j]
            pair[j] = pair[i] = -1
            if end < n:
                before[end] = i
                r = rank(piece[i:after[end]])
                if r is not None:
                    pair[i] = r
                    push(heap, r * n + i)
            k = before[i]
            if k >= 0:
                r = rank(piece[k:end])
                if r is None:
                    pair[k] = -1
                else:
                    pair[k] = r
                    push(heap, r * n + k)
        out, i = [], 0
        while i < n:
            end = after[i]
            out.append(rank(piece[i:end]))
            i = end
        return out

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and where each piece's end."""
        codes, distinct = coded(pieces)
        return Runs.of([self.ids(p) for p in distinct]).joined(codes)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids end to end, and where each id's end; an id outside the vocabulary raises."""
        if self._bytes is None:
            ranks = np.array(self.ranks)
            table: list[bytes] = [b""] * (int(ranks.max()) + 1)
            for r, key in zip(self.ranks, self.hash.keys):
                table[r] = key
            self._known = np.zeros(len(table), bool)
            self._known[ranks] = True
            self._bytes = Runs.of_bytes(table)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._known) or not self._known[ids].all()):
            raise ValueError("an id is outside the vocabulary")
        return self._bytes.joined(ids)


def _runs(bpe: ByteBpe, texts: Iterable[str]) -> Iterator[tuple[list[str], list[int], bool]]:
    """Pre-tokens of consecutive texts in bounded runs: pieces, pieces per text, and whether the last text is done."""
    pieces: list[str] = []
    counts: list[int] = []
    for text in texts:
        cut, begun = bpe.pieces(text), 0
        while part := list(itertools.islice(cut, RUN_PIECES - len(pieces))):
            pieces += part
            begun += len(part)
            if len(pieces) >= RUN_PIECES:
                yield pieces, [*counts, begun], False
                pieces, counts, begun = [], [], 0
        counts.append(begun)
    yield pieces, counts, True


def _encoded(bpe: ByteBpe, texts: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first, ids)``: ids of the texts from number ``first`` on, whole texts only."""
    first, open_parts = 0, []
    for pieces, counts, done in _runs(bpe, texts):
        ids, ends = bpe.encode(pieces)
        bounds = offsets(ends)[offsets(np.cumsum(counts, dtype=np.int64))]
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        if parts and open_parts:
            parts[0] = np.concatenate([*open_parts, parts[0]]) if len(parts) > 1 or done else parts[0]
            if len(parts) > 1 or done:
                open_parts = []
        if not done:
            open_parts.append(parts.pop())
        yield first, parts
        first += len(parts)


def _listed(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))


def _decoded(bpe: ByteBpe, parts: list[np.ndarray]) -> pa.Array:
    whole, ends = bpe.decode(np.concatenate([np.empty(0, np.int32), *parts]))
    bounds = offsets(ends)[np.cumsum([0, *map(len, parts)])]
    return pa.array([whole[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())


def byte_bpe(ranks: str = RANKS, pattern: str | None = None) -> ByteBpe:
    """The codec of a file of ranks; ``pattern`` cuts texts into pre-tokens (unset: the public vocabularies')."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return ByteBpe(load_ranks(ranks), pattern)


def encode(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(doc_id, ids)`` of every row, with ``decoded`` also the bytes that the ids stand for.

    Without special tokens: their strings are ordinary text.  A null or empty
    text has no ids.  Null and repeated ids are kept, one row each; other
    columns are ignored, whatever their names.  A text of any length is cut and
    encoded run by run; its ids are one row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bpe)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, parts in _encoded(codec, texts):
                columns = [batch.column(0).slice(first, len(parts)), _listed(parts)]
                if decoded:
                    columns.append(_decoded(codec, parts))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))


def decode(rows: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, decoded)``: the bytes of every row's ids; null ids count as none.

    Bytes, not text: ids cut anywhere need not end at a character.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bpe)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            parts = [np.array(ids or [], np.int32) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _decoded(codec, parts)], ["doc_id", "decoded"])

    return rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"doc_id {kind}, decoded binary")
