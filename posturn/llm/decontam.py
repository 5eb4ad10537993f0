"""Benchmark decontamination by latent semantic retrieval.

Passages are pairs of neighbouring blocks of ``BLOCK_WORDS`` words, so any
passage of that length lies whole in one.  They are TF-IDF vectors over the
benchmark's words.  A randomised SVD (Gaussian range finder, then the small
Gram matrix) of the passages and, with the same total weight, the benchmark
items gives a latent space.  Passages whose latent vector has a cosine of
``MIN_COSINE`` or more with an item's are candidates.  They are checked on the
whole word sequence around the passage: the longest common subsequence must
cover ``MIN_COPY`` of the item, or ``MIN_LCS`` of it and ``MIN_ANSWER`` of its
answer (last sentence).

Document frequencies, latent axes, search and checks cover every word of every
document.  The benchmark is read in blocks of ``ITEM_BLOCK`` items, each
against all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posturn.llm.common import written

BLOCK_WORDS = 32
RANK = 96
#: Blocks that a task fits the axes on, about, and the tasks there may be at least; each gives a matrix of words by axes.
FIT_BLOCKS = 200_000
FIT_TASKS = 24
ITEM_BLOCK = 200
#: Distinct words of a block of items: their ids take 16 bits.  Only a single item with more takes 32.
MAX_WORDS = 0xFFFE
MIN_COSINE, MIN_LCS, MIN_ANSWER = 0.5, 0.6, 0.5
#: So much of an item is a leak with or without its last sentence.
MIN_COPY = 0.8
#: Words in more than this share of blocks carry no weight (they still count in the subsequences).
MAX_SHARE = 0.05
SEED = 11
_CHUNK_TOKENS = 100_000

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_of(text: str) -> list[str]:
    """Words of the last sentence; of a single sentence its last third."""
    parts = [w for w in map(words_of, re.split(r"[.?!\n]+", text)) if w]
    if len(parts) > 1:
        return parts[-1]
    return parts[0][-max(1, len(parts[0]) // 3):] if parts else []


def lcs_length(masks: dict[int, int], size: int, sequence) -> int:
    """Longest common subsequence of a pattern (bit masks of its words' places) and a sequence of word ids."""
    full = (1 << size) - 1
    state = full
    for word in sequence:
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for place, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << place
    return out


def _run_sums(table: np.ndarray, index: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of ``table[index]`` over the runs that begin at ``start``: all runs of one length at once."""
    size = np.diff(np.r_[start, len(index)])
    out = np.empty((len(start), table.shape[1]), table.dtype)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        out[at] = table[index[start[at, None] + np.arange(n)]].sum(axis=1)
    return out


def _block_sums(table: np.ndarray, index: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``_run_sums`` of runs of up to ``BLOCK_WORDS``, to the bit as ``np.add.reduceat`` adds them (eight side by side)."""
    size = np.diff(np.r_[start, len(index)])
    out = np.empty((len(start), table.shape[1]), table.dtype)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        first = start[at]
        whole = (n - 1) // 8 * 8
        rest = None
        if whole:
            lane = [table[index[first + k]] for k in range(1, 9)]
            for k in range(9, whole + 1):
                lane[(k - 1) % 8] += table[index[first + k]]
            rest = ((lane[0] + lane[1]) + (lane[2] + lane[3])) + ((lane[4] + lane[5]) + (lane[6] + lane[7]))
        for k in range(whole + 1, n):
            rest = table[index[first + k]] if rest is None else rest + table[index[first + k]]
        out[at] = table[index[first]] if rest is None else table[index[first]] + rest
    return out


class _Blocks:
    """Weighted tokens of some documents' blocks; block ids are contiguous and a document's blocks follow each other."""

    def __init__(self, streams: list[np.ndarray], weight: np.ndarray):
        counts = np.array([max(1, -(-len(s) // BLOCK_WORDS)) for s in streams])
        self.first = np.r_[0, np.cumsum(counts)]
        place = np.concatenate([np.arange(len(s)) // BLOCK_WORDS for s in streams])
        self.n = int(self.first[-1])
        block = place + np.repeat(self.first[:-1], [len(s) for s in streams])
        word = np.concatenate(streams).astype(np.int64) - 1
        held = (word >= 0) & (weight[word] > 0)
        self.block, self.word = block[held], word[held]
        doc = np.repeat(np.arange(len(streams)), counts)
        self.paired = np.flatnonzero(np.r_[doc[1:] == doc[:-1], False])  # blocks whose next block is of the same document
        self.weight = weight

    def project(self, axes: np.ndarray) -> np.ndarray:
        """Sum of the words' weighted rows of ``axes`` over each block."""
        out = np.zeros((self.n, axes.shape[1]), np.float32)
        if len(self.word):
            start = np.flatnonzero(np.r_[True, np.diff(self.block) != 0])
            out[self.block[start]] = _block_sums(axes, self.word, start)
        return out

    def passages(self, blocks: np.ndarray) -> np.ndarray:
        out = blocks.copy()
        out[self.paired] += blocks[self.paired + 1]
        return out

    def norms(self, n_words: int) -> np.ndarray:
        """Lengths of the passages' TF-IDF vectors."""
        block = np.concatenate([self.block, self.block - 1])
        word = np.concatenate([self.word, self.word])
        before = np.zeros(self.n + 1, bool)
        before[self.paired] = True
        ok = np.r_[np.ones(len(self.block), bool), before[self.block - 1]]
        key, count = np.unique(block[ok] * n_words + word[ok], return_counts=True)
        square = np.bincount(key // n_words, (count * self.weight[key % n_words]) ** 2, minlength=self.n)
        return np.sqrt(square) + 1e-9

    def back(self, rows: np.ndarray, n_words: int) -> np.ndarray:
        """Transposed product: for each word the weighted sum of its passages' rows."""
        per_block = rows.copy()
        per_block[self.paired + 1] += rows[self.paired]
        order = np.argsort(self.word, kind="stable")
        word = self.word[order]
        out = np.zeros((n_words, rows.shape[1]))
        if len(word):
            start = np.flatnonzero(np.r_[True, np.diff(word) != 0])
            sums = _run_sums(per_block, self.block[order], start)
            out[word[start]] = sums * self.weight[word[start], None]
        return out


def _id_type(n_words: int) -> str:
    """Word ids are 1 to ``n_words`` and zero."""
    return "<u2" if n_words <= MAX_WORDS else "<u4"


def _chunks(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[tuple[pa.RecordBatch, int, list[np.ndarray]]]:
    """Documents' id streams, about ``_CHUNK_TOKENS`` at a time: ``(batch, first row, streams)``."""
    for batch in batches:
        held, first, size = [], 0, 0
        for row, data in enumerate(batch.column(1).to_pylist()):
            held.append(np.frombuffer(data, _id_type(n_words)))
            size += len(held[-1])
            if size >= _CHUNK_TOKENS:
                yield batch, first, held
                held, first, size = [], row + 1, 0
        if held:
            yield batch, first, held


def _streams(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, ids)``: each whole text's word ids plus one, unsigned, zero for other words."""
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = _id_type(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array([vocabulary.get(w, 0) for w in words_of(t)], id_type).tobytes()
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary")


def _frequencies(streams: DataFrame, n_words: int) -> tuple[np.ndarray, int]:
    """Blocks that hold each word, and all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_words + 1, np.int64)  # the last place counts the blocks
        every = np.ones(n_words)
        for _, _, part in _chunks(batches, n_words):
            blocks = _Blocks(part, every)
            held[:-1] += np.bincount(np.unique(blocks.block * n_words + blocks.word) % n_words, minlength=n_words)
            held[-1] += blocks.n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_words + 1)), pa.array(held)], ["word", "n"])

    rows = streams.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n_words + 1, np.int64)
    for r in rows:
        out[r.word] = r.n
    return out[:-1], int(out[-1])


def _summed(df: DataFrame, of_chunk, n_rows: int, rank: int, n_words: int) -> np.ndarray:
    """Sum over all chunks of a small matrix; added up per task, then by key (its size is bounded by the benchmark's words)."""
    names = [f"c{i}" for i in range(rank)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_rows, rank))
        for _, _, part in _chunks(batches, n_words):
            total += of_chunk(part)
        held = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held)] + [pa.array(total[held, i]) for i in range(rank)],
                                         ["row", *names])

    parts = df.mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    out = np.zeros((n_rows, rank))
    for r in parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[r[0]] = r[1:]
    return out


def latent_axes(streams: DataFrame, items: np.ndarray, weight: np.ndarray, n_blocks: int, rank: int) -> np.ndarray:
    """Orthonormal axes (words x rank) of the randomised SVD of unit passages and equally heavy items."""
    n_words = len(weight)
    rank = min(rank, n_words)
    # All blocks, in few tasks: every task gives a matrix of words by axes.
    fitted = streams.coalesce(max(FIT_TASKS, -(-n_blocks // FIT_BLOCKS)))
    heavy = n_blocks / max(1, len(items))
    omega = np.random.default_rng(SEED).standard_normal((n_words, rank)).astype(np.float32)

    def spread(part: list[np.ndarray]) -> np.ndarray:
        blocks = _Blocks(part, weight)
        norm = blocks.norms(n_words)[:, None] ** 2
        return blocks.back(blocks.passages(blocks.project(omega * weight[:, None])) / norm, n_words)

    wide = _summed(fitted, spread, n_words, rank, n_words) + heavy * items.T @ (items @ omega)
    axes = np.linalg.qr(wide)[0].astype(np.float32)

    def gram(part: list[np.ndarray]) -> np.ndarray:
        blocks = _Blocks(part, weight)
        rows = blocks.passages(blocks.project(axes * weight[:, None])) / blocks.norms(n_words)[:, None]
        return rows.T @ rows

    inside = items @ axes
    _, turn = np.linalg.eigh(_summed(fitted, gram, axes.shape[1], axes.shape[1], n_words) + heavy * inside.T @ inside)
    return (axes @ turn[:, ::-1]).astype(np.float32)


_RESULT = "item_id long, cosine double, lcs double, answer double, first_word long, n_words long"


def _search(streams: DataFrame, kind: str, ids: list[int], words: list[list[int]], answers: list[list[int]],
            vectors: np.ndarray, axes: np.ndarray, weight: np.ndarray, exhaustive: bool) -> DataFrame:
    latent = vectors @ axes
    size = np.linalg.norm(latent, axis=1, keepdims=True)
    latent = (latent / np.maximum(size, 1e-9)).astype(np.float32)
    weighted = (axes * weight[:, None]).astype(np.float32)
    masks = [_masks(w) for w in words]
    answer_masks = [_masks(w) for w in answers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first_row, part in _chunks(batches, len(weight)):
            blocks = _Blocks(part, weight)
            rows = blocks.passages(blocks.project(weighted))
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
            cosine = rows @ latent.T
            found = np.argwhere(cosine >= (-2 if exhaustive else MIN_COSINE))
            best: dict[tuple[int, int], tuple] = {}
            doc_of = np.searchsorted(blocks.first, found[:, 0], side="right") - 1
            for (block, item), doc in zip(found.tolist(), doc_of.tolist()):
                n = len(words[item])
                at = (block - int(blocks.first[doc])) * BLOCK_WORDS
                lo, hi = max(0, at - n), min(len(part[doc]), at + 2 * BLOCK_WORDS + n)
                near = part[doc][lo:hi].tolist()
                lcs = lcs_length(masks[item], n, near) / n
                if lcs < MIN_LCS:
                    continue
                answer = lcs_length(answer_masks[item], len(answers[item]), near) / len(answers[item])
                if lcs >= MIN_COPY or answer >= MIN_ANSWER:
                    new = (lcs, answer, float(cosine[block, item]), -lo, hi - lo)
                    best[doc, item] = max(best.get((doc, item), new), new)
            if best:
                docs = pa.array([first_row + d for d, _ in best], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(docs), pa.array([ids[i] for _, i in best], pa.int64()),
                     pa.array([v[2] for v in best.values()]), pa.array([v[0] for v in best.values()]),
                     pa.array([v[1] for v in best.values()]), pa.array([-v[3] for v in best.values()], pa.int64()),
                     pa.array([v[4] for v in best.values()], pa.int64())],
                    ["doc_id", "item_id", "cosine", "lcs", "answer", "first_word", "n_words"])

    return streams.mapInArrow(run, f"doc_id {kind}, {_RESULT}")


def _item_blocks(items: Iterator) -> Iterator[list]:
    """The items in blocks of at most ``ITEM_BLOCK``, and of at most ``MAX_WORDS`` distinct words unless one item has more."""
    block, words = [], set()
    for item in items:
        own = set(words_of(item.text))
        if block and (len(block) == ITEM_BLOCK or len(words | own) > MAX_WORDS):
            yield block
            block, words = [], set()
        block.append(item)
        words |= own
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rank: int = RANK, exhaustive: bool = False) -> DataFrame:
    """``(doc_id, item_id, cosine, lcs, answer, first_word, n_words)`` of every leaked item.

    One row per document row and item, for the passage with the longest common
    subsequence; ``first_word`` and ``n_words`` give the words it was found in.
    Words are runs of letters, digits and underscores, lower-cased.  Null and
    wordless texts leak nothing; benchmark items that are null, wordless or
    without id are skipped, and items that repeat an id are searched each.
    Repeated documents are reported repeatedly; other columns are ignored.
    ``exhaustive`` checks all passages against all items, to measure recall.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    items = (r for r in benchmark.where("item_id is not null and text is not null")
             .select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator() if words_of(r.text))
    out = spark.createDataFrame([], f"doc_id {kind}, {_RESULT}")
    for block in _item_blocks(items):
        vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for r in block for w in words_of(r.text)}))}
        words = [[vocabulary[w] for w in words_of(r.text)] for r in block]
        answers = [[vocabulary[w] for w in answer_of(r.text)] for r in block]
        streams = written(_streams(docs, vocabulary, id_col, text_col), "word-ids")
        held, n_blocks = _frequencies(streams, len(vocabulary))
        weight = np.where(held <= max(1, MAX_SHARE * n_blocks), np.log((n_blocks + 1) / (held + 1)), 0.0) + 0.0
        # In a table where every word is frequent all words keep a weight.
        if not (weight > 0).any():
            weight = np.ones(len(weight))
        vectors = np.zeros((len(block), len(vocabulary)), np.float32)
        for k, w in enumerate(words):
            np.add.at(vectors[k], np.array(w) - 1, weight[np.array(w) - 1])
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        # An item of frequent words alone: plain counts of its words, so that it can be found at all.
        for k in np.flatnonzero(norm[:, 0] == 0):
            own = np.array(words[k]) - 1
            weight[own] = np.maximum(weight[own], 1e-3)
            np.add.at(vectors[k], own, weight[own])
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        axes = latent_axes(streams, vectors, weight, n_blocks, rank)
        out = out.unionByName(_search(streams, kind, [r.item_id for r in block], words, answers, vectors, axes,
                                      weight, exhaustive))
    return out
