"""Cross-tokenizer alignment by interval coalescing.

A text's tokens of two vocabularies are intervals of the same bytes.  All A
and B tokens of many texts, laid end to end, are sorted by where they start
(numpy's lexsort); ``maximum.accumulate`` gives the furthest end so far.  A group
breaks where a start reaches that maximum: there tokens of both sides end.
Tokens that overlap stay within one group.  Links are the A-B pairs whose
byte ranges end together.

Both vocabularies always cut before a lone space between two other
characters, so texts are cut there and each distinct piece of a run of texts
is tokenized once (the pieces met first, once per worker); the tokens of whole
texts are laid out from their pieces.

How often an id pair is linked corpus-wide is added up by Spark.  The
most frequent pairs, at most ``BROADCAST_PAIRS`` of them, are broadcast to the
documents' links; the others, each of a bounded count, are joined by shuffle.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posturn.llm.byte_bpe import load_ranks, vocabulary_path
from posturn.llm.common import written
from posturn.llm.flat import Codes, Runs, offsets

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: The lone spaces at which both vocabularies cut whatever is around.  U+2581 stands for a space in B.
CUT = "(?<=[^\\s▁]) (?=[^\\s▁])"
#: Characters of the texts that are aligned together; a longer text is aligned alone.
RUN_CHARS = 1_500_000
#: Pieces whose tokens a worker keeps.
KEPT_PIECES = 200_000
#: Id pairs (24 bytes each, about 60 in a hash table) that may be broadcast.
BROADCAST_PAIRS = 400_000


class ByteLevel:
    """The byte-level vocabulary: ids of a space and a text, and the bytes of every id.

    Where the same vocabulary lies beside it as ranks (``.tiktoken``), its
    merges are run from there, which takes a fifth of the time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        shown = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab = self._tokenizer.get_vocab()
        table = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            # An added token that is no byte-level text is never produced.
            table[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else b""
        self.bytes = Runs.of_bytes(table)
        self._ranked = None
        beside = re.sub(r"\.json$", ".tiktoken", path)
        if beside != path and os.path.exists(beside):
            import public_tokenizers
            import tiktoken

            ranks = load_ranks(beside)
            if all(table[k] == token for token, k in ranks.items()):
                self._ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                 special_tokens={})
                self._tokenizer = None

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._ranked is not None:
            return [self._ranked.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self._tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """The sentence-piece vocabulary, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        self.bytes = Runs.of_bytes([bytes([int(n[3:-1], 16)]) if model.is_byte(k) else n.replace("▁", " ").encode()
                                    for k, n in enumerate(names)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


class Tokens:
    """Ids of pieces by both vocabularies, and whether the ids' bytes are the piece's."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.sides = (a, b)
        self._codes = Codes()
        self._runs = [Runs.of([]), Runs.of([])]
        self._good = [np.empty(0, bool), np.empty(0, bool)]

    def of(self, pieces: list[str]) -> tuple[np.ndarray, list[str], list[Runs], list[np.ndarray]]:
        """Codes of ``pieces``, the text of every code, and by code each side's ids and whether they are good."""
        before = len(self._codes)
        codes = np.fromiter(map(self._codes.__getitem__, pieces), np.int64, len(pieces))
        texts = list(self._codes)
        new = texts[before:]
        own = Runs.of_bytes([(" " + p).encode() for p in new])
        runs, good = [], []
        for side, known, fine in zip(self.sides, self._runs, self._good):
            more = Runs.of(side.encode(new))
            runs.append(known.with_more(more))
            good.append(np.concatenate([fine, _same(side.bytes, more, own)]))
        if len(texts) <= KEPT_PIECES:
            self._runs, self._good = runs, good
        else:
            for p in new:
                del self._codes[p]
        return codes, texts, runs, good


def _same(table: Runs, ids: Runs, own: Runs) -> np.ndarray:
    """Whether the bytes of each run of ids are those of its own text."""
    laid, ends = table.joined(ids.values)
    bounds = offsets(ends)[np.append(ids.starts, len(ids.values))]
    good = np.diff(bounds) == own.lengths
    if good.all():
        differ = np.flatnonzero(laid != own.values)
        good[np.searchsorted(bounds[1:], differ, "right")] = False
        return good
    for k in np.flatnonzero(good):
        good[k] = np.array_equal(laid[bounds[k]:bounds[k + 1]], own.values[own.starts[k]:own.starts[k] + own.lengths[k]])
    return good


_LOADED: dict[tuple[str, str], Tokens] = {}


def _tokens(a: str, b: str) -> Tokens:
    """The worker's tokenizers of two files."""
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Tokens(ByteLevel(vocabulary_path(a)), Pieces(vocabulary_path(b)))
    return _LOADED[a, b]


def coalesced(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of two tilings of the same bytes: how many A and B tokens each has, and where it ends."""
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]]) if len(a_ends) else ends
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    furthest = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= furthest[:-1]
    group = np.cumsum(breaks) - 1
    n = int(group[-1]) + 1 if len(group) else 0
    of_b = side[order] == 1
    last = np.append(np.flatnonzero(breaks)[1:], len(order)) - 1
    return np.bincount(group[~of_b], minlength=n), np.bincount(group[of_b], minlength=n), furthest[last] if n else ends


def _whole(codes: np.ndarray, good: np.ndarray, texts: list[str], table: Runs, runs: Runs) -> bool:
    """Whether a text's token bytes are its own, given which of its pieces are."""
    if good[codes].all():
        return True
    ids = runs.joined(codes)[0]
    return table.joined(ids)[0].tobytes() == "".join(" " + texts[k] for k in codes).encode()


def _aligned(texts: list[str | None], tokens: Tokens, cut: re.Pattern | None) -> list[pa.Array]:
    """``n_a, n_b, groups, links`` of some texts."""
    a, b = tokens.sides
    split = [([t] if cut is None else cut.split(t)) if t else [] for t in texts]
    bounds = offsets(np.cumsum([len(s) for s in split], dtype=np.int64))
    codes, pieces, (a_runs, b_runs), (a_good, b_good) = tokens.of(list(itertools.chain.from_iterable(split)))
    kept = np.zeros(len(texts), bool)
    for k, t in enumerate(texts):
        some = codes[bounds[k]:bounds[k + 1]]
        kept[k] = bool(t) and _whole(some, a_good, pieces, a.bytes, a_runs) and _whole(some, b_good, pieces, b.bytes, b_runs)
    taken = np.repeat(kept, np.diff(bounds))
    codes, counts = codes[taken], np.where(kept, np.diff(bounds), 0)
    piece_bounds = offsets(np.cumsum(counts))

    def laid_out(tokenizer, runs):
        ids, piece_ends = runs.joined(codes)
        ends = np.cumsum(tokenizer.bytes.lengths[ids])
        return ids, ends, offsets(piece_ends)[piece_bounds]

    a_ids, a_ends, a_bounds = laid_out(a, a_runs)
    b_ids, b_ends, b_bounds = laid_out(b, b_runs)
    a_sizes, b_sizes, group_ends = coalesced(a_ends, b_ends)
    text_ends = offsets(a_ends)[a_bounds]
    group_bounds = np.searchsorted(group_ends, text_ends, "right")
    lists = [pa.ListArray.from_arrays(pa.array(offsets(np.cumsum(n)), pa.int32()), pa.array(ids, pa.int32()))
             for n, ids in ((a_sizes, a_ids), (b_sizes, b_ids))]
    groups = pa.ListArray.from_arrays(pa.array(group_bounds, pa.int32()), pa.StructArray.from_arrays(lists, ["a", "b"]))

    # Token ends rise strictly, so an end is met at most once a side.
    at = np.searchsorted(b_ends, a_ends)
    met = np.flatnonzero(b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends) if len(b_ends) else np.empty(0, np.int64)
    text = np.searchsorted(text_ends[1:], a_ends[met], "left")
    wide = len(b.bytes.lengths)
    pair = a_ids[met].astype(np.int64) * wide + b_ids[at[met]]
    distinct, n = np.unique(text * (len(a.bytes.lengths) * wide) + pair, return_counts=True)
    text, pair = np.divmod(distinct, len(a.bytes.lengths) * wide)
    links = pa.StructArray.from_arrays([pa.array(pair // wide, pa.int32()), pa.array(pair % wide, pa.int32()),
                                        pa.array(n, pa.int64())], ["a", "b", "n"])
    of_text = offsets(np.cumsum(np.bincount(text, minlength=len(texts))))
    return [pa.array(np.diff(a_bounds), pa.int64()), pa.array(np.diff(b_bounds), pa.int64()), groups,
            pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), links)]


def _batched(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of about ``RUN_CHARS`` in all, with the number of the first."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= RUN_CHARS or k == len(texts) - 1:
            yield first, texts[first:k + 1]
            first, size = k + 1, 0


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, cut: str | None = CUT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, groups, links)`` of every row.

    ``groups`` are the aligned groups in order, each with its A and B ids;
    ``links`` the text's distinct linked id pairs with how often each occurs in
    it.  A (byte-level) encodes a space and the text, B (sentence pieces) the
    text, to which it adds the space; strings of special tokens are plain text.  A null or
    empty text, and one whose A or B bytes are not a space and the text, has
    no tokens.  Null and repeated ids are kept, one row each; other columns
    are ignored.  A text is aligned as a whole, in memory of some
    hundred times its bytes.  ``cut`` is a pattern of single spaces before which both
    vocabularies always cut (None: texts are not cut).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer_a, tokenizer_b)
        pattern = None if cut is None else re.compile(cut)
        for batch in batches:
            for first, texts in _batched(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), *_aligned(texts, tokens, pattern)],
                    ["doc_id", "n_a", "n_b", "groups", "links"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, groups array<struct<a: array<int>, b: array<int>>>, "
             "links array<struct<a: int, b: int, n: long>>")


def link_counts(aligned: DataFrame) -> DataFrame:
    """``(a, b, count, best)``: links of every id pair, and whether no pair of its B id has more."""
    pairs = written(aligned.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(
        F.sum("l.n").alias("count")), "align-pairs")
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))
    return pairs.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its links, but with ``n_links``, ``n_best`` and ``count_sum`` of each row.

    ``n_best`` are the row's links whose pair has its B id's highest count in
    all rows (ties included), ``count_sum`` adds up the links' counts.  Rows
    without links have zeros.
    """
    rows = written(aligned.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    pairs = written(link_counts(rows), "align-counts")
    # The least power of two above which the pairs are few enough to broadcast.
    sizes = pairs.groupBy(F.floor(F.log2("count")).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()
    least, room = 64, BROADCAST_PAIRS
    for size in sorted(sizes, reverse=True):
        room -= size["n"]
        if room < 0:
            break
        least = size["k"]
    often = F.floor(F.log2("count")) >= least
    own = [c for c in rows.columns if c != "links"]
    links = rows.select(*own, F.explode_outer("links").alias("l")).select(*own, "l.a", "l.b", "l.n")
    scored = links.join(F.broadcast(pairs.where(often)), ["a", "b"], "left")
    if room < 0:
        rare = scored.where("count is null and n is not null").drop("count", "best")
        scored = scored.where("count is not null or n is null").unionByName(rare.join(pairs.where(~often), ["a", "b"]))
    return scored.groupBy(*own).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("count")), F.lit(0)).alias("count_sum")).drop("row")
