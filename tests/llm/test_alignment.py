"""Alignment against a plain walk over common ends, and against whole-text tokenization."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from posturn.llm import alignment
from posturn.llm.alignment import CUT, TOKENIZER_A, TOKENIZER_B, ByteLevel, Pieces, Tokens, align, coalesced, link_scores
from posturn.llm.common import prepared, table
from posturn.llm.queries import LLM_QUERIES

SIGNS = "ab \n\t'sé中x1🙂  \x1c\x85ll.,-  the and▁<0x41>\0 　"


@pytest.fixture(scope="module")
def plain():
    """Groups of one text by walking over both sides' ends."""
    a = Tokenizer.from_file(public_tokenizers.path(TOKENIZER_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(TOKENIZER_B))
    shown = [k for k in range(256) if k in range(33, 127) or k in range(161, 173) or k in range(174, 256)]
    byte = dict(zip(map(chr, shown), shown)) | {chr(256 + n): k for n, k in enumerate(k for k in range(256) if k not in shown)}
    a_bytes = {k: bytes(byte[c] for c in t) for t, k in a.get_vocab().items() if set(t) <= set(byte)}

    def b_bytes(k):
        piece = b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
        parts = [[a_bytes[k] for k in ids[0]], [b_bytes(k) for k in ids[1]]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return []
        ends = [list(itertools.accumulate(map(len, p))) for p in parts]
        out, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            upto = [e.index(end) + 1 for e in ends]
            out.append((ids[0][at[0]:upto[0]], ids[1][at[1]:upto[1]]))
            at = upto
        return out

    return groups


def scores(groups_of):
    """The query's columns from every row's groups."""
    links = {row: Counter((g[0][-1], g[1][-1]) for g in gs) for row, gs in groups_of.items()}
    count = sum(links.values(), Counter())
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = {}
    for row, gs in groups_of.items():
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out[row] = (sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs),
                    hashlib.sha256(text.encode()).hexdigest() if gs else "", sum(links[row].values()),
                    sum(n for p, n in links[row].items() if count[p] == most[p[1]]), sum(n * count[p] for p, n in links[row].items()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]


def odd_texts():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    return texts + ["", None, "a" * 3000, "<|endoftext|> a <s> </s> <unk>", "x", " ", "  ", "word" * 2 + " ", "ſ İ ﬁ ①"]


def test_coalescing():
    a, b, ends = coalesced(np.array([2, 3, 7, 9]), np.array([1, 3, 5, 6, 9]))
    assert (a.tolist(), b.tolist(), ends.tolist()) == ([2, 2], [2, 3], [3, 9])
    assert [x.tolist() for x in coalesced(np.array([], int), np.array([], int))] == [[], [], []]


def test_cut_and_whole_texts_equal_the_libraries(plain, monkeypatch):
    """Cutting texts at lone spaces, and keeping few pieces, changes nothing."""
    monkeypatch.setattr(alignment, "KEPT_PIECES", 500)
    a, b = ByteLevel(public_tokenizers.path(TOKENIZER_A)), Pieces(public_tokenizers.path(TOKENIZER_B))
    texts = odd_texts()
    want = [plain(t) for t in texts]
    for cut in (None, re.compile(CUT)):
        tokens = Tokens(a, b)
        got = []
        for lo in range(0, len(texts), 700):
            got += alignment._aligned(texts[lo:lo + 700], tokens, cut)[2].to_pylist()
        assert [[(g["a"], g["b"]) for g in gs] for gs in got] == want
    assert sum(map(bool, want)) > 1000 and sum(not w for w in want) > 500


def test_ids_of_every_character_equal_the_json_vocabulary():
    """The ranks beside the vocabulary give its ids."""
    a = ByteLevel(public_tokenizers.path(TOKENIZER_A))
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER_A))
    library.encode_special_tokens = True
    texts = ["x" + "".join(f" {chr(c)}{chr(c)}y" for c in range(lo, lo + 256)) for lo in range(0, 0x11000, 256)
             if not 0xd800 <= lo < 0xe000]
    assert a.encode(texts) == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_scores_and_edges(spark, plain, monkeypatch):
    """Few pairs fit the broadcast, so most go by shuffle."""
    prepared(spark)
    texts = odd_texts()[-600:] + ["the word and the word"] * 5
    rows = [(k if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, "twice"), (7, "twice")]
    docs = spark.createDataFrame([(i, t, k, "x", 0) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, row int, links string, n long").repartition(4)
    aligned = align(docs)
    assert aligned.columns == ["doc_id", "n_a", "n_b", "groups", "links"]
    want = scores({k: plain(t) for k, (_, t) in enumerate(rows)})
    want = sorted(repr((i, *want[k][:2], *want[k][4:])) for k, (i, _) in enumerate(rows))
    for limit in (400_000, 20, 0):
        monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
        got = link_scores(aligned.drop("groups"))
        assert got.columns == ["doc_id", "n_a", "n_b", "n_links", "n_best", "count_sum"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert link_scores(align(docs.limit(0))).count() == 0
    none = link_scores(align(docs.where("text is null or text = ''")))
    assert {tuple(r)[1:3] + tuple(r)[4:] for r in none.collect()} == {(0, 0, 0, 0, 0)}
    assert align(docs.select(F.col("links").alias("name"), F.col("text").alias("body")), id_col="name", text_col="body").count() == len(rows)


def test_query_against_a_walk(spark, plain):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in LLM_QUERIES["op13_alignment"](spark, sf).collect()}
    assert got == scores({r.doc_id: plain(r.text) for r in table(spark, sf, "documents").collect()})
