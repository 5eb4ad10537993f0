"""Byte-level BPE against the tiktoken library, and its edge cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from posturn.llm import byte_bpe as bpe_module
from posturn.llm.byte_bpe import PerfectHash, byte_bpe, decode, encode, load_ranks
from posturn.llm.common import prepared, table
from posturn.llm.queries import LLM_QUERIES

SIGNS = "ab \n\t'sé中x1🙂  \x1c\x85ll.,-  the and"


@pytest.fixture(scope="module")
def codec():
    return byte_bpe()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(), special_tokens={})


def test_hash_is_minimal_and_perfect():
    keys = [f"key {k}".encode() for k in range(3001)] + [b""]
    table_ = PerfectHash(keys)
    assert sorted(map(table_.find, keys)) == list(range(len(keys)))
    assert all(table_.find(f"other {k}".encode()) == -1 for k in range(3000))
    for few in ([], [b"a"], [b"a", b"b"]):
        assert sorted(map(PerfectHash(few).find, few)) == list(range(len(few)))
    with pytest.raises(ValueError):
        PerfectHash([b"a", b"a"])


def test_whole_vocabulary_is_found(codec):
    assert all(codec.rank(token) == rank for token, rank in load_ranks().items())


def test_merges_equal_the_library_in_bounded_runs(codec, library, monkeypatch):
    """Runs of seven pre-tokens cut texts anywhere; long texts are cut lazily."""
    monkeypatch.setattr(bpe_module, "RUN_PIECES", 7)
    monkeypatch.setattr(bpe_module, "LONG_TEXT", 10)
    monkeypatch.setattr(bpe_module, "KEPT_PIECES", 20)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["", "", "a" * 20_000, "xyzzyx" * 3000, "<|endoftext|> a", "ſ ſtarted İ"]
    parts = [ids for _, some in bpe_module._encoded(codec, texts) for ids in some]
    assert [p.tolist() for p in parts] == [library.encode_ordinary(t) for t in texts]


def test_every_character(codec, library):
    texts = ["x" + "".join(f" {chr(c)}{chr(c)}y" for c in range(lo, lo + 256)) for lo in range(0, 0x11000, 256)
             if not 0xd800 <= lo < 0xe000]
    parts = [ids for _, some in bpe_module._encoded(codec, texts) for ids in some]
    assert [p.tolist() for p in parts] == [library.encode_ordinary(t) for t in texts]


def test_decoding_any_cut_and_unknown_ids(codec):
    ids = np.array(list(load_ranks().values()), np.int32)
    assert codec.decode(ids)[0].tobytes() == b"".join(load_ranks())
    for wrong in (-1, 50_256, 10 ** 6):
        with pytest.raises(ValueError):
            codec.decode(np.array([0, wrong], np.int32))


def test_vocabulary_needs_all_bytes():
    ranks = load_ranks()
    with pytest.raises(ValueError):
        bpe_module.ByteBpe({t: r for t, r in ranks.items() if t != b"a"}, public_tokenizers.PATTERN)
    with pytest.raises(ValueError):
        bpe_module.ByteBpe({t: 0 for t in ranks}, public_tokenizers.PATTERN)


def test_edges(spark, codec, library):
    prepared(spark)
    rows = [(1, None, 0), (2, "", 1), (None, "no id", 2), (3, "same row", 3), (3, "same row", 3), (4, "é" * 50_000, 4)]
    docs = spark.createDataFrame([(i, t, [k], "x") for i, t, k in rows], "doc_id long, text string, ids array<int>, decoded string")
    coded = encode(docs, codec, decoded=True)
    assert coded.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded).decode()) for r in coded.collect()), key=repr)
    assert got == sorted(((i, library.encode_ordinary(t or ""), t or "") for i, t, _ in rows), key=repr)
    back = decode(encode(docs, codec).unionByName(encode(docs.limit(1), codec).withColumn("ids", F.lit(None))), codec)
    assert sorted((repr(r.doc_id), bytes(r.decoded).decode()) for r in back.collect()) == sorted(
        [(repr(i), t or "") for i, t, _ in rows] + [("1", "")])
    assert encode(docs.limit(0), codec, decoded=True).count() == 0
    named = docs.select(F.concat(F.lit("k"), "doc_id").alias("name"), F.col("text").alias("body"))
    assert encode(named, codec, "name", "body").schema["doc_id"].dataType.simpleString() == "string"


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r[1:] for r in LLM_QUERIES["op11_byte_bpe"](spark, sf).collect()}
    want = {}
    for r in table(spark, sf, "documents").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    assert got == want
