"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, per operator."""

import base64
import functools
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from posturn.llm.common import prepared

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [
    (1, "The Quick brown fox jumps over the lazy dog and runs away"),
    (2, "the quick brown fox jumps over the lazy dog and runs away"),
    (3, None), (4, ""), (5, "   \n\t "), (6, LONG), (7, LONG.upper()), (8, "x"),
    (9, "É é ß 中文 the end"), (9, "É é ß 中文 the end"), (None, "no id here"), (None, None), (2, "another text of id two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with columns named as the operators' own."""
    prepared(spark)
    rows = [(i, t, "en", "src", 0, "h", 1, "c", "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, "
                                       "h string, chunk int, fp string, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def brute_components(fps, bits):
    """Least id reachable per row of ``[(id, fingerprint)]``."""
    n = len(fps)
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(n), 2):
        if bin((fps[i][1] ^ fps[j][1]) & (2 ** 64 - 1)).count("1") <= bits:
            up[find(i)] = find(j)
    ids = {}
    for i in range(n):
        ids.setdefault(find(i), []).append(fps[i][0])
    return [min([x for x in ids[find(i)] if x is not None], default=None) for i in range(n)]


def test_simhash_fingerprint_against_plain_count():
    import xxhash
    from posturn.llm.simhash import fingerprint

    def plain(text, width):
        words = text.encode().lower().split()
        if not words:
            return 0
        shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in ("", "A", "a B", "a b c", "The cat sat on the mat the cat sat", "É x y z É x", LONG[:5000]):
        assert fingerprint(text.encode(), 3) & (2 ** 64 - 1) == plain(text, 3)


def test_simhash_edges(docs, empty):
    from posturn.llm.simhash import fingerprint, simhash_groups

    rows = simhash_groups(docs).collect()
    assert len(rows) == len(TEXTS)
    fps = [(r.doc_id, r.fp) for r in rows]
    assert [r.component_id for r in rows] == brute_components(fps, 2)
    want = sorted(((i, fingerprint((t or "").encode(), 3)) for i, t in TEXTS), key=str)
    assert sorted(fps, key=str) == want
    assert simhash_groups(empty).count() == 0


@pytest.mark.parametrize("bits,cap", [(2, 12), (5, 2048)])
def test_simhash_index_against_all_pairs(spark, bits, cap):
    from posturn.llm.components import components
    from posturn.llm.simhash import link_forest

    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 2 ** 63, 20)
    fps = {0, -1}
    for s in seeds.tolist():  # dense neighbourhoods, so that top nodes overflow the cap
        for _ in range(15):
            x = s
            for b in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << b
            fps.add(x - 2 ** 64 if x >= 2 ** 63 else x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.component for r in components(link_forest(df, bits, cap)).collect()}
    want = brute_components([(f, f) for f in fps], bits)
    assert [got.get(f, f) for f in fps] == want


def test_exact_edges(docs, empty):
    from posturn.llm.exact import exact_groups

    for kwargs in ({}, {"capacity": 300, "max_depth": 2}):  # the second overflows every bucket into several owners
        rows = exact_groups(docs, **kwargs).collect()
        assert len(rows) == len(TEXTS)
        groups = {}
        low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        for i, t in TEXTS:
            groups.setdefault((t or "").translate(low), []).append(i)
        want = []
        for text, ids in groups.items():
            keep = max([i for i in ids if i is not None], default=None)
            want += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
        got = [(r.doc_id, r.keep_id, r.group_size, bytes(r.sha256).hex()) for r in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert sum(r.kept for r in rows) == len(groups)  # one row of each group, also of repeated rows
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_groups(empty).count() == 0


def test_extendible_directory_splits_by_doubling():
    from posturn.llm.exact import directory

    sizes = {0: 100, 1: 5, 2: 5, 3: 5, 12: 30}
    buckets = directory(sizes, 20, 4)
    covered = [leaf for at, local, _ in buckets for leaf in range(at, at + (1 << (4 - local)))]
    assert sorted(covered) == list(range(16))
    assert (0, 4, 5) in buckets  # cannot be split further: five owners
    assert (8, 2, 1) in buckets and (12, 4, 2) in buckets


def test_exact_collisions_are_chained():
    import pyarrow as pa
    from posturn.llm.exact import _owner

    batch = pa.RecordBatch.from_pydict({"bucket": [0] * 5, "salt": [0] * 5, "owners": [1] * 5, "h": [7, 7, 7, 7, 8],
                                        "text": [b"a", b"b", b"a", b"b", b"a"]})
    out = next(iter(_owner([batch]))).to_pydict()
    assert out["chain"] == [0, 1, 0, 1, 0] and out["first"] == [True, True, False, False, True]


def test_quality_edges(spark, docs, empty):
    from posturn.llm.quality import features, quality_scores

    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (8, 0, 1), (None, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert quality_scores(empty, labels).count() == 0
    assert quality_scores(docs, labels.limit(0)).count() == len(TEXTS)
    assert features(b"") == features(b" \n ") == [0.0] * len(features(b"a"))


def test_quality_held_out_accuracy(spark):
    from posturn.llm.common import table
    from posturn.llm.quality import quality_scores

    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    rows = quality_scores(table(spark, sf, "documents"), labels).join(labels, "doc_id").where("held_out") \
        .select("quality", "score", "predicted").collect()
    right = np.mean([r.quality == r.predicted for r in rows])
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([g > b for g in good for b in bad])
    assert len(rows) > 500 and right > 0.97 and auc > 0.99


@functools.cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def tokenized(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def test_tokens_equal_the_tokenizers_library():
    import random

    from posturn.llm.tokens import encoder

    r = random.Random(1)
    letters = list("ab \n\t'.s1é%  　\x1c\x85") + ["<|endoftext|>", "don't ", "中 "]
    texts = ["", " ", "a ", " a", "don't  do", LONG[:3000]] + ["".join(r.choices(letters, k=r.randrange(12))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(encoder().encode(t), "<u4").tolist() == tokenized(t), repr(t)


def test_packing_edges(docs, empty):
    from posturn.llm.packing import pack, piece_lengths

    assert [piece_lengths(n) for n in (0, 1, 7, 2048, 4099)] == [[], [1], [4, 2, 1], [2048], [2048, 2048, 2, 1]]
    rows = pack(docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0 for r in rows)
    got = {}
    for r in sorted(rows, key=lambda r: r.sequence_id):
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, t in TEXTS:
        ids = tokenized(t) + [1]
        pieces = got[i, len(ids)]
        copies = sum((i, len(tokenized(u)) + 1) == (j, len(ids)) for j, u in TEXTS)
        joined = [x for _, p in pieces for x in p]
        assert len(joined) == copies * len(ids)
        if copies == 1 or (i, t) == (9, TEXTS[8][1]):
            assert joined[:len(ids)] == ids
    assert pack(empty).count() == 0


def test_token_counts_edges(spark, docs, empty, tmp_path):
    from posturn.llm.token_counts import scan_separators, token_counts, write_streams

    want = sorted(((i, len(tokenized(t))) for i, t in TEXTS), key=str)
    for n in (3, 1000, 1 << 18):  # documents over many blocks, and many documents in one
        path = str(tmp_path / f"t{n}")
        write_streams(docs, path, block_tokens=n)
        assert sorted(((r.doc_id, r.n_tokens) for r in token_counts(spark, path).collect()), key=str) == want
    write_streams(empty, str(tmp_path / "none"))
    assert token_counts(spark, str(tmp_path / "none")).count() == 0
    # An unclosed end, empty and null blocks.
    block = lambda *ids: np.array(ids, "<u2").tobytes()
    df = spark.createDataFrame([(0, 0, block(5, 50256, 6)), (0, 1, b""), (0, 2, None), (0, 5, block(7, 8, 50256, 50256, 9)),
                                (0, 7, block(1, 1))], "stream long, block long, tokens binary")
    assert sorted((r.ordinal, r.n_tokens) for r in scan_separators(df).collect()) == [(0, 1), (1, 3), (2, 0), (3, 3)]


def test_token_counts_with_the_end_of_text_literal(spark, tmp_path):
    from posturn.llm.queries import op4_token_counts

    texts = [(1, "a model ends with <|endoftext|> and goes on"), (2, "<|endoftext|>"), (3, "plain words"), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_tokens for r in op4_token_counts(spark, str(tmp_path)).collect()}
    assert got == {i: len(tokenized(t)) for i, t in texts} and got[2] == 1


def test_url_edges(spark):
    from posturn.llm.urls import canonical, filter_urls

    urls = ["http://A.Example.NET/en/x", "http://example.net", "http://example.net/", "https://www.x.org:443//a//b/?q#f", None, "",
            "no scheme", "http://", "://h/p", "http://b.example.com/de/1", "http://b.example.com/de", "http://notnet/",
            "http://x.org/fr/z", "HTTP://X.ORG/fr/z", "http://x.org/a/b", "http://x.org/a/b"]
    pages = spark.createDataFrame([(k if k != 3 else None, u, "<p>", "clash", "w0") for k, u in enumerate(urls)],
                                  "page_id long, url string, html string, rule string, block string")
    rules = spark.createDataFrame([("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
                                   ("org/fr/", "allow"), (None, "block"), ("org/fr/", "allow")], "rule string, action string")
    listed = spark.createDataFrame([("x.org/a/b",), (None,), ("",), ("x.org/a/b",)], "url string")
    got = {(r.page_id, r.url): r for r in filter_urls(pages, rules, listed).collect()}
    assert len(got) == len(urls)

    def want(url):
        rest = url.split("://", 1)[1] if url and "://" in url else None
        cut = lambda s, marks: s[:min([s.find(m) for m in marks if m in s], default=len(s))]
        host = cut(rest, "/?#") if rest is not None else ""
        path = cut(rest[len(host):], "?#") if rest is not None else ""
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [(r, a) for r, a in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
                                    ("org/fr/", "allow"))
                if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
        return host, path, max(fits, key=lambda f: len(f[0]), default=(None, None))

    for (_, url), r in got.items():
        host, path, (rule, action) = want(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        listed_now = url in ("https://www.x.org:443//a//b/?q#f", "http://x.org/a/b")
        assert r.listed == listed_now and r.verdict == (action or ("block" if listed_now else "allow"))
    none = filter_urls(pages, rules.limit(0), listed.limit(0))
    assert none.where("verdict = 'allow' and rule is null").count() == len(urls)
    assert filter_urls(pages.limit(0), rules, listed).count() == 0
    assert pages.select(canonical(F.col("url")).alias("c")).where("c = 'x.org/a/b'").count() == 3


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: %d\r\n\r\n"


def test_warc_round_trip(spark):
    from posturn.llm.queries import warc_digest
    from posturn.llm.warc import archive_folder, base32_sha1, read_warc, write_warc

    prepared(spark)
    htmls = [None, "", "same", "same", "x" * 7000, "a" + FAKE % 5 + "hello\r\n\r\n" + FAKE % 10, "é" * 99 + "WARC/1.0\r\n" * 900,
             "\r\n\r\n", "big\r\n" * 4000 + FAKE % 3 + "z" * 9000, "same", "WARC/1.0\r\n"]
    rows = [(k if k != 7 else None, f"http://h/WARC/1.0\r\n{k}" if k % 2 else None, h, "x", 1) for k, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string, split int").coalesce(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # records and payloads across many splits
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        path = archive_folder(spark)
        write_warc(pages, path)
        records = read_warc(spark, path)
        assert sorted(bytes(r.payload) for r in records.where("type = 'response'").collect()) == sorted(
            {(h or "").encode() for h in htmls})
        got = {r.page_id: r for r in warc_digest(records.select(
            "type", "record_id", "refers_to", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32_sha1(F.col("payload")).alias("payload_digest"))).collect()}
        none = archive_folder(spark)
        write_warc(pages.limit(0), none)
        assert read_warc(spark, none).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert len(got) == len(htmls)
    first = {}
    for page, _, h, _, _ in rows:
        first[h or ""] = min(x for x in (first.get(h or ""), page) if x is not None) if page is not None or h in first else page
    for page, _, h, _, _ in rows:
        data, r = (h or "").encode(), got[page]
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        own = first[h or ""] == page
        assert (r.record_type, r.refers_to) == (("response", None) if own else ("revisit", first[h or ""]))


def test_decontamination(spark, docs, empty):
    from posturn.llm.decontam import leaks, lcs_length, words_of

    words = [f"w{i}" for i in range(400)]
    rng = np.random.default_rng(2)
    filler = lambda n: " ".join(rng.choice(words, n))
    item = "When the river rose, twelve families crossed the old bridge at night. The miller counted nine lanterns."
    near = item.replace("twelve", "a dozen").replace("old ", "").upper()
    texts = [(1, filler(300) + " " + item + " " + filler(90)), (2, filler(35) + near), (3, filler(500)), (4, None), (5, ""),
             (6, "The miller counted nine lanterns."), (7, item.split(".")[0] + "."), (None, item), (8, item), (8, item)]
    df = spark.createDataFrame([(i, t, 0.5, 1) for i, t in texts], "doc_id long, text string, cosine double, item_id int")
    bench = spark.createDataFrame([(10, item), (11, None), (12, "..."), (None, "the"), (13, filler(30))], "item_id long, text string")
    got = leaks(df, bench).collect()
    found = sorted(((r.doc_id, r.item_id) for r in got), key=str)
    assert found == sorted([(1, 10), (2, 10), (None, 10), (8, 10), (8, 10)], key=str)
    assert all(r.lcs >= 0.6 and r.answer >= 0.5 for r in got)
    assert leaks(empty, bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0
    assert leaks(docs, bench).count() == 0
    assert lcs_length({1: 0b001, 2: 0b010, 3: 0b100}, 3, [3, 1, 9, 2, 3]) == 3
    assert words_of("É_a-b 2!") == ["é_a", "b", "2"]


def test_decontamination_recall(spark):
    """Latent candidates lose at most a tenth of what checking every passage against every item finds."""
    from posturn.llm.common import table
    from posturn.llm.decontam import leaks

    docs, bench = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    every = {(r.doc_id, r.item_id) for r in leaks(docs, bench, exhaustive=True).collect()}
    found = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert found <= every and len(found) >= 0.9 * len(every) > 0


def test_passages(spark, docs, empty):
    from posturn.llm.passages import PrefixMax, chains, repeated_passages

    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(5000)]
    filler = lambda n: list(rng.choice(words, n))
    passage, run = filler(80), ["the"] * 70
    fuzzy = passage[:30] + ["new", "words"] + passage[31:60] + passage[63:]
    whole = filler(60)
    texts = {1: filler(200) + passage + filler(40), 2: filler(20) + fuzzy + filler(30), 3: filler(300),
             4: passage[:45] + filler(60), 5: run + filler(30), 6: filler(10) + run, 7: whole, 8: [w.upper() for w in whole]}
    rows = [(i, " ".join(t), "x") for i, t in texts.items()] + [(9, None, "x"), (10, "", "x"), (None, " ".join(passage), "x")]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, source_id string")).collect()
    found = {(r.doc_id, r.source_id): r for r in got}
    assert set(found) == {(2, 1), (6, 5), (8, 7)}
    assert (found[2, 1].start_word, found[2, 1].source_word) == (20, 200) and found[2, 1].similarity >= 0.9
    assert found[8, 7].n_words == 60 and found[6, 5].n_words >= 50
    assert repeated_passages(empty).count() == 0
    assert {(r.doc_id, r.source_id) for r in repeated_passages(docs).collect()} == {(7, 6)}
    tree = PrefixMax(5)
    tree.update(3, (2.0, 0))
    tree.update(1, (1.0, 1))
    assert tree.upto(1)[1] == -1 and tree.upto(3)[1] == 1 and tree.upto(4)[1] == 0
    assert chains([(0, 0), (5, 5), (10, 10), (12, 1)])[0] == [(0, 0), (5, 5), (10, 10)]


def test_decontamination_without_the_last_sentence(spark):
    from posturn.llm.decontam import leaks

    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    filler = lambda n: " ".join(rng.choice(words, n))
    item = ("When the river rose, twelve families crossed the old bridge at night while the miller counted nine "
            "lanterns and his daughter held the lame horse. Horses.")
    texts = [(1, filler(200) + " " + item.replace(" Horses.", "") + " " + filler(50)), (2, filler(60) + " " + item.replace("Horses", "Mules")),
             (3, filler(40) + " " + " ".join(item.split()[:15])), (4, filler(9000))]
    got = leaks(spark.createDataFrame(texts, "doc_id long, text string"),
                spark.createDataFrame([(10, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == {1, 2} and all(r.lcs >= 0.8 and r.answer == 0 for r in got)


def test_decontamination_recall_on_sampled_axes(spark, monkeypatch):
    """200 items, more than the axes' rank, and axes fitted on a part of the blocks."""
    from posturn.llm import decontam
    from posturn.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id % 2 = 0")
    bench = table(spark, "/root/testdata/sf0.1", "benchmark")
    monkeypatch.setattr(decontam, "FIT_BLOCKS", 2000)
    every = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench, exhaustive=True).collect()}
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    print("recall on sampled axes:", len(found & every), "of", len(every), "items", bench.count())
    assert bench.count() == 200 and found <= every and len(found) >= 0.9 * len(every) > 0


def edited(rng, words, passage, share):
    """``passage`` with a share of its words changed, left out or preceded by a new one."""
    out = list(passage)
    for k in sorted(rng.choice(len(passage), round(share * len(passage)), replace=False), reverse=True):
        out[k:k + 1] = [[rng.choice(words)], [], [rng.choice(words), out[k]]][rng.integers(3)]
    return out


def test_passages_recall(spark):
    """Edited passages of 50 to 100 words, against brute force over the words that were planted."""
    from posturn.llm.passages import repeated_passages

    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(20000)]
    filler = lambda n: list(rng.choice(words, n))
    rows, want = [], set()
    for k in range(300):
        a = filler(50 + k % 51)
        b = edited(rng, words, a, (0.05, 0.1, 0.15, 0.2)[k % 4])
        rows += [(2 * k, filler(40) + a + filler(40)), (2 * k + 1, filler(60) + b + filler(20))]
        # Common subsequence by the plain table, between the first and the last equal words.
        first, last = [next(((i, j) for n in range(9) for i in range(n + 1) for j in [n - i] if x[i] == y[j]), (9, 9))
                       for x, y in ((a, b), (a[::-1], b[::-1]))]
        x, y = a[first[0]:len(a) - last[0]], b[first[1]:len(b) - last[1]]
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, j in np.ndindex(len(x), len(y)):
            table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
        if min(len(x), len(y)) >= 50 and table[-1, -1] >= 0.8 * max(len(x), len(y)):
            want.add((2 * k + 1, 2 * k))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = repeated_passages(df).collect()
    found = {(r.doc_id, r.source_id) for r in got}
    assert all(r.similarity >= 0.8 and min(r.n_words, r.source_words) >= 50 for r in got)
    assert found <= {(2 * k + 1, 2 * k) for k in range(300)}
    assert len(want) > 200 and len(want & found) >= 0.99 * len(want), (len(want), len(want & found))


def test_passages_parts_and_ends(spark):
    from posturn.llm.passages import repeated_passages

    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(20000)]
    filler = lambda n: list(rng.choice(words, n))
    short, long, single = filler(52), filler(300), filler(60)
    # One word in three stays in the middle of ``gap``: no seed there, and each side alone is too short.
    gap = filler(130)
    sparse = [w if not 49 <= k < 81 or k % 2 else filler(1)[0] for k, w in enumerate(gap)]
    fifths = [filler(1)[0] if k % 5 == 0 and k != 30 else w for k, w in enumerate(single)]  # one run of five and more
    texts = {1: filler(30) + short + filler(30), 2: filler(9) + short[:2] + ["new"] + short[3:49] + ["new"] + short[50:],
             3: filler(30) + gap, 4: sparse + filler(30), 5: filler(30) + long, 6: long[:150] + filler(40) + long[150:],
             7: single + filler(30), 8: filler(30) + fifths}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r.doc_id, r.source_id): r for r in repeated_passages(df).collect()}
    assert set(found) == {(2, 1), (4, 3), (6, 5), (8, 7)}
    assert (found[2, 1].start_word, found[2, 1].n_words, found[2, 1].source_word) == (9, 52, 30)
    assert found[4, 3].n_words == 130 and found[6, 5].n_words == 340


def suffixes_by_sorting(text, cap):
    s = text.tolist()
    return [tuple(s[p:p + cap]) for p in sorted(range(len(s) - 1), key=lambda p: s[p:p + cap])]


@pytest.mark.parametrize("limit", [0, 1 << 20])  # zero: queues and arrays on disk
def test_induced_sorting(limit, tmp_path):
    from posturn.llm.suffixes import suffix_groups

    rng = np.random.default_rng(limit + 1)
    for size in (1, 2, 5, 30, 200):
        for letters in (1, 2, 4, 250):
            text = np.r_[rng.integers(1, letters + 1, size), rng.integers(1, letters + 1, size)]
            text = np.r_[text, text[: size // 2], 0].astype(np.uint16)
            for cap in (3, 50):
                pos, new = [], []
                for p, fresh in suffix_groups(text, cap, str(tmp_path), limit):
                    pos += p.tolist()
                    new += fresh.tolist()
                s = text.tolist()
                held = [(p, f) for p, f in zip(pos, new) if p < len(s) - 1]
                assert [tuple(s[p:p + cap]) for p, _ in held] == suffixes_by_sorting(text, cap)
                for (a, _), (b, fresh) in zip(held, held[1:]):
                    same = s[a:a + cap] == s[b:b + cap] and max(a, b) + cap <= len(s)
                    if s[a] == s[b]:
                        assert fresh == (not same)


def cut_by_hand(rows, length):
    """Removed bytes per row of ``[(id, bytes)]``; null ids are largest."""
    order = lambda i: 2 ** 63 - 1 if i is None else i
    first = {}
    for i, b in rows:
        for k in range(len(b) - length + 1):
            g = b[k:k + length]
            first[g] = min(first.get(g, order(i)), order(i))
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < order(i):
                gone[k:k + length] = b"\1" * length
        out.append((i, len(b), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_substrings(spark, docs, empty):
    from posturn.llm.substrings import removed_substrings

    rng = np.random.default_rng(6)
    part = lambda n: bytes(rng.integers(97, 123, n).tolist()).decode()
    line, block = part(60), part(400)
    texts = [(i, t) for i, t in TEXTS if t is None or len(t) < 1000]
    texts += [(20, part(90) + line + part(30)), (21, line), (22, "é" * 300), (23, part(10) + "é" * 120 + line), (24, block),
              (25, block[:200] + "!" + block[200:]), (26, block), (27, part(49)), (28, "=" * 900), (29, "=" * 130 + line),
              (30, line * 3), (None, block + line), (19, block[100:149]), (24, block), (31, "a" * 49), (32, "a" * 49), (33, "a\0" * 60)]
    df = spark.createDataFrame([(i, t, "x", b"y") for i, t in texts], "doc_id long, text string, snippet string, kept binary")
    want = cut_by_hand([(i, (t or "").encode()) for i, t in texts], 50)
    for kwargs in ({}, {"shard_bytes": 300, "limit": 0}):
        rows = removed_substrings(df.repartition(3), **kwargs).collect()
        assert sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in rows), key=str) == sorted(want, key=str)
        for r in rows:
            spans = [(s.start, s.end) for s in r.spans]
            assert sum(b - a for a, b in spans) == r.n_bytes - len(r.kept)
            assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert removed_substrings(empty).count() == 0


@pytest.mark.parametrize("order", [("a1", "a2", "b", "c"), ("b", "a1", "a2", "c"), ("c", "a1", "a2", "b")])
def test_passages_of_several_sources(spark, order):
    """Words 1-40 in one document, 41-80 in another, all 80 in a third, and a copy of that with every ninth changed."""
    from posturn.llm.passages import repeated_passages
    rng = random.Random(5)
    rows, wanted = [], set()
    for case in range(40):
        words = [f"w{rng.randrange(10**9)}" for _ in range(80)]
        edited = [f"e{rng.randrange(10**9)}" if k % 9 == 4 else w for k, w in enumerate(words)]
        texts = {"a1": words[:40], "a2": words[40:], "b": words, "c": edited}
        ids = {part: case * 10 + k for k, part in enumerate(order)}
        rows += [(ids[p], " ".join(t + [f"u{rng.randrange(10**9)}" for _ in range(30)])) for p, t in texts.items()]
        wanted.add((max(ids["b"], ids["c"]), min(ids["b"], ids["c"])))
    got = {(r.doc_id, r.source_id) for r in
           repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(wanted & got) >= 0.95 * len(wanted)
    assert got <= wanted


def test_decontamination_of_many_words(spark):
    """Items whose words do not fit one block, and one item alone with more words than 16-bit ids have."""
    from posturn.llm.decontam import MAX_WORDS, _chunks, _item_blocks, _streams

    giant = " ".join(f"g{j}" for j in range(MAX_WORDS + 10))
    items = [(k, " ".join(f"i{k}x{j}" for j in range(40_000))) for k in range(2)] + [(2, giant), (3, "a short item")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert [[r.item_id for r in b] for b in _item_blocks(iter(benchmark.collect()))] == [[0], [1], [2], [3]]
    words = {w: k + 1 for k, w in enumerate(giant.split())}
    streams = _streams(benchmark.where("item_id = 2"), words, "item_id", "text").toArrow().to_batches()
    (_, _, (ids,)), = _chunks(iter(streams), len(words))
    assert ids.tolist() == list(range(1, len(words) + 1))


def test_quality_sample_is_bounded(spark):
    from posturn.llm.quality import train

    docs = spark.createDataFrame([(1, "a few words here")] * 500 + [(2, "b"), (3, "some more words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    once = train(docs.dropDuplicates(), labels)
    assert np.array_equal(train(docs, labels).weights, once.weights)


def test_directory_depth_follows_the_data():
    from posturn.llm.exact import DEEPEST, MAX_BUCKET_BYTES, MAX_DEPTH, depth_for

    assert depth_for(0, MAX_DEPTH) == depth_for(200 << 30, MAX_DEPTH) == MAX_DEPTH
    assert depth_for(1 << 40, MAX_DEPTH) == 17 and depth_for(100 << 40, MAX_DEPTH) == DEEPEST
    for total in (300 << 30, 1 << 40, 4 << 40):
        assert total >> depth_for(total, MAX_DEPTH) <= MAX_BUCKET_BYTES / 2


def test_url_filter_with_very_many_labels(spark):
    from posturn.llm.urls import filter_urls

    pages = spark.createDataFrame([(1, "http://" + "a." * 6000 + "org/fr/x"), (2, "http://b.c.net/"), (3, "http://net/"),
                                   (4, "http://x.example.net/en/y"), (5, "http://org")], "page_id long, url string")
    rules = spark.createDataFrame([("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")],
                                  "rule string, action string")
    listed = spark.createDataFrame([], "url string")
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages, rules, listed).collect()}
    assert got == {1: ("org/fr/", "allow"), 2: ("net/", "block"), 3: ("net/", "block"),
                   4: ("example.net/en/", "allow"), 5: (None, "allow")}


def test_decontamination_axes_of_all_blocks(spark, monkeypatch):
    """The latent axes are fitted on every block: smaller tasks of the fit give the same cosines."""
    from posturn.llm import decontam

    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(600)]
    items = [(k, " ".join(rng.choice(words, 14))) for k in range(40)]
    texts = [(k, " ".join(rng.choice(words, 90)) + (" " + items[k % 40][1] if k % 3 == 0 else "")) for k in range(240)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5, "doc_id")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def cosines():
        return {(r.doc_id, r.item_id): r.cosine for r in decontam.leaks(docs, bench, exhaustive=True, rank=24).collect()}

    whole = cosines()
    monkeypatch.setattr(decontam, "FIT_BLOCKS", 100)
    parts = cosines()
    assert len(whole) >= 80 and whole.keys() == parts.keys()
    assert max(abs(whole[k] - parts[k]) for k in whole) < 1e-4


def test_decontamination_sums_of_runs():
    from posturn.llm.decontam import BLOCK_WORDS, _block_sums, _run_sums

    rng = np.random.default_rng(13)
    size = np.r_[np.arange(1, BLOCK_WORDS + 1), rng.integers(1, BLOCK_WORDS + 1, 200)]
    start = np.r_[0, np.cumsum(size)[:-1]]
    table = rng.standard_normal((50, 6)).astype(np.float32)
    index = rng.integers(0, 50, size.sum())
    plain = np.array([table[index[a:a + n]].sum(axis=0, dtype=np.float64) for a, n in zip(start, size)])
    assert np.abs(_block_sums(table, index, start) - plain).max() < 1e-4
    assert np.abs(_run_sums(table.astype(np.float64), index, start) - plain).max() < 1e-12


def test_passages_of_a_holder_between_others(spark):
    """The whole passage lies between documents with its halves before and after it, so it is no seed's first or last holder."""
    from posturn.llm.passages import repeated_passages
    rng = random.Random(6)
    rows, wanted = [], set()
    for case in range(20):
        words = [f"w{rng.randrange(10**9)}" for _ in range(80)]
        edited = [f"e{rng.randrange(10**9)}" if k % 9 == 4 else w for k, w in enumerate(words)]
        texts = [words[:40], words[40:], words, words[:40], words[40:], edited]
        rows += [(case * 10 + k, " ".join(t + [f"u{rng.randrange(10**9)}" for _ in range(30)])) for k, t in enumerate(texts)]
        wanted.add((case * 10 + 5, case * 10 + 2))
    got = {(r.doc_id, r.source_id) for r in
           repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == wanted
