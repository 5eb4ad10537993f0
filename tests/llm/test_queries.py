"""The registered queries against DuckDB or brute force on whole tables, and the pipeline stage by stage."""

import hashlib
import os
import random

import duckdb
import pytest

import corpus_pipeline
from posturn.llm.common import prepared, table, written
from posturn.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert sorted(int(k[2:].split("_")[0]) for k in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    want = con.execute(LLM_ORACLE[name])
    columns = [c[0] for c in want.description]
    got = LLM_QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_op2_against_all_pairs(spark):
    from tests.llm.test_edges import brute_components

    rows = LLM_QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001").collect()
    fps = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    assert [r.component_id for r in rows] == brute_components(fps, 2)


def test_op4_agrees_with_op8(spark):
    counts = {r.doc_id: r.n_tokens for r in LLM_QUERIES["op4_token_counts"](spark, SF).collect()}
    packed = LLM_QUERIES["op8_packing"](spark, SF).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert counts == {r[0]: r[1] - 1 for r in packed}


def test_op10_against_brute_force(spark):
    from tests.llm.test_edges import cut_by_hand

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, sf, "documents").collect()]
    want = {i: (n, n - len(kept), hashlib.sha256(kept).hexdigest()) for i, n, kept in cut_by_hand(rows, 50)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in LLM_QUERIES["op10_substrings"](spark, sf).collect()}
    assert got == want


def test_pipeline_stages(spark):
    """Each stage keeps its input's columns and drops exactly what its operator names."""
    docs = table(prepared(spark), SF, "documents").cache()
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "simhash near-dedup", "benchmark decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "test-stage")
        assert out.columns == columns
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in out.collect()}
        assert after.items() <= before.items()
        if name == "quality classifier":
            bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
            good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
            assert len(bad & set(after)) <= 0.05 * len(bad) and len(good & set(after)) >= 0.95 * len(good)
        if name == "exact dedup":
            last = {}
            for i, t in sorted(before.items()):
                last[t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))] = i
            assert set(after) == set(last.values())
        if name == "benchmark decontamination":
            from posturn.llm.decontam import words_of

            items = [" ".join(words_of(r.text)) for r in table(spark, SF, "benchmark").collect()]
            leaked = {i for i, t in before.items() if any(x in " ".join(words_of(t)) for x in items)}
            assert set(before) - set(after) == leaked
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_edges(spark):
    """Nulls, repeated rows and extra columns go through every stage."""
    prepared(spark)
    good = table(spark, SF, "documents").where("doc_id < 60")
    odd = spark.createDataFrame([(None, None, "en", "s", 0), (5000, "", "en", "s", 0), (5001, None, None, None, None)], good.schema)
    docs = written(good.unionByName(good.where("doc_id < 5")).unionByName(odd), "test-odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-odd")
        assert docs.columns == good.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name == "exact dedup":
            texts = [r.text for r in docs.collect()]
            assert len(texts) == len(set(texts))  # of repeated rows one stays
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_pipeline_judges_rows_not_ids(spark):
    """Clean rows whose null or repeated id a near copy or a leak has too stay; one row of each class stays."""
    prepared(spark)
    schema = table(spark, SF, "documents").schema
    item = max((r.text for r in table(spark, SF, "benchmark").collect()), key=len)
    text = lambda n: " ".join(f"w{n}x{k}" for k in range(200))
    near = lambda n: text(n).upper()  # noqa: E731  # the same words: one class, and another text

    def texts(stage, rows):
        df = written(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema), "test-rows")
        return sorted(((r.doc_id is None, r.doc_id, r.text) for r in written(stage(spark, df, SF), "test-rows").collect()), key=str)

    def want(*rows):
        return sorted(((i is None, i, t) for i, t in rows), key=str)

    got = texts(corpus_pipeline.near_dedup, [(1, text(1)), (None, near(1)), (None, text(2)), (3, text(3)), (3, near(1)),
                                             (None, text(4)), (None, near(4)), (5, text(5)), (5, text(5)), (6, text(6)), (4, near(6))])
    assert [r[:2] for r in got] == [(False, 1), (False, 3), (False, 4), (False, 5), (True, None), (True, None)]
    assert {r[2].lower() for r in got} == {text(n) for n in range(1, 7)}
    got = texts(corpus_pipeline.decontaminate, [(None, item), (None, text(1)), (2, text(2)), (2, f"so {item}"), (3, text(9))])
    assert got == want((None, text(1)), (2, text(2)), (3, text(9)))


def test_pipeline_fits_the_axes_on_every_row(spark, tmp_path, monkeypatch):
    """Both passes of the fit read all rows of the stage, however many blocks they have."""
    from posturn.llm import decontam

    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    spark.createDataFrame([(k, text(20)) for k in range(3)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(k, text(70)) for k in range(60)], "doc_id long, text string")
    seen, summed = [], decontam._summed

    def counted(df, *args):
        seen.append(df.count())
        return summed(df, *args)
    monkeypatch.setattr(decontam, "_summed", counted)
    monkeypatch.setattr(decontam, "FIT_BLOCKS", 20)
    assert corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).count() == 60
    assert seen == [60, 60]
