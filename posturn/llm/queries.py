"""Driver queries of the subpackage, one per operator, over whole tables.

Each applies its operator with production parameters and derives the columns
of its contract; ``ORACLE`` has the DuckDB SQL where SQL can express one.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posturn.llm.common import prepared, table
from posturn.session import scratch_path


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items leaked into documents: latent search, then subsequence and answer checks."""
    from posturn.llm.decontam import leaks

    prepared(spark)
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most 2 differing bits."""
    from posturn.llm.simhash import simhash_groups

    groups = simhash_groups(table(prepared(spark), sf_dir, "documents"), width=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SPAM_HOSTS = "casino|bets|pills|ads-|spam|adult"


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL; listed are the canonical URLs on hosts with a spam term."""
    from posturn.llm.urls import canonical, filter_urls, host_of

    pages = table(prepared(spark), sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "rule string, action string")
    listed = pages.where(host_of(F.col("url")).rlike(SPAM_HOSTS)).select(canonical(F.col("url")).alias("url"))
    return filter_urls(pages, rules, listed).select("page_id", "host", "path", "rule", "listed", "verdict")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by scanning flat token streams for separators."""
    from posturn.llm.token_counts import OUTSIDE, token_counts, write_streams

    path = scratch_path(prepared(spark), "llm", f"tokens-{uuid.uuid4().hex}")
    write_streams(table(spark, sf_dir, "documents"), path, end_id=OUTSIDE)
    return token_counts(spark, path, OUTSIDE)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels of rows that are not held out."""
    from posturn.llm.quality import quality_scores

    prepared(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back; revisits take their payload's figures from the response."""
    from posturn.llm.warc import archive_folder, base32_sha1, read_warc, write_warc

    folder = archive_folder(prepared(spark))
    write_warc(table(spark, sf_dir, "pages"), folder)
    return warc_digest(read_warc(spark, folder).select(
        "type", "record_id", "refers_to", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest")))


def warc_digest(records: DataFrame) -> DataFrame:
    """One row per record, from its type, ids and its payload's size and digest."""
    from posturn.llm.common import written

    records = written(records, "warc-records")
    page = r"^<urn:page:(-?\d+)>$"
    own = F.regexp_extract("record_id", page, 1).try_cast("long")
    responses = records.where("type = 'response'")
    of_response = responses.groupBy(F.col("record_id").alias("refers_to"), F.col("payload_digest")).agg(
        F.first("payload_bytes").alias("payload_bytes"))
    first = responses.select(own.alias("page_id"), "payload_bytes", "payload_digest",
                             F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    revisits = records.where("type = 'revisit'").select("record_id", "refers_to", F.expr(
        "substring(digest, 6)").alias("payload_digest")).join(of_response, ["refers_to", "payload_digest"]).select(
        own.alias("page_id"), "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"),
        F.regexp_extract("refers_to", page, 1).try_cast("long").alias("refers_to"))
    return first.unionByName(revisits)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal after lower-casing A-Z; the largest id stays."""
    from posturn.llm.exact import exact_groups

    groups = exact_groups(table(prepared(spark), sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of a power of two, at most 2048 tokens."""
    from posturn.llm.packing import pack

    return packed_digest(pack(table(prepared(spark), sf_dir, "documents")))


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds too, edits allowed."""
    from posturn.llm.passages import repeated_passages

    return repeated_passages(table(prepared(spark), sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 50-byte string of an earlier document, removed."""
    from posturn.llm.substrings import removed_substrings

    cut = removed_substrings(table(prepared(spark), sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and the bytes they decode to."""
    from posturn.llm.byte_bpe import byte_bpe, encode

    coded = encode(table(prepared(spark), sf_dir, "documents"), byte_bpe(), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


#: ASCII white space, as the filters' words see it.
WHITE = r"[\x20\x09-\x0D]+"


def quality_filters() -> dict:
    """The five audited filters, as failure conditions on a document's text."""
    from posturn.llm.filter_audit import COPY_OF_EARLIER

    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, WHITE), "")
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 3 * F.length(text),
            "D": text.rlike("[#$%&*|]"),
            "E": COPY_OF_EARLIER}


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order of them, per language."""
    from posturn.llm.filter_audit import audit

    prepared(spark)
    return audit(table(spark, sf_dir, "documents"), quality_filters(), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens of two vocabularies with common ends, and how usual their links are."""
    from posturn.llm.alignment import align, link_scores

    prepared(spark)
    return link_scores(alignment_digest(align(table(spark, sf_dir, "documents"))))


def alignment_digest(aligned: DataFrame) -> DataFrame:
    def side(ids):
        return F.array_join(ids.cast("array<string>"), ",")

    groups = F.array_join(F.transform("groups", lambda g: F.concat(side(g["a"]), F.lit("|"), side(g["b"]))), ";")
    return aligned.select("doc_id", "n_a", "n_b", F.size("groups").cast("long").alias("n_groups"),
                          F.when(F.size("groups") == 0, "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"), "links")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_url_filter": op3_url_filter,
    "op4_token_counts": op4_token_counts,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_passages": op9_passages,
    "op10_substrings": op10_substrings,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_filter_audit": op12_filter_audit,
    "op13_alignment": op13_alignment,
}

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LLM_ORACLE: dict[str, str] = {
    "op3_url_filter": rf"""
with parts as (
  select page_id, url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), {_UPPER}, {_LOWER}), '') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
canon as (
  select *, case when host = '' then '' else
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/$', '') end as key
  from parts),
listed as (select distinct key from canon where key <> '' and regexp_matches(host, '{SPAM_HOSTS}')),
rules(rule, rhost, rpath, action) as (values
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best as (
  select c.page_id, c.host, c.path, c.key,
    (select r.rule from rules r where (c.host = r.rhost or ends_with(c.host, '.' || r.rhost))
       and starts_with(c.path, r.rpath) order by length(r.rule) desc, r.rule limit 1) as rule
  from canon c)
select page_id, host, path, rule, key in (select key from listed) as listed,
  coalesce((select action from rules r where r.rule = best.rule),
           case when key in (select key from listed) then 'block' else 'allow' end) as verdict
from best""",
    "op7_exact_dedup": f"""
with norm as (select doc_id, translate(coalesce(text, ''), {_UPPER}, {_LOWER}) as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from norm window w as (partition by t)""",
    "op6_warc": """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
g as (select *, min(page_id) over (partition by html) as first_id from p)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i * 5 // 20 * 5 + 1)::int, 5))::int >> (15 - i % 4 * 5)::int) & 31) + 1, 1)), '') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from g""",
    "op12_filter_audit": """
with d as (select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as caps,
  min(doc_id) over (partition by t) as first_id from d),
good as (select distinct doc_id from labels where quality = 1),
bad as (select distinct doc_id from labels where toxic = 1),
f as (select part, (len(words) < 200)::int as a, (100 * list_unique(words) < 50 * len(words))::int as b,
  (100 * caps > 3 * length(t))::int as c, regexp_matches(t, '[#$%&*|]')::int as d, coalesce(doc_id > first_id, false)::int as e,
  (doc_id in (select doc_id from good))::int as good, (doc_id in (select doc_id from bad))::int as toxic from w),
g as (select part, a + 2 * b + 4 * c + 8 * d + 16 * e as fails, count(*) as n, sum(good) as good, sum(toxic) as toxic
  from f group by all),
p as (select a.x || b.x || c.x || d.x || e.x as filter_order
  from (select unnest(['A', 'B', 'C', 'D', 'E']) as x) a, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) b,
    (select unnest(['A', 'B', 'C', 'D', 'E']) as x) c, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) d,
    (select unnest(['A', 'B', 'C', 'D', 'E']) as x) e
  where list_unique([a.x, b.x, c.x, d.x, e.x]) = 5),
s as (select filter_order, k::int as step, substr(filter_order, k::int, 1) as letter,
  (1 << instr('ABCDE', substr(filter_order, k::int, 1))::int) // 2 as bit,
  coalesce(list_sum([(1 << instr('ABCDE', substr(filter_order, j::int, 1))::int) // 2 for j in range(1, k)]), 0)::int as before
  from p, range(1, 6) r(k)),
x as (select g.part, s.filter_order, s.step, s.letter, sum(case when fails & (before | bit) = 0 then n else 0 end) as kept,
  sum(case when fails & bit > 0 and fails & before = 0 then n else 0 end) as removed,
  sum(case when fails & bit > 0 and fails & before > 0 then n else 0 end) as redundant,
  sum(case when fails = bit then n else 0 end) as unique_fails,
  sum(case when fails & bit > 0 and fails & before = 0 then good else 0 end) as good_lost,
  sum(case when fails & bit > 0 and fails & before = 0 then toxic else 0 end) as toxic_lost
  from g, s group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from x""",
}
