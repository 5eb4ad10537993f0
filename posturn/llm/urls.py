"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed keys (rules as ``host/path-prefix``, and whole canonical URLs) go into a
blocked Bloom filter: a key picks one block and sets one bit in each of the
block's eight 32-bit words, so a probe reads one row.  The filter has a fixed
upper size, so it can be broadcast whatever the list's length; a longer list
only lets more false positives pass.  URLs whose candidate keys hit the filter
go on to an exact join with the list, which removes the false positives.
Everything is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posturn.llm.common import lower_ascii, written

WORDS = 8
BITS_PER_KEY = 16
MAX_FILTER_BLOCKS = 1 << 17  # 32 bytes each: at most 4 MB


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical key of a URL: host without ``www.`` or a default port, then its path.

    Repeated slashes and a trailing slash go, and so do scheme, query and
    fragment; a URL without ``://`` has the empty key.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/+", "/"), "/$", "")
    return F.when(host == "", "").otherwise(F.concat(host, path))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _word_bits(key: Column) -> list[Column]:
    """One bit in each word of the key's block, from five hash bits each."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``(block, w0..w7)`` of the non-empty blocks; keys are OR-ed before and after the shuffle."""
    bits = keys.select(_block(F.col(key), blocks).alias("block"),
                       *[c.alias(f"w{i}") for i, c in enumerate(_word_bits(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def _hits(probes: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The probes whose key may be listed."""
    columns = probes.columns
    bits = probes.withColumn("block", _block(F.col(key), blocks))
    marked = bits.join(F.broadcast(bloom), "block")
    for i, c in enumerate(_word_bits(F.col(key))):
        marked = marked.where(F.col(f"w{i}").bitwiseAND(c) == c)
    return marked.select(columns)


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every URL: ``(page_id, url, host, path, rule, listed, verdict)``, one row per input row.

    ``rules`` has ``rule`` (``host/path-prefix``) and ``action`` (allow or
    block).  A rule fits its host and all subdomains when the URL's path starts
    with the rule's path; the longest rule wins, of equally long ones the one
    first in text order.  ``listed`` has one column ``url``, canonical URLs to block.
    Without a rule a listed URL is blocked and any other allowed.

    A null URL, or one without ``://``, has an empty host and path, fits no
    rule and is allowed.  Null and repeated list entries are ignored.  A null
    id is judged like any other and repeated rows come back repeated; other
    columns are ignored.  Empty lists allow everything.
    """
    rules = written(rules.where("rule is not null and action is not null")
                    .groupBy("rule").agg(F.min("action").alias("action")), "url-rules")
    listed = written(listed.select(F.col("url").alias("key")).where("key is not null and key <> ''").distinct(),
                     "url-list")
    rule_path = F.expr("substring(rule, instr(rule, '/'))")
    # One candidate prefix per length that rule paths have: a summary no longer than the longest path.
    lengths = [r[0] for r in rules.where("instr(rule, '/') > 0").select(F.length(rule_path)).distinct().collect()]
    # Likewise one host suffix per number of labels that rule hosts have, however many labels a URL's host has.
    depths = [r[0] for r in rules.where("instr(rule, '/') > 0")
              .select(F.size(F.split(F.substring_index("rule", "/", 1), r"\."))).distinct().collect()]
    n_keys = rules.count() + listed.count()
    blocks = min(MAX_FILTER_BLOCKS, max(1, 2 ** math.ceil(math.log2(max(1, n_keys) * BITS_PER_KEY / (32 * WORDS)))))
    keys = rules.select(F.concat(F.lit("r:"), "rule").alias("key")) \
        .unionByName(listed.select(F.concat(F.lit("u:"), "key").alias("key")))
    bloom = written(bloom_filter(keys, "key", blocks), "url-bloom")

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")) \
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    urls = rows.groupBy("url").agg(F.first("host").alias("host"), F.first("path").alias("path")) \
        .where("host <> ''")  # one probe per distinct URL, counted together before the shuffle

    labels = F.split("host", r"\.")
    suffixes = F.filter(F.array(*[F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), "."))
                                  for n in depths]), lambda s: s.isNotNull()) \
        if depths else F.array().cast("array<string>")
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) \
        if lengths else F.array().cast("array<string>")
    probes = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(F.lit("r:"), s, p))))
    probes = F.array_union(probes, F.array(F.concat(F.lit("u:"), canonical(F.col("url")))))
    hits = _hits(urls.select("url", F.explode(probes).alias("key")), "key", bloom, blocks)

    exact = rules.select(F.concat(F.lit("r:"), "rule").alias("key"), "rule", "action") \
        .unionByName(listed.select(F.concat(F.lit("u:"), "key").alias("key"),
                                   F.lit(None).cast("string").alias("rule"), F.lit("block").alias("action")))
    judged = hits.join(exact, "key").groupBy("url").agg(
        F.min(F.when(F.col("rule").isNotNull(), F.struct(-F.length("rule"), "rule", "action"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"))
    return rows.join(judged, "url", "left").select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
        F.coalesce(F.col("best.action"), F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"))
