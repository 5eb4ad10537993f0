"""WARC archives: writing with revisits, and reading by boundary-chain verification.

Archives are written by Spark's text writer, one record per row, with the two
line ends after each record as separator, so any store works and every file is
a plain WARC.  They are read by Spark's text reader split at the record magic,
so a large file is read by many tasks.  Each row then starts right after a
*candidate* magic, which may just as well lie inside a payload.  Tasks emit for
every candidate the offset of its successor (from its own length) and, for
their split, where its chain leaves the split.  Pointer jumping from each file's
start over those exits finds the entry of each split in a logarithmic number of
rounds; the chain from the entry keeps the reachable candidates, and rows
between them are put back into the payload they were cut from.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posturn.llm.common import written
from posturn.session import scratch_path

MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
#: Tables of up to so many rows (about 100 bytes each) may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000

_MAGIC_BYTES = len(MAGIC)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits make four base-32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted rows allow that, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> None:
    """Write one record per row to ``path``; of rows with equal payloads the least id is the response.

    The payload is the text in UTF-8 (null: empty).  The others are revisits
    that refer to it.  Null ids are largest; rows that repeat both id and
    payload get equal records.  A null URL leaves its header line out.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    keyed = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = written(keyed.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                     .where("n > 1").select("digest", "first_id"), "warc-shared")
    joined = keyed.join(_small(shared.withColumn("shared", F.lit(True))), "digest", "left")
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    record_id = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    # The magic must not end a header line.
    uri = F.regexp_replace(F.regexp_replace("url", r"[\r\n]", "%0A"), "WARC/1[.]0", "%57ARC/1.0")
    size = F.octet_length("html")
    head = F.concat(F.lit(HTTP_HEAD), size.cast("string"), F.lit(RECORD_END))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("html").cast("binary")), F.lit("\r\n"))
    common = F.concat(F.lit(MAGIC + "WARC-Record-ID: "), record_id, F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"),
                      F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")), F.lit("")), digest)
    value = F.when(revisit, F.concat(
        common, F.lit("WARC-Type: revisit\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/"
                      "identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
        F.coalesce(F.col("first_id").cast("string"), F.lit("null")),
        F.lit(">\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 0" + RECORD_END))).otherwise(
        F.concat(common, F.lit("WARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\n"
                               "Content-Length: "), (size + F.octet_length(head)).cast("string"),
                 F.lit(RECORD_END), head, F.col("html")))
    joined.select(value.alias("value")).write.option("lineSep", RECORD_END).text(path)


_FIELDS = ("type", "record_id", "refers_to", "uri", "digest")
_NAMES = {b"warc-type": "type", b"warc-record-id": "record_id", b"warc-refers-to": "refers_to",
          b"warc-target-uri": "uri", b"warc-payload-digest": "digest"}


def _headers(value: bytes) -> tuple[int, int, dict] | None:
    """``(header bytes with their end, content length, known fields)`` of what follows a magic."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields, length = {}, None
    for line in value[:end].split(b"\r\n"):
        name, colon, text = line.partition(b":")
        name = name.strip().lower()
        if name == b"content-length" and re.fullmatch(rb"\s*\d{1,18}\s*", text):
            length = int(text)
        elif name in _NAMES:
            fields[_NAMES[name]] = text.strip().decode("utf-8", "replace")
    return None if length is None else (end + 4, length, fields)


_KEYS = "file string, split long, seq long"


def _read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """Rows with their number within their split; a split's rows come in file order, one split after another."""
    at, seq = None, 0
    for batch in batches:
        for file, split, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (file, split) != at:
                at, seq = (file, split), 0
            yield file, split, seq, value
            seq += 1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row's place in its split, its successor's, and where its chain leaves the split (-1: nowhere)."""
    names = ["file", "split", "seq", "rel", "size", "next", "exit", "last", "whole"]

    def flush(file, split, rows):
        known = {rel: (nxt, k) for k, (rel, _, nxt, _) in enumerate(rows)}
        total = rows[-1][0] + _MAGIC_BYTES + rows[-1][1]
        leave = [(-1, -1)] * len(rows)
        for k in range(len(rows) - 1, -1, -1):
            rel, _, nxt, _ = rows[k]
            if nxt is None:
                continue
            if nxt in known:
                leave[k] = leave[known[nxt][1]]
            elif nxt >= total:
                leave[k] = (nxt, rel)
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n), pa.array([split] * n, pa.int64()), pa.array(range(n), pa.int64()),
             pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([x[0] for x in leave], pa.int64()),
             pa.array([x[1] for x in leave], pa.int64()), pa.array([r[3] for r in rows], pa.bool_())], names)

    at, rows, rel = None, [], 0
    for file, split, seq, value in _numbered(batches):
        if (file, split) != at:
            if rows:
                yield flush(*at, rows)
            # The first row of a file lies before any magic; its end counts as one.
            at, rows, rel = (file, split), [], -_MAGIC_BYTES if split == 0 else 0
        head = _headers(value) if rel >= 0 else None
        nxt = rel + _MAGIC_BYTES + head[0] + head[1] + 4 if head else None
        whole = head is not None and len(value) == head[0] + head[1] + 4
        rows.append((rel, len(value), nxt, whole))
        rel += _MAGIC_BYTES + len(value)
    if rows:
        yield flush(*at, rows)


def _follow(group: pd.DataFrame) -> pd.DataFrame:
    """In one split: which candidates the chain from the entry reaches, and each row's record."""
    group = group.sort_values("offset").reset_index(drop=True)
    place = {o: k for k, o in enumerate(group["offset"])}
    owner = np.full(len(group), -1, np.int64)
    entry = group["entry"].iloc[0]
    at = None if pd.isna(entry) else int(entry)
    while at is not None and at in place:
        k = place[at]
        owner[k] = at
        nxt = group["next"].iloc[k]
        at = None if pd.isna(nxt) else int(nxt)
    owner = np.maximum.accumulate(owner)
    before = group["before"].fillna(-1).astype("int64").to_numpy()
    group["owner"] = np.where(group["offset"] < 0, -1, np.where(owner < 0, before, owner))
    return group[["file", "split", "seq", "offset", "owner", "whole"]]


def _verified(candidates: DataFrame) -> DataFrame:
    """``(file, split, seq, offset, owner, whole)``: each row with the offset of the reachable record it belongs to (-1: none)."""
    by_file = Window.partitionBy("file").orderBy("split")
    splits = candidates.groupBy("file", "split").agg(F.sum(F.col("size") + _MAGIC_BYTES).alias("bytes"))
    # A file's first row has no magic before it, so later splits start that much earlier.
    splits = written(splits.withColumn("base", F.sum("bytes").over(by_file) - F.col("bytes") -
                                       F.when(F.col("split") == 0, 0).otherwise(_MAGIC_BYTES)), "warc-splits")
    cand = candidates.join(splits.select("file", "split", "base"), ["file", "split"])
    shift = F.col("base")
    cand = written(cand.select("file", "split", "seq", (F.col("rel") + shift).alias("offset"),
                               (F.col("next") + shift).alias("next"),
                               F.when(F.col("exit") >= 0, F.col("exit") + shift).alias("exit"),
                               F.when(F.col("last") >= 0, F.col("last") + shift).alias("last"), "whole"), "warc-offsets")

    # Pointer jumping over the exits that some chain may take.
    targets = cand.select("file", F.col("exit").alias("offset")).where("offset is not null").distinct()
    jumps = cand.where("exit is not null").join(
        targets.unionByName(cand.select("file", F.lit(0).cast("long").alias("offset"))).distinct(),
        ["file", "offset"], "left_semi").select("file", "offset", "exit", "last").distinct()
    jumps = written(jumps, "warc-jumps")
    reached = cand.where("offset = 0").select("file", "offset", F.lit(None).cast("long").alias("last"))
    reached = written(reached, "warc-entries")
    while True:
        onward = reached.select("file", "offset").join(jumps, ["file", "offset"]) \
            .select("file", F.col("exit").alias("offset"), "last")
        more = written(reached.unionByName(onward).groupBy("file", "offset").agg(F.max("last").alias("last")),
                       "warc-entries")
        if more.count() == reached.count():
            break
        reached = more
        far = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("far"), F.col("last").alias("far_last"))
        jumps = written(jumps.join(far, ["file", "exit"]).select(
            "file", "offset", F.col("far").alias("exit"), F.col("far_last").alias("last")), "warc-jumps")

    # Per split: its entry, and the record that reaches in from before it.
    entered = cand.join(reached.withColumnRenamed("last", "before"), ["file", "offset"]) \
        .groupBy("file", "split").agg(F.min(F.struct("offset", "before")).alias("e")) \
        .select("file", "split", F.col("e.offset").alias("entry"), F.col("e.before").alias("before"))
    ends = reached.groupBy("file").agg(F.max("last").alias("final"))
    following = by_file.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    places = splits.select("file", "split").join(entered, ["file", "split"], "left").join(ends, "file", "left") \
        .withColumn("before", F.coalesce(F.first("before", ignorenulls=True).over(following), "final")) \
        .select("file", "split", "entry", "before")
    return cand.join(places, ["file", "split"]).groupBy("file", "split").applyInPandas(
        _follow, f"{_KEYS}, offset long, owner long, whole boolean")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Verified records: ``(file, split, seq, type, record_id, refers_to, uri, digest, payload)``.

    Records are those reachable from the start of their file by their own
    lengths; a file that does not start with a record has none, and a chain
    ends at a record whose length leads nowhere.  An empty folder of archives
    gives no rows.  A header that is cut by the magic itself is not read.
    """
    rows = _read_rows(spark, path)
    candidates = written(rows.mapInArrow(_candidates, f"{_KEYS}, rel long, size long, next long, exit long, last long, "
                                                  "whole boolean"), "warc-candidates")
    verified = written(_verified(candidates), "warc-verified")

    # Rows that are not a whole record: inside a payload, cut by a magic, or unreachable.
    odd = _small(verified.where("not (whole and owner = offset)").select("file", "split", "seq", "offset", "owner"))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for file, split, seq, value in _numbered(batches):
            held.append((file, split, seq, value))
            size += len(value)
            if size > 8 << 20:
                yield table(held)
                held, size = [], 0
        if held:
            yield table(held)

    def table(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held]), pa.array([h[1] for h in held], pa.int64()),
                                           pa.array([h[2] for h in held], pa.int64()),
                                           pa.array([h[3] for h in held], pa.binary())], ["file", "split", "seq", "value"])

    numbered = rows.mapInArrow(bodies, f"{_KEYS}, value binary").join(odd, ["file", "split", "seq"], "left")
    whole = numbered.where("owner is null").select("file", "split", "seq", "value")
    magic = F.lit(MAGIC).cast("binary")
    # Put cut records together again: the rows of one record in file order, joined by the magic they were cut at.
    parts = numbered.where("owner >= 0").groupBy("file", F.col("owner").alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("offset").alias("at"), "split", "seq", "value"))).alias("p"))
    joined = parts.select(
        "file", F.col("p")[0]["split"].alias("split"), F.col("p")[0]["seq"].alias("seq"),
        F.aggregate(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(1))), F.col("p")[0]["value"],
                    lambda acc, x: F.concat(acc, magic, x["value"])).alias("value"))

    return _records(whole.unionByName(joined))


def _field(head: Column, name: str) -> Column:
    """The text of the last header line of that name; NULL if there is none."""
    line = rf"(?is)\A(?:.*\r\n)?[ \t]*{name}[ \t]*:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n.*)?\z"
    return F.when(head.rlike(line), F.regexp_extract(head, line, 1))


def _records(rows: DataFrame) -> DataFrame:
    """Header fields and payloads of values that follow a magic; a value without its whole block is no record.

    In expressions alone: a Python worker numbers the rows of the same task already.
    """
    raw = F.col("value")
    headed = rows.where(F.instr(raw.cast("string"), RECORD_END) > 0).withColumn(
        "head", F.substring_index(raw.cast("string"), RECORD_END, 1))
    length = r"(?is)\A(?:.*\r\n)?[ \t]*content-length[ \t]*:[ \t]*(\d{1,18})[ \t]*(?:\r\n.*)?\z"
    sized = headed.withColumns({"start": F.octet_length("head") + len(RECORD_END),
                                "length": F.regexp_extract("head", length, 1).try_cast("long")})
    sized = sized.where(F.col("length").isNotNull() & (F.octet_length("value") >= F.col("start") + F.col("length")))
    block = sized.withColumn("block", F.substring(raw, F.col("start") + 1, F.col("length").try_cast("int")))
    # The entity of an HTTP response block; without an end of its head it is empty.
    text = F.col("block").cast("string")
    entity = F.substring(F.col("block"), F.octet_length(F.substring_index(text, RECORD_END, 1)) + len(RECORD_END) + 1,
                         F.octet_length("block"))
    payload = F.when(F.substring(F.col("block"), F.lit(1), F.lit(5)) == F.lit("HTTP/").cast("binary"), entity).otherwise(F.col("block"))
    names = {name: label.decode() for label, name in _NAMES.items()}
    return block.select("file", "split", "seq", *[_field(F.expr("make_valid_utf8(head)"), names[n]).alias(n) for n in _FIELDS],
                        payload.alias("payload"))


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return scratch_path(spark, "llm", f"warc-{uuid.uuid4().hex}")
