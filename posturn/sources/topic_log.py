"""A topic as a log of committed Parquet segments: a Spark data source and sink.

``spark.dataSource.register(TopicLog)`` adds the format ``posturn_topic`` for
batch and stream, reading and writing::

    <topic>/segments/<writer>-<batch>-<uuid>.parquet    rows, in task order
    <topic>/commits/<sequence>.json                     one per committed write

A write is visible once its commit file exists.  Tasks stream their rows into
segments of their own; the commit lists those of the tasks that
succeeded, so a lost or repeated task leaves at most an unlisted segment.  A
stream's commit carries its writer's name and batch id, and a batch that was
committed before is not committed again: a replayed batch adds nothing.  An
aborted write's segments are deleted.

The offset of a stream is the number of commits it has read.  A batch reads the
segments of the commits in its range, cut into splits of about ``splitBytes``
at row groups; only file names and sizes pass through the driver.

Options: ``path`` (required); ``writer``, the name under which a stream's
batches are known (one per query); ``splitBytes``.  A topic has one committer at a
time.  Paths with a scheme are opened by pyarrow's file systems, others as
mounted folders.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

from ..schemas import ENVELOPE

FORMAT = "posturn_topic"
SPLIT_BYTES = 128 << 20
#: Rows that a task holds before it writes a row group.
GROUP_ROWS = 50_000


class Store:
    """The files of one topic."""

    def __init__(self, path: str):
        from pyarrow import fs

        if "://" in path and not path.startswith("file:"):
            self.fs, self.root = fs.FileSystem.from_uri(path)
        else:
            folder = "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
            self.fs, self.root = fs.LocalFileSystem(), folder

    def segment(self, name: str) -> str:
        return posixpath.join(self.root, "segments", name)

    def commit_path(self, sequence: int) -> str:
        return posixpath.join(self.root, "commits", f"{sequence:012d}.json")

    def commits(self) -> int:
        """How many commits there are; they are numbered without gaps."""
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(posixpath.join(self.root, "commits"), allow_not_found=True))
        return sum(f.path.endswith(".json") for f in found)

    def commit(self, sequence: int) -> dict:
        with self.fs.open_input_file(self.commit_path(sequence)) as f:
            return json.loads(f.read())

    def append(self, entry: dict) -> None:
        """Add a commit; it appears whole or not at all."""
        self.fs.create_dir(posixpath.join(self.root, "commits"), recursive=True)
        draft = posixpath.join(self.root, f".{uuid.uuid4().hex}.draft")
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(entry).encode())
        self.fs.move(draft, self.commit_path(self.commits()))

    def drop(self, names: Sequence[str]) -> None:
        for name in names:
            self.fs.delete_file(self.segment(name))


@dataclass
class Split(InputPartition):
    """Row groups ``first`` to ``last`` (exclusive) of a segment."""

    segment: str
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    """A task's segment: its name (None without rows), rows, and the bytes of its row groups."""

    segment: str | None
    rows: int
    groups: list[int]


def _splits(store: Store, start: int, end: int, split_bytes: int) -> list[Split]:
    """Splits of the commits ``start`` to ``end`` (exclusive), in order."""
    out = []
    for sequence in range(start, end):
        for segment in store.commit(sequence)["segments"]:
            first, size = 0, 0
            for k, n in enumerate(segment["groups"]):
                if size and size + n > split_bytes:
                    out.append(Split(segment["name"], first, k))
                    first, size = k, 0
                size += n
            out.append(Split(segment["name"], first, len(segment["groups"])))
    return out


def _read(path: str, schema: T.StructType, split: Split):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)
    store = Store(path)
    with store.fs.open_input_file(store.segment(split.segment)) as f:
        file = pq.ParquetFile(f)
        held = set(file.schema_arrow.names)
        for batch in file.iter_batches(row_groups=list(range(split.first, split.last)),
                                       columns=[n for n in wanted.names if n in held]):
            columns = [batch.column(n).cast(wanted.field(n).type) if n in held
                       else pa.nulls(batch.num_rows, wanted.field(n).type) for n in wanted.names]
            yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class TopicReader(DataSourceReader):
    """All rows committed when the read is planned."""

    def __init__(self, path: str, schema: T.StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes

    def partitions(self) -> Sequence[InputPartition]:
        store = Store(self.path)
        return _splits(store, 0, store.commits(), self.split_bytes)

    def read(self, partition: Split) -> Iterator:
        return _read(self.path, self.schema, partition) if partition is not None else iter(())


class TopicStreamReader(DataSourceStreamReader):
    """Offsets are numbers of commits."""

    def __init__(self, path: str, schema: T.StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes

    def initialOffset(self) -> dict:
        return {"commits": 0}

    def latestOffset(self) -> dict:
        return {"commits": Store(self.path).commits()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _splits(Store(self.path), start["commits"], end["commits"], self.split_bytes)

    def read(self, partition: Split) -> Iterator:
        return _read(self.path, self.schema, partition)


def _write(path: str, prefix: str, batches: Iterator) -> Written:
    """Write a task's batches to one segment, a row group per ``GROUP_ROWS`` rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    store = Store(path)
    name, writer, held, rows, groups = f"{prefix}-{uuid.uuid4().hex}.parquet", None, [], 0, []

    def flush() -> None:
        nonlocal held
        table = pa.Table.from_batches(held)
        writer.write_table(table, row_group_size=max(1, table.num_rows))
        groups.append(table.nbytes)
        held = []

    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store.fs.create_dir(posixpath.join(store.root, "segments"), recursive=True)
                writer = pq.ParquetWriter(store.segment(name), batch.schema, filesystem=store.fs, compression="zstd")
            held.append(batch)
            rows += batch.num_rows
            if sum(b.num_rows for b in held) >= GROUP_ROWS:
                flush()
        if held:
            flush()
    finally:
        if writer is not None:
            writer.close()
    return Written(name if rows else None, rows, groups)


def _entry(writer: str, batch: int | None, messages: Sequence[Written | None]) -> dict:
    return {"writer": writer, "batch": batch,
            "segments": [{"name": m.segment, "rows": m.rows, "groups": m.groups} for m in messages if m and m.segment]}


def _drop(path: str, messages: Sequence[Written | None]) -> None:
    Store(path).drop([m.segment for m in messages if m and m.segment])


class TopicWriter(DataSourceArrowWriter):
    """A batch write: one commit."""

    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator) -> Written:
        return _write(self.path, "batch", iterator)

    def commit(self, messages) -> None:
        Store(self.path).append(_entry(self.writer, None, messages))

    def abort(self, messages) -> None:
        _drop(self.path, messages)


class TopicStreamWriter(DataSourceStreamArrowWriter):
    """A stream's writes: one commit per batch, once."""

    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator) -> Written:
        return _write(self.path, "stream", iterator)

    def commit(self, messages, batchId: int) -> None:
        store = Store(self.path)
        # A replayed batch is the writer's last one, so the search ends at its latest commit.
        for sequence in reversed(range(store.commits())):
            entry = store.commit(sequence)
            if entry["writer"] == self.writer and entry["batch"] is not None:
                if entry["batch"] >= batchId:
                    _drop(self.path, messages)
                    return
                break
        store.append(_entry(self.writer, batchId, messages))

    def abort(self, messages, batchId: int) -> None:
        _drop(self.path, messages)


class TopicLog(DataSource):
    """The format ``posturn_topic``; rows are message envelopes unless a schema is given."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return ENVELOPE

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError(f"format {FORMAT} needs a path")
        return path

    def _split_bytes(self) -> int:
        return int(self.options.get("splitBytes", SPLIT_BYTES))

    def reader(self, schema: T.StructType) -> TopicReader:
        return TopicReader(self._path(), schema, self._split_bytes())

    def streamReader(self, schema: T.StructType) -> TopicStreamReader:
        return TopicStreamReader(self._path(), schema, self._split_bytes())

    def writer(self, schema: T.StructType, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return TopicWriter(self._path(), self.options.get("writer", ""))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> TopicStreamWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return TopicStreamWriter(self._path(), self.options.get("writer", ""))


def register(spark) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(TopicLog)
