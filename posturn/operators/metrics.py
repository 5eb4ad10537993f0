"""Data-level counters: outcome counts, lag histogram, progress observation."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import config as C


def outcome_counts(df: DataFrame, outcome_col: str = "outcome") -> DataFrame:
    """Running count per outcome (a partial aggregate per task, one shuffle)."""
    return df.groupBy(outcome_col).agg(F.count(F.lit(1)).alias("n"))


def _bound_name(b: float) -> str:
    return "le_" + str(b).replace(".", "_")


def lag_histogram(df: DataFrame, lag_seconds_col: str = "lag_seconds", by: tuple[str, ...] = (),
                  buckets: tuple[float, ...] = C.LAG_BUCKETS) -> DataFrame:
    """Cumulative-bucket histogram of a lag in seconds.

    One row per group with ``le_<bound>`` counts (cumulative, like a
    Prometheus histogram), ``le_inf`` = ``count`` and ``sum_seconds``.
    """
    lag = F.col(lag_seconds_col)
    aggs = [F.count(F.when(lag <= F.lit(b), 1)).alias(_bound_name(b)) for b in buckets]
    aggs += [F.count(F.lit(1)).alias("le_inf"), F.count(lag).alias("count"),
             F.round(F.sum(lag.cast("decimal(18,6)")), 6).cast("double").alias("sum_seconds")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def observe_progress(df: DataFrame, name: str = "progress",
                     counters: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Count the rows (and ``counters``, aggregates by name) that pass here; read it after an action.

    On a stream, use :func:`observe_stream` and a :class:`ProgressCounts`.
    """
    obs = Observation(name)
    return df.observe(obs, *_counted(counters)), obs


def _counted(counters: dict[str, Column] | None) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counters or {}).items()]]


def observe_stream(df: DataFrame, name: str = "progress", counters: dict[str, Column] | None = None) -> DataFrame:
    """A stream that reports its rows (and ``counters``) per micro-batch under ``name``."""
    return df.observe(name, *_counted(counters))


class ProgressCounts(StreamingQueryListener):
    """Running totals of the metrics that streams observe under ``name``.

    Add it with ``spark.streams.addListener`` before a query starts.  Each
    batch is counted once, also when its progress is reported again.
    """

    def __init__(self, name: str = "progress"):
        self.name, self.totals = name, {}
        self._seen: set[tuple[str, int]] = set()
        self._changed = threading.Condition()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get(self.name)
        if row is None or (str(p.id), p.batchId) in self._seen:
            return
        if not row["rows"]:  # a batch of files without rows adds nothing
            return
        with self._changed:
            self._seen.add((str(p.id), p.batchId))
            for key, n in row.asDict().items():
                self.totals[key] = self.totals.get(key, 0) + (n or 0)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def after(self, query: StreamingQuery, timeout: float = 60.0) -> dict[str, int]:
        """The totals once the query has ended and all its reports are in."""
        query.awaitTermination()
        with self._changed:
            self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout)
            return dict(self.totals)
