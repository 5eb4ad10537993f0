"""The two streaming queries of the service and their runners.

Query A (validation): landing stream of raw messages -> ``foreachBatch``:
validate once, write the batch partitioned by outcome (published / unpaid /
rejected / server_error / malformed) under ``batch_id=<epoch>``, and land the
published envelopes for query B.  Overwriting the epoch's folder makes a
replayed epoch idempotent.

Query B (turnover): stream of published transactions -> slim parse (three
fields) -> event time -> watermark -> tumbling window aggregate (state store)
-> ``append`` -> ``foreachBatch``: validate aggregates, route accepted
envelopes to per-store queue folders, keep rejects.  Messages that no window
of a store can take leave through a quarantine query over the same stream.

Both stop by themselves with ``Trigger.AvailableNow`` in bounded runs; the
closing mark (:mod:`.closing`) at the end of a feed lets state emit the windows
that are still open.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..functions.timefmt import parse_event_time
from ..operators.route import aggregate_envelopes, route_to_stores, transaction_envelopes
from ..operators.turnover import format_aggregated_event, turnover
from ..operators.validate import validate_aggregates
from ..plans.batch import validate_stage
from ..schemas import SALE_SLIM
from .closing import CLOSE_TIME, before_close, is_closing, usable_time
from .sources import FILE_ROWS, KEPT_CODEC, epoch_dir, in_name_order
from .strict import unusable_reason


def validation_batch_writer(out_root: str, in_time_order: bool = False, file_rows: int = FILE_ROWS):
    """``foreachBatch`` body of query A.

    ``in_time_order`` publishes a batch as files in ranges of the event time,
    so that a query B that reads a few of them at a time meets no row late.
    """
    def write(batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        validated = validate_stage(batch_df)
        target = epoch_dir(out_root, "validated", epoch_id)
        validated.write.mode("overwrite").option("compression", KEPT_CODEC).partitionBy("outcome").parquet(target)
        stored = spark.read.schema(validated.schema).parquet(target)
        published = stored.where(F.col("outcome") == C.OUTCOME_PUBLISHED)
        event_time = usable_time(parse_event_time(F.col("txn.timestamp")))
        sent = published
        if in_time_order:
            files = max(1, -(-published.count() // file_rows))
            sent = published.repartitionByRange(files, event_time) if files > 1 else published.coalesce(1)
        env = transaction_envelopes(sent).select("key", "value", "topic", "headers")
        landing = epoch_dir(out_root, "published", epoch_id)
        env.write.mode("overwrite").parquet(landing)
        if in_time_order:
            in_name_order(spark, landing)
        # Published messages that no window can take: kept apart, not dropped downstream.
        unusable = published.where(event_time.isNull())
        transaction_envelopes(unusable).select("key", "value").withColumn(
            "reason", F.lit(C.REASON_BAD_EVENT_TIME)).write.mode("overwrite").parquet(
            epoch_dir(out_root, "bad_event_time", epoch_id))
    return write


def start_validation_stream(stream: DataFrame, out_root: str, checkpoint: str, available_now: bool = True,
                            **writer_options) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(validation_batch_writer(out_root, **writer_options)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def sales_from_messages(stream: DataFrame) -> DataFrame:
    """Published transaction JSON -> (key, value, store_id, timestamp, event_time, total_amount, closing).

    Only the three needed fields are declared, so the parser materialises
    nothing else.  The closing mark has ``CLOSE_TIME`` as its event time; a
    sale that claims as much has none.
    """
    closing = is_closing()
    m = F.from_json(F.col("value"), SALE_SLIM)
    sales = stream.select("key", "value", closing.alias("closing"), m.alias("m"))
    return sales.select(
        "key", "value", F.col("m.store_id").alias("store_id"), F.col("m.timestamp").alias("timestamp"),
        F.when(F.col("closing"), F.lit(CLOSE_TIME)).otherwise(usable_time(parse_event_time(F.col("m.timestamp")))).alias("event_time"),
        F.col("m.total_amount").alias("total_amount"), "closing")


def usable_sales(stream: DataFrame, lateness_ms: int = C.ALLOWED_LATENESS_MS) -> DataFrame:
    """Sales that a window of a store can take, with the watermark set; the marks have moved it and are gone."""
    sales = sales_from_messages(stream).withWatermark("event_time", f"{int(lateness_ms)} milliseconds")
    return before_close(sales, "event_time", also=unusable_reason().isNull())


def unusable_sales(stream: DataFrame) -> DataFrame:
    """``(key, value, reason)`` of the messages that no window of a store can take."""
    sales = sales_from_messages(stream).where(~F.col("closing"))
    return sales.select("key", "value", unusable_reason().alias("reason")).where("reason is not null")


def turnover_stream(stream: DataFrame, lateness_ms: int = C.ALLOWED_LATENESS_MS,
                    length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                    align_to: datetime = C.WINDOW_ALIGN_TO) -> DataFrame:
    """Query B's streaming plan: AggregatedEvent rows, emitted once per closed window."""
    sales = usable_sales(stream, lateness_ms).select("store_id", "event_time", "total_amount")
    return format_aggregated_event(turnover(sales, length_seconds=length_seconds, align_to=align_to))


def aggregate_batch_writer(out_root: str):
    """``foreachBatch`` body of query B: validate, route, keep rejects."""
    def write(batch_df: DataFrame, epoch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(epoch_dir(out_root, "aggregates", epoch_id))
        stored = batch_df.sparkSession.read.schema(batch_df.schema).parquet(
            epoch_dir(out_root, "aggregates", epoch_id))
        checked = validate_aggregates(stored)
        ok = checked.where(F.col("status") == C.STATUS_SUCCESS)
        routed = route_to_stores(aggregate_envelopes(ok))
        routed.write.mode("overwrite").partitionBy("queue").parquet(epoch_dir(out_root, "queues", epoch_id))
        checked.where(F.col("status") != C.STATUS_SUCCESS).write.mode("overwrite").parquet(
            epoch_dir(out_root, "aggregate_rejects", epoch_id))
    return write


def start_turnover_stream(stream: DataFrame, out_root: str, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    agg = turnover_stream(stream)
    w = (agg.writeStream.outputMode("append").foreachBatch(aggregate_batch_writer(out_root))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def start_quarantine_stream(stream: DataFrame, out_root: str, checkpoint: str,
                            available_now: bool = True) -> StreamingQuery:
    """Keep what query B cannot use, with the reason, under ``unusable`` (exactly once, by the file sink's log)."""
    w = (unusable_sales(stream).writeStream.format("parquet").outputMode("append")
         .option("path", f"{out_root}/unusable").option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
