"""Structured Streaming twins of the harvest jobs (O-T2..O-T5, O-T7, O-Y5).

Every stream reads a landing folder with a fixed schema, so the same
function runs with ``trigger(availableNow=True)`` in tests and the result can
be compared with the batch query over the same files.  Checkpoints live in
the folder the caller passes (a shared path on a cluster).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from presslake.operators.extract import extract_articles_full
from presslake.operators.urls import STATUS_ERR, STATUS_NEW, STATUS_OKK

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def pages_stream(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    """Pages landing as parquet files; ``maxFilesPerTrigger`` is the
    back-pressure knob (the per-host throttle's Spark counterpart)."""
    return spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def events_stream(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    s = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)
    # withWatermark needs TIMESTAMP (not NTZ); the session time zone is UTC.
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def append_articles(pages: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """O-T2: parse pages as they arrive and append whole records, the body
    included, as JSON lines (unordered).  Exactly-once file sink: the
    checkpoint records which files were done."""
    arts = extract_articles_full(pages)
    w = arts.writeStream.format("json").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def dedup_urls(stream: DataFrame, key: str = "url", event_time: str | None = None,
               delay: str = "1 day") -> DataFrame:
    """O-T3: each URL processed once.

    Exact by default: every key ever seen stays in the (RocksDB) state.  With
    ``event_time`` the state is bounded instead: a key is kept until the
    watermark (``delay`` behind the newest event) passes it, so a URL seen
    again later is processed again, and rows later than that are dropped."""
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def progress(stream: DataFrame, group: str, event_time: str, every: str = "1 hour",
             delay: str | None = "1 hour") -> DataFrame:
    """O-T4: rows per group per tumbling window.

    With a ``delay`` state is bounded: append mode emits each window once, when
    the watermark passes it, and rows that come later are left out (the query's
    progress reports them, and :class:`ProgressLog` keeps that).  With None
    every row counts, however late: windows stay in the state, one counter
    each, and update or complete mode corrects those already emitted."""
    return ((stream.withWatermark(event_time, delay) if delay else stream)
            .groupBy(F.window(event_time, every).alias("w"), group)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), group, "n"))


def live_counts(stream: DataFrame, group: str, out_path: str, checkpoint: str, every: str = "3 seconds"):
    """O-T4 live: running row count per group, rewritten to ``out_path`` every
    ``every`` (complete mode: the state is one counter per group)."""
    agg = stream.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out_path))
            .trigger(processingTime=every).start())


def status_events(events: DataFrame) -> DataFrame:
    """URL-status changes from events (error → ERR, purchase → OKK, else NEW)."""
    return events.select(
        F.concat(F.lit("https://example.org/u/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_type") == "error", STATUS_ERR)
         .when(F.col("event_type") == "purchase", STATUS_OKK).otherwise(STATUS_NEW).alias("status"),
        F.col("event_id").alias("seq"),
        F.col("ts"))


def status_state(changes: DataFrame) -> DataFrame:
    """O-T5: URL life-cycle NEW → OKK / ERR, latest wins: an aggregate whose
    state stays in the JVM.  In update mode it emits the current status of
    every URL that changed in the micro-batch."""
    return changes.groupBy("url").agg(F.max("seq").alias("seq"), F.max_by("status", "seq").alias("status"))


def upsert_each_batch(changes: DataFrame, table_path: str, checkpoint: str, available_now: bool = True):
    """O-T5 / O-K9 via ``foreachBatch``: each micro-batch is reduced to its
    latest row per URL and upserted into the buckets of the table that it
    touches.  A batch that is run again after a failure changes nothing."""
    from presslake.sources.sinks import upsert_buckets

    def fn(batch_df: DataFrame, batch_id: int):
        upsert_buckets(batch_df.sparkSession, table_path, batch_df.select("url", "status", "seq"))

    w = changes.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


class _Plateau(StatefulProcessor):
    """Per group: how many heights came, the last of them and its order, and
    whether the group has stopped."""

    def __init__(self, group: str, order: str, height: str):
        self.group, self.order, self.height = group, order, height

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "n bigint, at bigint, height bigint, stopped boolean")

    def handleInputRows(self, key, rows, timerValues):
        n, at, height, stopped = self.state.get() if self.state.exists() else (0, None, None, False)
        if stopped:
            return
        for r in sorted((r for r in rows if r[self.order] is not None), key=lambda r: r[self.order]):
            if at is not None and r[self.order] <= at:
                raise ValueError(f"group {key[0]!r}: {self.order} {r[self.order]} comes after {at}")
            if n and r[self.height] is not None and r[self.height] == height:
                self.state.update((n + 1, r[self.order], height, True))
                yield Row(**{self.group: key[0], "stop_pos": n, f"stop_{self.order}": r[self.order], "stop_height": height})
                return
            n, at, height = n + 1, r[self.order], r[self.height]
        self.state.update((n, at, height, False))

    def close(self) -> None:
        pass


def plateau_stream(heights: DataFrame, group: str, order: str, height: str) -> DataFrame:
    """O-T7 / O-W5 on a stream: one row per group when a height first equals
    the one before it — (group, stop_pos, stop_<order>, stop_height), as
    :func:`presslake.operators.planning.plateau_stop` gives on a whole table.

    State per group (in RocksDB) is the last height and how many came.  A
    group's rows must arrive in order across micro-batches, in any order
    within one; a row before one already seen is an error, not dropped.
    ``group`` keeps its type; order and height are whole numbers."""
    kind = heights.schema[group].dataType.simpleString()
    out = f"`{group}` {kind}, stop_pos bigint, `stop_{order}` bigint, stop_height bigint"
    rows = heights.select(group, F.col(order).cast("bigint").alias(order), F.col(height).cast("bigint").alias(height))
    return rows.groupBy(group).transformWithState(_Plateau(group, order, height), out, "Append", "None")


class ProgressLog(StreamingQueryListener):
    """O-Y5: completion callback — appends (query, batch id, input rows, late
    rows) of every micro-batch as a row of the metrics table at ``path``.  Late
    rows are those that stateful operators left out as behind the watermark; an
    aggregation counts them after combining a batch's rows of equal keys."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        row = [(str(p.id), p.batchId, p.numInputRows, late)]
        self.spark.createDataFrame(row, "query STRING, batch_id BIGINT, input_rows BIGINT, late_rows BIGINT").write.mode("append").json(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
