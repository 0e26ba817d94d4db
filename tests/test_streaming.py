"""Streams give the batch result after availableNow."""

import os
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from presslake.operators import extract as X
from presslake.operators import urls as U
from presslake.sources.tables import table
from presslake.streaming import jobs as J


def _land(spark, scratch, name, n_files=4):
    path = os.path.join(scratch, name)
    table(spark, SF_SMALL, name).repartition(n_files).write.parquet(path)
    return path


def test_append_stream_equals_batch(spark, scratch):
    src = _land(spark, scratch, "pages")
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    q = J.append_articles(J.pages_stream(spark, src, max_files=1), out, ck)
    q.awaitTermination(300)
    want = X.extract_articles_full(table(spark, SF_SMALL, "pages"))
    got = spark.read.schema(want.schema).json(out)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()  # whole rows, the body included
    assert not got.where("size(content) > 0").isEmpty()


def test_dedup_stream_equals_batch(spark, scratch):
    src = _land(spark, scratch, "events")
    changes = J.status_events(J.events_stream(spark, src))
    d = J.dedup_urls(changes, "url", event_time=None)   # exact: unbounded state
    q = d.writeStream.format("memory").queryName("dedup_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert spark.table("dedup_t").select("url").distinct().count() == spark.table("dedup_t").count()
    want = U.url_events(table(spark, SF_SMALL, "events")).select("url").distinct().count()
    assert spark.table("dedup_t").count() == want


def test_progress_stream_counts(spark, scratch):
    src = _land(spark, scratch, "events")
    p = J.progress(J.events_stream(spark, src), "event_type", "ts")
    q = p.writeStream.format("memory").queryName("prog_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = {(r.window_start, r.event_type): r.n for r in spark.table("prog_t").collect()}
    # windows still open at the end of the input are not emitted in append mode
    newest = table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    want = _buckets(table(spark, SF_SMALL, "events").where(F.date_trunc("hour", "ts") + F.expr("INTERVAL 2 HOURS") <= F.lit(newest)))
    assert got == want and got  # all files in one batch: no row is late


def _buckets(events):
    rows = events.groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("w"), "event_type").count()
    return {(r.w, r.event_type): r["count"] for r in rows.collect()}


def _land_newest_first(spark, scratch):
    """Events in four files, the newest rows in the first: one micro-batch each."""
    ev = table(spark, SF_SMALL, "events")
    src = os.path.join(scratch, "backwards")
    parts = ev.withColumn("_q", F.ntile(4).over(Window.partitionBy(F.lit(0)).orderBy(F.desc("ts"))))
    for k in range(1, 5):
        parts.where(F.col("_q") == k).drop("_q").repartition(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # files are read in the order of their times
    return src


def test_progress_without_watermark_counts_late_rows(spark, scratch):
    p = J.progress(J.events_stream(spark, _land_newest_first(spark, scratch), max_files=1), "event_type", "ts", delay=None)
    q = p.writeStream.format("memory").queryName("prog_all").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = {(r.window_start, r.event_type): r.n for r in spark.table("prog_all").collect()}
    assert got == _buckets(table(spark, SF_SMALL, "events"))


def test_progress_log_counts_late_rows(spark, scratch):
    metrics = os.path.join(scratch, "late")
    listener = J.ProgressLog(spark, metrics)
    spark.streams.addListener(listener)
    p = J.progress(J.events_stream(spark, _land_newest_first(spark, scratch), max_files=1), "event_type", "ts")
    q = p.writeStream.format("memory").queryName("prog_late").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    n = table(spark, SF_SMALL, "events").count()
    for _ in range(60):
        logged = spark.read.schema("input_rows BIGINT, late_rows BIGINT").json(metrics) if os.path.isdir(metrics) else None
        rows, late = logged.agg(F.sum("input_rows"), F.sum("late_rows")).first() if logged is not None else (0, 0)
        if rows == n:
            break
        time.sleep(0.5)
    spark.streams.removeListener(listener)
    assert rows == n and late > 0


def test_status_state_equals_batch(spark, scratch):
    src = _land(spark, scratch, "events")
    st = J.status_state(J.status_events(J.events_stream(spark, src, max_files=1)))
    q = st.writeStream.format("memory").queryName("state_t").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("state_t").groupBy("url").agg(F.max_by("status", "seq").alias("status"))
    want = U.latest(U.url_events(table(spark, SF_SMALL, "events")), "url", "seq", keep=["status"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("url", "status").collect()))


def test_foreach_batch_upsert(spark, scratch):
    from presslake.sources.sinks import read_versioned
    src = _land(spark, scratch, "events")
    tbl, ck = os.path.join(scratch, "tbl"), os.path.join(scratch, "ck2")
    q = J.upsert_each_batch(J.status_events(J.events_stream(spark, src, max_files=2)), tbl, ck)
    q.awaitTermination(300)
    got = read_versioned(spark, tbl).select("url", "status")
    want = U.latest(U.url_events(table(spark, SF_SMALL, "events")), "url", "seq", keep=["status"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("url", "status").collect()))


def test_live_counts(spark, scratch):
    src = _land(spark, scratch, "events")
    out = os.path.join(scratch, "live")
    q = J.live_counts(J.events_stream(spark, src), "event_type", out, os.path.join(scratch, "live-ck"), every="1 second")
    q.processAllAvailable()
    q.stop()
    got = {r.event_type: r.n for r in spark.read.parquet(out).collect()}
    want = {r.event_type: r["count"] for r in table(spark, SF_SMALL, "events").groupBy("event_type").count().collect()}
    assert got == want


def test_bounded_dedup(spark, scratch):
    src = _land(spark, scratch, "events")
    changes = J.status_events(J.events_stream(spark, src, max_files=1))
    # a delay longer than the data's time span behaves like the exact dedup
    d = J.dedup_urls(changes, "url", event_time="ts", delay="3650 days")
    q = d.writeStream.format("memory").queryName("bdedup_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    want = U.url_events(table(spark, SF_SMALL, "events")).select("url").distinct().count()
    assert spark.table("bdedup_t").count() == want


def test_progress_log_is_a_table(spark, scratch):
    src = _land(spark, scratch, "events")
    metrics = os.path.join(scratch, "metrics")
    listener = J.ProgressLog(spark, metrics)
    spark.streams.addListener(listener)
    q = J.status_events(J.events_stream(spark, src, max_files=1)).writeStream.format("noop").trigger(availableNow=True).start()
    q.awaitTermination(300)
    want = table(spark, SF_SMALL, "events").count()
    for _ in range(60):
        if os.path.isdir(metrics) and spark.read.schema("input_rows BIGINT").json(metrics).agg(F.sum("input_rows")).first()[0] == want:
            break
        time.sleep(0.5)
    spark.streams.removeListener(listener)
    assert spark.read.schema("input_rows BIGINT").json(metrics).agg(F.sum("input_rows")).first()[0] == want


def test_plateau_stream_equals_batch(spark, scratch):
    from presslake.operators.planning import plateau_stop
    ev = table(spark, SF_SMALL, "events").select("user_id", "event_id", F.floor("value").cast("bigint").alias("height"))
    src = os.path.join(scratch, "heights")
    cuts = ev.approxQuantile("event_id", [k / 4 for k in range(1, 4)], 0)
    for k in range(4):       # files land in order, one micro-batch each
        low, high = ([-1, *cuts][k], [*cuts, 1 << 60][k])
        ev.where((F.col("event_id") > low) & (F.col("event_id") <= high)).repartition(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = J.plateau_stream(stream, "user_id", "event_id", "height").writeStream.format("memory").queryName("plateau_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    want = plateau_stop(ev, "user_id", "event_id", "height")
    got = spark.table("plateau_t").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0


def test_upsert_writes_only_the_buckets_it_touches(spark, scratch):
    from presslake.sources import sinks
    path = os.path.join(scratch, "buckets")
    rows = lambda *r: spark.createDataFrame(list(r), "url string, status string, seq long")
    first = sinks.upsert_buckets(spark, path, rows(*((f"u{i}", "NEW", i) for i in range(200))), buckets=16)
    assert len(first) == 16 and "b7of16" in first
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    touched = sinks.upsert_buckets(spark, path, rows(("u7", "OKK", 500), ("u7", "ERR", 400), ("u8", "old", 1)), buckets=16)
    assert len(touched) <= 2
    changed = {f.split("key_bucket=")[1].split("/")[0] for f in before ^ files()}
    assert changed == set(touched)
    got = {r.url: (r.status, r.seq) for r in sinks.read_versioned(spark, path).collect()}
    assert len(got) == 200 and got["u7"] == ("OKK", 500) and got["u8"] == ("NEW", 8)
    assert sinks.upsert_buckets(spark, path, rows(), buckets=16) == []
    # a failing batch changes nothing; neither does one with another number of buckets
    before = files()
    bad = rows(("u9", "OKK", 900)).withColumn("status", F.raise_error(F.lit("broken")).cast("string"))
    for again in (lambda: sinks.upsert_buckets(spark, path, bad, buckets=16), lambda: sinks.upsert_buckets(spark, path, rows(*((f"u{i}", "X", 999) for i in range(200))), buckets=4)):
        try:
            again()
            raise SystemExit("must fail")
        except Exception:
            pass
    assert files() == before


def test_distinct_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 9_000).alias("k"))
    merged = U.merge_sketches(U.distinct_sketches(df, "k", ["day"])).first()
    assert abs(merged.n_estimate - 9_000) < 0.05 * 9_000
