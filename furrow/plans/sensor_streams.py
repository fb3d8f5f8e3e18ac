"""Streaming queries (§2.14) over the given tables, landed as several files
the way polls leave them (events: org = user_id, channel = event_type,
reading time = ts). Each runs with ``availableNow``, one file per micro-batch,
and returns its sink contents, so it is checked against the equivalent batch
SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from furrow.plans.registry import register
from furrow.session import scratch_path
from furrow.sources.tables import Tables, table_path
from furrow.streaming import streams
from furrow.streaming.state import BucketedState

CHANNELS = ("view", "click", "purchase", "error", "signup")
FILES = 6


def _events_stream(spark, d):
    """The events table as a file stream (the landing folder of the polls);
    event time is cast to TIMESTAMP (UTC session) for the watermark."""
    schema = spark.read.parquet(table_path(d, "events")).schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(d)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _landed(df, arrival, n, name, schema):
    """``df`` landed as ``n`` polls and streamed, a poll per micro-batch."""
    files = streams.files_per_poll(df, n)
    path = streams.land(df, arrival, n, name, files)
    return df.sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _poll():
    """The poll in which an event is read: five days each."""
    return F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(FILES - 1)).cast("int")


def _polled_events(spark, d):
    """The events as polls land them: each poll reads the last three hours of the one before again."""
    ev = Tables(spark, d).events
    again = ev.where(F.hour("ts") >= 21).where(F.dayofmonth("ts") % 5 == 0).where(_poll() < FILES - 1).withColumn("poll", _poll() + 1)
    return _landed(ev.withColumn("poll", _poll()).unionByName(again), F.col("poll"), FILES, "polls", ev.schema).withColumn("ts", F.col("ts").cast("timestamp"))


@register("stream_ingest_dedup", "SELECT DISTINCT ON (user_id, ts) event_id, user_id, ts FROM events ORDER BY user_id, ts, event_id")
def q_stream_ingest_dedup(spark, d):
    s = _polled_events(spark, d).select("event_id", "user_id", "ts")
    out = streams.run_available_now(spark, streams.stream_ingest_dedup(s, ["user_id", "ts"], "ts"), "dedup")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# Increments whose next reading the watermark (newest reading - look-back) has passed.
_INCREMENTS_SQL = """
inc AS (SELECT user_id AS key, ts, value * ((epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6) AS increment, lead(ts) OVER w AS nxt
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, value)),
final AS (SELECT key, ts, increment FROM inc WHERE nxt <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 6 HOUR)"""


def _increments(spark, d):
    """The increments, landed by a stream of their own."""
    s = _events_stream(spark, d).select("user_id", "ts", "value")
    return streams.run_available_now(spark, streams.stream_next_interval(s, "user_id", "ts", "value"), "next_interval")


@register("stream_daily_dose", "WITH " + _INCREMENTS_SQL + """
SELECT key AS user_id, date_trunc('day', ts) AS day_start, ROUND(SUM(CAST(increment AS DECIMAL(28,6))), 2) AS daily_total FROM final
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM final) - INTERVAL 6 HOUR GROUP BY 1, 2""")
def q_stream_daily_dose(spark, d):
    landed = _increments(spark, d)
    path = landed.inputFiles()[0].rsplit("/", 1)[0]
    s = spark.readStream.schema(landed.schema).parquet(path).select("key", "ts", F.col("increment").cast("decimal(28,6)").alias("v"))
    out = streams.run_available_now(spark, streams.stream_daily_dose(s, ["key"], "ts", "v"), "daily")
    return out.select(F.col("key").alias("user_id"), F.col("day.start").cast("timestamp_ntz").alias("day_start"),
                      F.round("daily_total", 2).alias("daily_total"))


@register("stream_pivot", """
SELECT user_id, date_trunc('hour', ts) AS ts, """ + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{c}') AS {c}" for c in CHANNELS) + """
FROM events GROUP BY 1, 2 HAVING date_trunc('hour', any_value(ts)) <= (SELECT date_trunc('hour', max(ts)) FROM events) - INTERVAL 6 HOUR""")
def q_stream_pivot(spark, d):
    """Readings of a clock hour share its time, so that cells are written several times; polls repeat rows."""
    s = _polled_events(spark, d).select("event_id", "user_id", F.date_trunc("hour", "ts").alias("ts"), "event_type", "value")
    out = streams.run_available_now(spark, streams.stream_pivot(s, ["user_id"], "ts", "event_type", "value", CHANNELS, "event_id"), "pivot")
    return out.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), *CHANNELS)


@register("stream_next_interval", "WITH " + _INCREMENTS_SQL + " SELECT * FROM final")
def q_stream_next_interval(spark, d):
    return _increments(spark, d).select("key", F.col("ts").cast("timestamp_ntz").alias("ts"), "increment")


@register("stream_terminate", """
SELECT l_orderkey, min(l_shipdate) AS terminated_at, arg_min('discount on line ' || CAST(l_linenumber AS VARCHAR),
  (l_shipdate, 'discount on line ' || CAST(l_linenumber AS VARCHAR))) AS termination_reason
FROM lineitem WHERE l_discount > 0.08 GROUP BY 1""")
def q_stream_terminate(spark, d):
    """Lines land by ship date, some of them up to two days behind, and a heartbeat closes the stream; an order ships for
    at most 2,600 days."""
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_discount", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"))
    at = F.unix_timestamp("l_shipdate")
    lo, hi = li.agg(F.min(at), F.max(at)).first()
    seen = at + F.pmod("l_linenumber", F.lit(3)) * 86400
    poll = F.floor((seen - F.lit(lo)) / F.lit(hi - lo + 3 * 86400) * FILES).cast("int")
    beat = spark.range(1).select(F.lit(None).cast("long").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), F.lit(1.0).alias("l_discount"),
                                 F.timestamp_seconds(F.lit(hi + 6000 * 86400)).alias("l_shipdate"))
    lines = _landed(li.withColumn("poll", poll).unionByName(beat.withColumn("poll", F.lit(FILES))), F.col("poll"), FILES + 1, "lines", li.schema)
    ended = streams.stream_terminate(lines, "l_orderkey", "l_shipdate", F.col("l_discount") > 0.08,
                                     F.concat(F.lit("discount on line "), F.col("l_linenumber").cast("string")),
                                     keep=pd.Timedelta(days=2600), delay="10 days")
    out = streams.run_available_now(spark, ended, "terminate")
    return out.where(F.col("trial").isNotNull()).select(F.col("trial").alias("l_orderkey"), F.col("terminated_at").cast("timestamp_ntz").alias("terminated_at"),
                                                        "termination_reason")


@register("stream_upsert_parent_children", """
SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS l_quantity
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def q_stream_upsert_parent_children(spark, d):
    """All orders and lines are the state; the finished orders come again in several polls and replace their lines."""
    t = Tables(spark, d)
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    run = scratch_path(spark, f"stream-upsert-{uuid.uuid4().hex[:8]}")
    state = BucketedState(spark, f"{run}/state", orders.schema, lines.schema, ["o_orderkey"], ["l_orderkey"], buckets=16)
    state.seed(orders, lines)
    finished = _landed(orders.where("o_orderstatus = 'F'"), F.pmod("o_orderkey", F.lit(FILES)), FILES, "orders", orders.schema)

    def children_for(batch):
        return lines.join(batch.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").withColumn("l_quantity", F.col("l_quantity") + 1)

    streams.run_foreach_batch(finished, streams.upsert_state_handler(state, children_for), f"{run}/ckpt")
    return state.read("children")


# Every 23rd event comes two polls later than its time; what a poll brings is late if the polls before it have seen a
# reading more than the look-back newer.
_ROUTED_SQL = """
WITH landed AS (SELECT event_id, ts, least(5, (day(ts) - 1) // 5 + CASE WHEN event_id % 23 = 0 THEN 2 ELSE 0 END) AS poll FROM events),
newest AS (SELECT poll, max(ts) AS newest FROM landed GROUP BY 1),
marks AS (SELECT p.poll, (SELECT date_trunc('millisecond', max(newest)) - INTERVAL 6 HOUR FROM newest n WHERE n.poll < p.poll) AS mark FROM newest p)
SELECT event_id, ts{flag} FROM landed JOIN marks USING (poll){where}"""


def _routed(spark, d):
    ev = Tables(spark, d).events.select("event_id", "ts")
    poll = F.least(F.lit(FILES - 1), _poll() + F.when(F.col("event_id") % 23 == 0, 2).otherwise(0))
    s = _landed(ev.withColumn("poll", poll), F.col("poll"), FILES, "late", ev.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.run_available_now(spark, streams.stream_route_late(s, "ts"), "late").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_late_report", _ROUTED_SQL.format(flag="", where=" WHERE ts <= mark"))
def q_stream_late_report(spark, d):
    return _routed(spark, d).where("is_late").select("event_id", "ts")


@register("stream_route_late", _ROUTED_SQL.format(flag=", coalesce(ts <= mark, false) AS is_late", where=""))
def q_stream_route_late(spark, d):
    """Accepted and late rows: together every event once."""
    return _routed(spark, d).select("event_id", "ts", "is_late")
