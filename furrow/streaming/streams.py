"""Structured Streaming versions of the sensor and event paths (§2.14).

The source system polls a sensor API every few minutes with a six-hour
look-back and ignores duplicate (org, reading time) rows. Here the landed
files are a streaming source; duplicates are dropped within the
watermark, channels are pivoted per reading, daily doses are tumbling
windows, the "value x time to next reading" increment is a stateful
operator that keeps a key's readings only until the watermark has passed
them, and the end of a trial is a stateful operator that emits once and
forgets the trial when its time is over.

All sinks are file sinks / ``foreachBatch`` writes under the shared
checkpoint folder (``spark.checkpoint.dir``), so a restarted query resumes
from its checkpoint after an executor or driver loss.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from furrow.session import scratch_path, ship_package
from furrow.streaming.state import BucketedState

# Fixed value: the source's poll look-back, used as the lateness bound.
LOOKBACK = "6 hours"


def stream_ingest_dedup(sdf: DataFrame, keys, ts: str, delay: str = LOOKBACK) -> DataFrame:
    """Exactly one row per key despite overlapping polls."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_pivot(sdf: DataFrame, by, ts: str, channel: str, value: str, channels, written: str, delay: str = LOOKBACK) -> DataFrame:
    """Long channel readings -> one wide row per (key, timestamp); of several
    readings of a cell the last write wins, the one with the greatest
    ``written``; rows are final once the watermark passes."""
    w = sdf.withWatermark(ts, delay)
    aggs = [F.max_by(F.when(F.col(channel) == c, F.col(value)), F.when(F.col(channel) == c, F.col(written))).alias(c) for c in channels]
    return w.groupBy(*by, ts).agg(*aggs)


def stream_daily_dose(sdf: DataFrame, by, ts: str, value: str, delay: str = LOOKBACK) -> DataFrame:
    """Tumbling one-day windows of the increment column, final once the
    watermark has passed the day's end."""
    w = sdf.withWatermark(ts, delay)
    return w.groupBy(*by, F.window(ts, "1 day").alias("day")).agg(F.sum(value).alias("daily_total"))


def _next_interval_state(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
    """Per key: readings wait in state, in order, until the watermark has
    passed them and no reading can come between any more; then each is paired
    with its successor. What stays is the last reading behind the watermark
    and those ahead of it, so at most the look-back's readings."""
    times, values = [[np.asarray(x, kind)] for x, kind in zip(state.get if state.exists else ((), ()), ("int64", "float64"))]
    mark = state.getCurrentWatermarkMs() * 1000
    for p in pdfs:
        t = pd.to_datetime(p["ts"]).astype("datetime64[us]").astype("int64").to_numpy()
        v = p["value"].astype("float64").to_numpy()
        fresh = t > mark  # older ones are in the late report
        times.append(t[fresh])
        values.append(v[fresh])
    t, v = np.concatenate(times), np.concatenate(values)
    order = np.lexsort((v, t))
    t, v = t[order], v[order]
    final = int(np.searchsorted(t, mark, side="right"))
    n = max(0, final - 1)
    if n:
        yield pd.DataFrame({"key": [key[0]] * n, "ts": pd.to_datetime(t[:n], unit="us"), "increment": v[:n] * ((t[1:n + 1] - t[:n]) / 1e6)})
    t, v = t[n:], v[n:]
    state.update((t.tolist(), v.tolist()))
    ahead = t[t > mark]
    if len(ahead):
        state.setTimeoutTimestamp(int(ahead[0] // 1000) + 1)


def stream_next_interval(sdf: DataFrame, key: str, ts: str, value: str, delay: str | None = LOOKBACK) -> DataFrame:
    """value x seconds to the next reading of the same key, emitted once the
    watermark has passed the next reading. Readings that come out of order
    within the look-back take their place; older ones are left to
    ``late_report_handler``. ``delay`` None: ``sdf`` has a watermark already."""
    ship_package(sdf.sparkSession)
    x = sdf.select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"))
    if delay is not None:
        x = x.withWatermark("ts", delay)
    return x.groupBy("key").applyInPandasWithState(
        _next_interval_state, outputStructType="key long, ts timestamp, increment double",
        stateStructType="ts array<long>, value array<double>", outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout)


def _terminate_state(keep_us: int):
    """The trials of a lane. Failures wait until the watermark has passed them, so that no earlier one can come any more; the
    first of a trial is then emitted, and those within ``keep_us`` after it are of the same trial. What waits is a trial's
    earliest failure ahead of the watermark and those that may belong to a later trial; what stays of an ended trial is its
    end, until the watermark has passed the time in which its failures can come."""
    def order(failure):
        return failure[0], failure[1] or ""

    def step(_, pdfs: Iterator[pd.DataFrame], state: GroupState):
        ended_trials, ends, trials, times, reasons = state.get if state.exists else ((),) * 5
        end = dict(zip(ended_trials, ends))
        waiting: dict = {}
        for k, t, why in zip(trials, times, reasons):
            waiting.setdefault(k, set()).add((t, why))
        for p in pdfs:
            keys = [None if pd.isna(k) else int(k) for k in p["trial"]]
            for k, t, why in zip(keys, p["ts"].astype("datetime64[us]").astype("int64").tolist(), p["reason"]):
                waiting.setdefault(k, set()).add((t, why))
        mark = state.getCurrentWatermarkMs() * 1000
        out, left = [], []
        for k, failures in waiting.items():
            last = end.get(k)
            ahead = []
            for t, why in sorted(failures, key=order):
                if last is not None and t <= last + keep_us:
                    continue
                if t <= mark:
                    out.append((k, t, why))
                    last = t
                else:
                    ahead.append((k, t, why))
            if last is not None:
                end[k] = last
            left += ahead[:1] + [x for x in ahead[1:] if x[1] > mark + keep_us]
        if out:
            yield pd.DataFrame({"trial": pd.array([x[0] for x in out], "Int64"), "terminated_at": pd.to_datetime([x[1] for x in out], unit="us"),
                                "termination_reason": [x[2] for x in out]})
        end = {k: t for k, t in end.items() if t + keep_us > mark}
        if not end and not left:
            if state.exists:
                state.remove()
            return
        state.update((list(end), list(end.values()), *([x[i] for x in left] for i in range(3))))
        state.setTimeoutTimestamp(max(min([x[1] for x in left] + [t + keep_us for t in end.values()]), mark) // 1000 + 1)
    return step


def stream_terminate(sdf: DataFrame, trial: str, ts: str, failed, reason, keep: pd.Timedelta, delay: str = LOOKBACK,
                     lanes: int = 256) -> DataFrame:
    """First failing observation per trial: one row (trial, terminated_at,
    termination_reason), emitted when the watermark has passed it (of equal
    times the least reason). Failures that come out of order within ``delay``
    count; later failures of an ended trial are ignored for ``keep`` after its
    end, the longest that a trial goes on, and then the trial's state is
    dropped. ``trial`` is a long. Trials share ``lanes`` state entries, so that a
    micro-batch makes few Python calls; an entry holds the open and lately
    ended trials of its lane."""
    ship_package(sdf.sparkSession)
    x = sdf.where(failed).select(F.col(trial).alias("trial"), F.col(ts).alias("ts"), reason.alias("reason")).withWatermark("ts", delay)
    return x.withColumn("_lane", F.pmod(F.xxhash64("trial"), F.lit(lanes))).groupBy("_lane").applyInPandasWithState(
        _terminate_state(int(keep / pd.Timedelta(microseconds=1))),
        outputStructType="trial long, terminated_at timestamp, termination_reason string",
        stateStructType="ended_trial array<long>, ended array<long>, trial array<long>, ts array<long>, reason array<string>",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def stream_route_late(sdf: DataFrame, ts: str, delay: str = LOOKBACK, late: str = "is_late", lanes: int = 64) -> DataFrame:
    """Every row with ``late``: was its time at or behind the query's own
    watermark when it came? Rows pass through ``lanes`` groups without any
    state; accepted and late rows are together all rows."""
    ship_package(sdf.sparkSession)
    columns = sdf.columns

    def route(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        mark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        for p in pdfs:
            yield p[columns].assign(**{late: p[ts] <= mark})

    x = sdf.withWatermark(ts, delay).withColumn("_lane", F.pmod(F.xxhash64(*columns), F.lit(lanes)))
    out = T.StructType([*sdf.schema.fields, T.StructField(late, T.BooleanType())])
    return x.groupBy("_lane").applyInPandasWithState(route, outputStructType=out, stateStructType="unused int", outputMode="append",
                                                     timeoutConf=GroupStateTimeout.NoTimeout)


def upsert_state_handler(state: BucketedState, children_for):
    """``foreachBatch`` handler: each micro-batch of new parent rows upserts
    the parents and replaces the children of every touched parent in the
    buckets they fall into; a replayed batch changes nothing."""
    def handler(batch: DataFrame, batch_id: int):
        state.apply(batch, children_for(batch), batch_id)

    return handler


def run_foreach_batch(sdf: DataFrame, handler, checkpoint: str) -> int:
    """Run a ``foreachBatch`` handler over everything available; returns
    the id of the last micro-batch (-1 when none ran)."""
    q = sdf.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    ids = [p["batchId"] for p in q.recentProgress if p.get("numInputRows", 0) > 0]
    return max(ids) if ids else -1


# Rows of a landed file.
LANDED_ROWS = 1_000_000


def files_per_poll(df: DataFrame, n: int) -> int:
    """How many files each of ``n`` polls of ``df`` takes, to be written and read in parallel."""
    return max(1, -(-df.count() // (n * LANDED_ROWS)))


def land(df: DataFrame, arrival, n: int, name: str, files: int = 1) -> str:
    """Write ``df`` as ``n`` polls, one after the other, by the number 0 .. n - 1 in ``arrival``: the folder that a polled
    source leaves. Each poll has ``files`` files, empty ones if need be, so that a stream with as many files per trigger
    takes poll after poll in that order."""
    spark = df.sparkSession
    path = scratch_path(spark, f"landed-{name}-{uuid.uuid4().hex[:8]}")
    none = spark.createDataFrame([], df.schema).coalesce(1)
    for i in range(n):
        poll = df.where(arrival == i)
        (poll.coalesce(1) if files == 1 else poll.repartition(files)).write.mode("append").parquet(path)
        for _ in range(files * (i + 1) - len(spark.read.schema(df.schema).parquet(path).inputFiles()) if files > 1 else 0):
            none.write.mode("append").parquet(path)
    return path


def run_available_now(spark: SparkSession, sdf: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming plan over everything available and return the sink
    contents as a batch DataFrame (sink and checkpoint under the shared
    checkpoint folder)."""
    run = scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:8]}")
    out, ckpt = f"{run}/out", f"{run}/ckpt"
    if mode == "append":
        q = sdf.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append") \
            .trigger(availableNow=True).start()
    else:
        def write(batch: DataFrame, batch_id: int):
            batch.write.mode("overwrite").parquet(out)

        q = sdf.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)
