"""Streams over many files: one row per trial, exact late rows, bucketed state with commits."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from furrow.session import scratch_path
from furrow.streaming import streams
from furrow.streaming.state import BucketedState

T0 = dt.datetime(2024, 1, 1)
OBS = "trial long, ts timestamp, bad boolean, why string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def landed(spark, polls, schema, name):
    rows = [(*r, i) for i, p in enumerate(polls) for r in p]
    df = spark.createDataFrame(rows, schema + ", poll int")
    path = streams.land(df, F.col("poll"), len(polls), name)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def ended(spark, polls, keep=48, lanes=8):
    s = landed(spark, polls, OBS, "trials")
    out = streams.stream_terminate(s, "trial", "ts", F.col("bad"), F.col("why"), keep=pd.Timedelta(hours=keep), lanes=lanes)
    run = scratch_path(spark, f"trials-{random.random()}")
    q = out.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(out.schema).parquet(f"{run}/out").collect()
    return sorted((r.trial, r.terminated_at.replace(tzinfo=None), r.termination_reason) for r in rows), q


def test_a_trial_ends_once(spark):
    polls = [
        [(1, at(10), True, "b"), (1, at(10), True, "a"), (2, at(9), False, "x"), (3, at(11), True, "late one"), (6, at(11), True, "six")],
        [(1, at(12), True, "again"), (3, at(8), True, "early one"), (4, at(20), True, "d")],  # out of order within six hours
        [(1, at(30), True, "again"), (4, at(31), True, "again"), (5, at(1), True, "too late"), (2, at(40), True, "first")],
        [(2, at(41), True, "again"), (9, at(400), True, "last")],
        [(2, at(401), True, "long after"), (9, at(2000), True, "again")],
    ]
    got, q = ended(spark, polls)
    want = [(1, at(10), "a"), (2, at(40), "first"), (2, at(401), "long after"), (3, at(8), "early one"), (4, at(20), "d"), (6, at(11), "six"),
            (9, at(400), "last")]
    assert got == want  # trial 2 is forgotten 48 hours after its end, so the failure of hour 401 is a new trial's
    assert ended(spark, polls, keep=10_000)[0] == [w for w in want if w[1] != at(401)]


def test_state_of_ended_trials_is_dropped(spark):
    polls = [[(i, at(i % 7), True, "x") for i in range(200)], [(500, at(100), True, "x")], [(501, at(300), True, "x")]]
    got, q = ended(spark, polls, lanes=1 << 20)
    assert len(got) == 201
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(sizes) >= 200 and sizes[-1] <= 2  # those that are still open


@pytest.mark.parametrize("seed", range(3))
def test_random_trials_over_split_files(spark, seed):
    rng = random.Random(seed)
    polls, newest, accepted = [], None, {}
    for i in range(6):
        poll = []
        for _ in range(60):
            h = i * 24 + rng.uniform(0, 24) - (rng.uniform(0, 60) if rng.random() < 0.2 else 0)
            poll.append((rng.randrange(25), at(0) + dt.timedelta(milliseconds=int(h * 3_600_000)), rng.random() < 0.5, rng.choice("abc")))
        mark = newest - dt.timedelta(hours=6) if newest else None
        for k, t, bad, why in poll:
            if bad and (mark is None or t > mark):
                accepted.setdefault(k, []).append((t, why))
        newest = max([newest or T0, *(t for _, t, bad, _ in poll if bad)])
        polls.append(poll)
    polls.append([(99, at(9000), True, "beat")])
    got, _ = ended(spark, polls, keep=24 * 10)
    # Spark compares with the mark of one batch before when it drops rows; an accepted failure is never later than ours
    assert [k for k, _, _ in got] == sorted(accepted)
    assert all((t, w) <= min(accepted[k]) for k, t, w in got)


@pytest.mark.parametrize("seed", range(3))
def test_accepted_and_late_are_all(spark, seed):
    rng = random.Random(seed)
    polls = [[(1000 * i + j, at(0) + dt.timedelta(milliseconds=int((i * 24 + rng.uniform(-40 if rng.random() < 0.3 else 0, 24)) * 3_600_000)))
              for j in range(80)] for i in range(5)]
    polls[2] = []
    s = landed(spark, polls, "id long, ts timestamp", "route")
    got = {r.id: r.is_late for r in streams.run_available_now(spark, streams.stream_route_late(s, "ts"), "route").collect()}
    want, newest = {}, None
    for p in polls:
        mark = newest and newest.replace(microsecond=newest.microsecond // 1000 * 1000) - dt.timedelta(hours=6)
        want |= {i: bool(mark and t <= mark) for i, t in p}
        newest = max([t for _, t in p] + ([newest] if newest else []), default=None)
    assert got == want and any(want.values()) and not all(want.values())


def test_last_write_wins(spark):
    polls = [[(1, T0, "a", 5.0, 3), (1, T0, "a", 9.0, 1), (1, T0, "b", 2.0, 2)], [(1, T0, "a", 1.0, 4), (2, T0, "b", None, 9), (2, T0, "b", 4.0, 8)],
             [(3, at(100), "a", 0.0, 10)]]
    s = landed(spark, polls, "k long, ts timestamp, ch string, v double, seq long", "pivot")
    out = streams.run_available_now(spark, streams.stream_pivot(s, ["k"], "ts", "ch", "v", ["a", "b"], "seq"), "pivot")
    assert {r.k: (r.a, r.b) for r in out.collect()} == {1: (1.0, 2.0), 2: (None, None)}


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_bucketed_state(spark):
    parents = spark.createDataFrame([(i, f"p{i}") for i in range(200)], "k long, v string")
    children = spark.createDataFrame([(i % 210, n, float(i)) for i in range(300) for n in range(2)], "fk long, n int, q double")
    folder = scratch_path(spark, f"state-{random.random()}")

    def open_state():
        return BucketedState(spark, folder, parents.schema, children.schema, ["k"], ["fk"], buckets=8)

    state = open_state()
    state.seed(parents, children)
    want_p = dict(r for r in parents.collect())
    want_c = sorted(tuple(r) for r in children.collect())
    state.seed(parents.limit(1), children)  # there is a state already

    def check():
        s = open_state()
        assert {r.k: r.v for r in s.read("parents").collect()} == want_p
        assert sorted(tuple(r) for r in s.read("children").collect()) == want_c

    check()
    batches = [[(3, "new"), (500, "x")], [], [(3, "newer"), (7, None)], [(i, "all") for i in range(0, 200, 9)]]
    for b, batch in enumerate(batches):
        new = spark.createDataFrame(batch, parents.schema)
        kids = spark.createDataFrame([(k, 9, -1.0) for k, _ in batch if k != 7], children.schema)  # 7 loses its children
        before = files(folder)
        open_state().apply(new, kids, b)
        after = files(folder)
        assert before.items() <= after.items()  # no file is rewritten
        want_p |= dict(batch)
        keys = {k for k, _ in batch}
        want_c = sorted([c for c in want_c if c[0] not in keys] + [(k, 9, -1.0) for k in keys if k != 7])
        check()
        open_state().apply(new, kids.limit(0), b)  # replayed, even with other rows
        assert batch == [] or files(folder) == after
        check()
    # one parent touches one bucket: the others' files are still those of their last change
    state = open_state()
    commits = state._commits()
    before = state._versions(commits[max(commits)])
    state.apply(spark.createDataFrame([(3, "last")], parents.schema), spark.createDataFrame([], children.schema), 50)
    after = state._versions(state._commits()[50])
    changed = {(kind, b) for kind in after for b in before[kind] if before[kind][b] != after[kind].get(b)}
    assert len({b for _, b in changed}) == 1


def test_an_uncommitted_try_is_not_seen(spark):
    parents = spark.createDataFrame([(1, "a")], "k long, v string")
    children = spark.createDataFrame([(1, 2)], "fk long, n int")
    folder = scratch_path(spark, f"state-{random.random()}")
    state = BucketedState(spark, folder, parents.schema, children.schema, ["k"], ["fk"], buckets=2)
    state.seed(parents, children)
    state._write("parents", spark.createDataFrame([(1, "half")], parents.schema), 0)  # the batch fails before its commit
    assert [r.v for r in state.read("parents").collect()] == ["a"]
    state.apply(spark.createDataFrame([(1, "b")], parents.schema), children, 0)
    assert [r.v for r in state.read("parents").collect()] == ["b"]
    with pytest.raises(ValueError):
        BucketedState(spark, folder, parents.schema, spark.createDataFrame([], "fk int").schema, ["k"], ["fk"])


def test_stream_of_many_batches_equals_one(spark):
    parents = spark.createDataFrame([(i, "old") for i in range(50)], "k long, v string")
    children = spark.createDataFrame([(i, 0) for i in range(50)], "fk long, n int")
    state = BucketedState(spark, scratch_path(spark, f"state-{random.random()}"), parents.schema, children.schema, ["k"], ["fk"], buckets=4)
    state.seed(parents, children)
    polls = [[(k, f"poll {i}") for k in range(i, 50, 3)] for i in range(3)] + [[(0, "poll 3")]]
    s = landed(spark, polls, "k long, v string", "parents")
    handler = streams.upsert_state_handler(state, lambda b: b.select(F.col("k").alias("fk"), F.length("v").alias("n")))
    streams.run_foreach_batch(s, handler, scratch_path(spark, f"ckpt-{random.random()}"))
    want = {k: v for p in polls for k, v in p}
    assert {r.k: r.v for r in state.read("parents").collect()} == want
    assert {r.fk: r.n for r in state.read("children").collect()} == {k: len(v) for k, v in want.items()}


def test_large_polls_land_as_several_files_each(spark, monkeypatch):
    """A poll is written and read by several tasks and still is one micro-batch, also after polls of one row or none."""
    monkeypatch.setattr(streams, "LANDED_ROWS", 30, raising=False)
    polls = [[(i, j) for j in range(n)] for i, n in enumerate([200, 1, 0, 150, 2])]
    df = spark.createDataFrame([x for p in polls for x in p], "poll int, v int")
    files = streams.files_per_poll(df, 5)
    path = streams.land(df, F.col("poll"), 5, "several", files)
    assert files == 3 and len(spark.read.parquet(path).inputFiles()) == 15
    got = {}

    def batch(b, batch_id):
        got[batch_id] = sorted((r.poll, r.v) for r in b.collect())

    streams.run_foreach_batch(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path), batch, scratch_path(spark, f"ckpt-{random.random()}"))
    assert [got[i] for i in sorted(got)] == polls
