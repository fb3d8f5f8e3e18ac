"""Operators behind the load jobs, against plain Python; what a green row can't show."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import setops
from furrow.operators import windows as win
from furrow.plans import jobs_events, jobs_rotation


@pytest.mark.parametrize("after,until", [("2026-03-20", "2027-01-01"), ("2020-01-01", "2026-06-30"), ("2026-03-15", "2026-03-15"), ("2027-01-01", "2026-01-01")])
def test_rotation_calendar(spark, after, until):
    slots = spark.createDataFrame([(i,) for i in range(1, 13)] + [(20,)], "slot int")
    got = sorted((r.slot, r.d) for r in rs.rotation_calendar(slots, "slot", 8, "2026-03-15", 12, after, until, "d").collect())
    want = []
    for slot in [*range(1, 13), 20]:
        d = dt.date(2026, 3, 15) + dt.timedelta(weeks=(slot - 8) % 12)
        while d <= dt.date.fromisoformat(until):
            if d > dt.date.fromisoformat(after):
                want.append((slot, d))
            d += dt.timedelta(weeks=12)
    assert got == sorted(want)


def test_typed_events_are_numbered_within_the_record(spark):
    df = spark.createDataFrame([(1, 2.0, None, 5), (2, 0.0, -1.0, None), (3, None, 7.0, 1)], "k int, a double, b double, c int")
    got = rs.typed_events(df, ["k"], [("A", F.col("a"), "l", {"x": F.lit("p")}), ("B", F.col("b"), "h", {"x": F.lit(None).cast("string")}),
                                      ("C", F.col("c"), "l", {"x": F.lit("q")})], "volume")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, "A", "l", "p", 2.0), (1, 2, "C", "l", "q", 5.0), (3, 1, "B", "h", None, 7.0), (3, 2, "C", "l", "q", 1.0)]


@pytest.mark.parametrize("seed", range(3))
def test_first_key_that_matches(spark, seed):
    rng = random.Random(seed)
    pick = lambda xs: rng.choice([None, *xs])
    rows = [(i, pick(["a", "b"]), pick(["1", "1|1"]), pick("xy")) for i in range(200)]
    targets = [(i, pick(["a", "b", "c"]), pick(["1", "1|1"]), pick("xy"), i % 7) for i in range(40)]
    cols = [["p", "q"], ["p", "r"], ["r"]]
    levels = [[F.lit(i), *[F.col(c) for c in k]] for i, k in enumerate(cols)]
    df = spark.createDataFrame(rows, "id int, p string, q string, r string").withColumn("_target", F.lit("kept"))
    got = jn.prioritised_match(df, "id", levels, spark.createDataFrame(targets, "t int, p string, q string, r string, o int"), levels, "t", ["o", "t"], "hit", "level")
    want = []
    for row in rows:
        vals, best = dict(zip("_pqr", row)), (None, None)
        for i, k in enumerate(cols):
            if any(vals[c] is None for c in k):
                continue
            hits = [(t[4], t[0]) for t in targets if all(dict(zip("_pqr", t))[c] == vals[c] for c in k)]
            if hits:
                best = (min(hits)[1], i)
                break
        want.append((*row, "kept", *best))
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_runs_of_equal_values(spark, span):
    rng = random.Random(span)
    rows = [(s, n, rng.choice([None, "a"]), rng.choice([1, 1, 2])) for s in (1, 2) for n in range(60) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "site int, n int, v string, w int")
    got = sorted(((r.site, r.n_from, r.n_to, r.n, r.v, r.w) for r in win.value_runs(df, ["site"], "n", ["v", "w"], span).collect()), key=lambda r: r[:2])
    want = []
    for s, n, v, w in sorted(rows, key=lambda r: r[:2]):
        if want and want[-1][0] == s and want[-1][2] == n - 1 and want[-1][4:] == (v, w):
            want[-1] = (s, want[-1][1], n, want[-1][3] + 1, v, w)
        else:
            want.append((s, n, n, 1, v, w))
    assert got == want


def test_changes_applied_leave_none(spark):
    rng = random.Random(4)
    make = lambda: spark.createDataFrame([(i, "m", rng.choice([None, True, False]), rng.randrange(2)) for i in range(60) if rng.random() < 0.7],
                                         "k int, m string, a boolean, b int")
    old, new = make(), make()
    keys, cols = ["k", "m"], ["a", "b"]
    changes = setops.set_changes(old, new, keys, cols)
    assert {r.op for r in changes.collect()} == {"insert", "update", "delete"}
    after = setops.apply_changes(old, changes, keys, cols)
    assert sorted(map(str, after.collect())) == sorted(map(str, new.select(*keys, *cols).collect()))
    assert setops.set_changes(after, new, keys, cols).collect() == [] == setops.set_changes(old, old, keys, cols).collect()


def test_codes_that_are_no_cycles_make_no_stub(spark):
    harvest = spark.createDataFrame([(i, c) for i, c in enumerate([" s-240301k", "240301K", "241301K", "240309K", "2403HIE", "24031K", None, "x", "S-7003koj", "240302J"])], "i int, code string")
    got = {r.code: (r.site_id, r.variety, r.seeding_date, r.notes) for r in
           jobs_rotation.stub_batches(harvest, spark.createDataFrame([("240302j",)], "code string"), "code", ["i"]).collect()}
    assert got == {"240301K": ("01", "K", dt.date(2024, 3, 1), "stub for cycle code S-240301K"), "2403HIE": ("hi", "E", dt.date(2024, 3, 1), "stub for cycle code 2403HIE"),
                   "7003KOJ": ("ko", "J", dt.date(1970, 3, 1), "stub for cycle code S-7003KOJ")}


def test_shared_bags_are_halved_and_rounded_to_even(spark):
    rows = spark.createDataFrame([("s", "K", None, 5, 4), ("s", "K", "J", 5, 4), ("s", "J", "E", 7, 5), ("s", "E", None, 9, 6), ("s", None, None, 9, 4), ("s", "K", None, None, 4)],
                                 "site_id string, plan_1 string, plan_2 string, bags_per_row2 int, plants_per_bag2 int")
    got = {r.variety: (r.seeds, r.rows_4_per_bag, r.rows_5_per_bag) for r in jobs_rotation.planned_seeds(rows).collect()}
    assert got == {"K": (20 + 10, 5 + 2, 0), "J": (10 + 17, 2, 4), "E": (17, 0, 4)}


def test_events_know_their_tracker(spark):
    from furrow.plans import catalog

    q, sf = catalog.queries(), "/root/testdata/sf0.001"
    trackers = q["etl_fertigation_trackers"](spark, sf)
    events = q["etl_fertigation_events"](spark, sf)
    assert events.join(trackers, "tracker_id", "left_anti").count() == 0 and trackers.count() == trackers.select("tracker_id").distinct().count()


def test_every_action_is_linked_or_left_out(spark):
    from furrow.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    kept, out = jobs_events.corrective_actions(jobs_events.raw_actions(t), jobs_events.raw_entries(t), jobs_events.link_targets(t))
    n = t.events.where("event_type = 'error'").count()
    assert kept.count() + out.count() == n and kept.select("event_id").union(out.select("event_id")).distinct().count() == n


def test_reading_the_oracles_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) > 300 and len(e.oracle_sql()) > 300"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
