"""Prices without fan-out, packing in blocks, stored formulas of any number of keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from furrow.functions.formula import formula_eval, formula_join
from furrow.operators import sales

D0 = dt.date(2024, 1, 1)
PRICES = "product int, customer_id long, group_id string, price double, effective_from date, effective_to date"
LINES = "line int, product int, customer long, grp string, d date"


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def resolve(lines, prices):
    out = []
    for line, product, customer, grp, d in lines:
        best = None
        for p, c, g, price, lo, hi in prices:
            if p != product or d is None or not (lo <= d and (hi is None or d <= hi)):
                continue
            tier = 3 if c is not None else 2 if g is not None else 1
            if (tier == 3 and c != customer) or (tier == 2 and g != grp):
                continue
            if best is None or (tier, lo, price) > best:
                best = (tier, lo, price)
        out.append((line, best and best[2], best and {3: "customer", 2: "group", 1: "default"}[best[0]]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_prices_are_the_brute_force(spark, seed):
    rng = random.Random(seed)
    prices = []
    for _ in range(150):
        tier, lo = rng.randrange(3), rng.randrange(60)
        prices.append((rng.randrange(4), rng.randrange(6) if tier == 0 else None, rng.choice("AB") if tier == 1 else None,
                       float(rng.randrange(1, 9)), day(lo), day(rng.choice([None, lo, lo + 5, lo + 40, lo - 3]))))
    lines = [(i, rng.randrange(5), rng.choice([None, *range(7)]), rng.choice([None, "A", "B", "C"]), day(rng.choice([None, *range(-3, 90)])))
             for i in range(300)]
    lines += lines[:5]
    df = spark.createDataFrame(lines, LINES).withColumn("_d", F.lit("kept")).withColumn("price", F.lit(0))
    got = sales.price_resolution(df, spark.createDataFrame(prices, PRICES), ["line"], "product", "customer", "grp", "d")
    assert got.columns == [*df.columns, "price_per_case", "price_tier"]
    assert sorted((r.line, r.price_per_case, r.price_tier) for r in got.collect()) == resolve(lines, prices)


def test_lines_of_a_hot_product_meet_no_other_customers_prices(spark):
    """20,000 lines of one product with 3,000 customer prices: questions, not lines, meet prices, each its own scope."""
    lines = spark.range(20_000).select(F.col("id").cast("int").alias("line"), (F.col("id") * 0 + 7).cast("int").alias("product"),
                                       (F.col("id") % 3000).alias("customer"), F.substring(F.concat(F.lit("A"), F.col("id")), 1, 1).alias("grp"), F.date_add(F.lit(D0), (F.col("id") % 50).cast("int")).alias("d"))
    prices = spark.range(3000).select(F.lit(7).alias("product"), F.col("id").alias("customer_id"), F.lit(None).cast("string").alias("group_id"),
                                      F.col("id").cast("double").alias("price"), F.lit(D0).alias("effective_from"), F.lit(None).cast("date").alias("effective_to"))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sales.price_resolution(lines, prices, ["line"], "product", "customer", "grp", "d")
        assert got.where("price_per_case <> customer OR price_tier <> 'customer'").count() == 0 and got.count() == 20_000
        plan = got._jdf.queryExecution().executedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join" in x]
        # scope (the one product is folded away) and date, one answer each: no fan-out
        assert len(joins) == 3 and all("_d#" in x for x in joins) and sum("_who#" in x for x in joins) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


@pytest.mark.parametrize("split", [None, sales.BALANCED_SPLIT, {5: 2, 3: 1}])
def test_transitions_compose_to_the_walk(split):
    rng = random.Random(3)
    for _ in range(30):
        most = rng.choice([1, 4, 7, 66, 90])
        lines = [(rng.choice([1, 3, 5, 12, 72, 78, 84, 200]), most if rng.random() < 0.8 else rng.randrange(1, most + 1)) for _ in range(12)]
        cuts = sorted(rng.sample(range(13), 3))
        blocks = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, 12])]
        pallet, held = 0, 0
        for block in blocks:
            walk = sales.Packing(split, pallet, held)
            for q, m in block:
                list(walk.take(q, m))
            opened, after = sales.transition(block, most, split)
            pallet, held = pallet + int(opened[held]), int(after[held])
            assert (pallet, held) == (walk.pallet, walk.held) or (pallet, held) == (walk.pallet + 1, 0) == (pallet, walk.held - walk.held)
        whole = sales.Packing(split)
        for q, m in lines:
            list(whole.take(q, m))
        assert (pallet, held) == (whole.pallet, whole.held)


FUL = "farm string, customer int, product int, pack_date date, qty long, max_cases long, full_cases long, stackable boolean, family string, line int, " \
      "special boolean"


def special_rows(seed, n=400):
    rng = random.Random(seed)
    sizes = {p: rng.choice([50, 61, 66]) for p in range(3)}
    return [("F", rng.choice([None, 1, 2]), p, day(rng.randrange(0, 25)), rng.choice([1, 7, 30, 72, 78, 84, 144]), sizes[p], 40, True, "cucumber", i, True)
            for i in range(n) for p in [rng.choice([0, 0, 0, 1, 2])]]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_rows", [0, 60, 10**6])
def test_blocks_pack_as_one_walk(spark, seed, block_rows):
    rows = special_rows(seed)
    f = spark.createDataFrame(rows, FUL).repartition(5)
    _, alloc = sales.palletize(f, ["farm"], ["customer", "product"], "pack_date", "qty", "max_cases", "full_cases", "stackable", ["line"],
                               special="special", block_rows=block_rows)
    want = []
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[2]), []).append(r)
    for g in groups.values():
        walk = sales.Packing(sales.BALANCED_SPLIT)
        for r in sorted(g, key=lambda r: (r[3], r[9])):
            want += [(r[9], p, c) for p, c in walk.take(r[4], r[5])]
    assert sorted((r.line, r.pallet_index, r.allocated_quantity) for r in alloc.collect()) == sorted(want)


def test_bad_maxima_are_left_to_the_report(spark):
    rows = [("F", 1, 1, D0, 10, m, 5, True, "cucumber", i, s) for i, (m, s) in enumerate([(0, False), (None, False), (-3, True), (0, True), (8, False), (8, True)])]
    f = spark.createDataFrame(rows, FUL)
    pallets, alloc = sales.palletize(f, ["farm"], ["customer", "product"], "pack_date", "qty", "max_cases", "full_cases", "stackable", ["line"], special="special")
    assert {r.line for r in alloc.collect()} == {4, 5} and pallets.count() > 0
    got = {r.line: (r.allocated, r.status) for r in sales.allocation_reconcile(alloc, f, ["line"], "allocated_quantity", "qty").collect()}
    assert got == {i: (10, "ok") if i > 3 else (0, "mismatch") for i in range(6)}
    with pytest.raises(ValueError):
        list(sales.Packing().take(1, 0))


def test_formulas_are_joined(spark):
    """100,000 keys over 50 formulas: no key in the plan, one branch per formula."""
    config = spark.range(100_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.concat(F.lit("ROUND(a * "), F.col("id") % 50, F.lit(") + b")).alias("f"))
    config = config.unionAll(spark.createDataFrame([("k1", "b"), (None, "a"), ("none", None)], "key string, f string"))
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") * 101).alias("key"), F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    got = formula_join(df, config, "key", "f", {"a": "a", "b": "b"}, "v")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WHEN") <= 51 and "k99999" not in plan
    assert {r.key: r.v for r in got.collect()} == {f"k{i * 101}": (float(round(i * (i * 101 % 50))) + 1 if i * 101 < 100_000 else None) for i in range(1000)}
    small = spark.createDataFrame([("x", "a + b"), ("y", "ROUND(a / 4)")], "key string, f string")
    rows = spark.createDataFrame([("x", 1.0, 2.0), ("y", 10.0, 0.0), ("z", 1.0, 1.0), (None, 1.0, 1.0)], "key string, a double, b double")
    a = {r.key: r.v for r in formula_join(rows, small, "key", "f", {"a": "a", "b": "b"}, "v").collect()}
    assert a == {r.key: r.v for r in rows.select("key", formula_eval(rows, small, "key", "f", {"a": "a", "b": "b"}).alias("v")).collect()}
    with pytest.raises(ValueError):
        formula_join(rows, spark.createDataFrame([("x", "a; drop")], "key string, f string"), "key", "f", {"a": "a"}, "v")
    with pytest.raises(ValueError):
        formula_join(rows, spark.range(1001).select(F.lit("x").alias("key"), F.concat(F.lit("a+"), F.col("id")).alias("f"))
                     .withColumn("key", F.col("f")), "key", "f", {"a": "a"}, "v")
