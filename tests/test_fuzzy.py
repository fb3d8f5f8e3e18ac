"""The matcher's candidate pairs: complete at any threshold, and few."""

import random

import pytest
from pyspark.sql import functions as F

from furrow.operators import fuzzy
from furrow.operators.fuzzy import fuzzy_best_match, score_names

FIRST = "north south upper lower green house packing river valley mountain station harvest cold dry wet long short".split()
LAST = "table shelf drain floor wall scale belt knife door fan pump tank valve tray bin cart lift rack".split()


def site_names(n, seed=1):
    rng = random.Random(seed)
    return sorted({f"{rng.choice(FIRST)} {rng.choice(FIRST)} {rng.choice(LAST)} {rng.randrange(100)}" for _ in range(n)})


def broken(rng, s):
    s = list(s)
    for _ in range(rng.randrange(4) if s else 0):
        i = rng.randrange(len(s) or 1)
        s[i:i + 1] = rng.choice([[], ["x"], s[i:i + 1] * 2])
    return "".join(s).strip() or "a"


@pytest.mark.parametrize("threshold", [0.5, 0.78, 1.0])
def test_all_pairs_at_the_threshold_are_candidates(spark, threshold):
    rng = random.Random(int(threshold * 100))
    word = lambda: "".join(rng.choices("aab cé", k=rng.randrange(1, 16))).strip() or "b"
    cands = {word() for _ in range(70)} | set(site_names(20)) | {"a", "ab", "abc", "x" * 230}
    names = {word() for _ in range(50)} | {broken(rng, c) for c in cands for _ in range(2)} | {"x" * 220 + "ab"}
    n, c = spark.createDataFrame([(x,) for x in names], "_n string"), spark.createDataFrame([(x,) for x in cands], "_c string")
    got = [(r._n, r._c) for r in fuzzy._candidate_pairs(n, c, threshold).collect()]
    assert {(a, b) for a in names for b in cands if score_names(a, b) >= threshold} <= set(got) and len(got) == len(set(got))


def bigram_pairs(names, cands):
    grams = lambda x: [x[i:i + 2] for i in range(len(x) - 1)]
    count = {}
    for side, xs in enumerate((names, cands)):
        for x in xs:
            for g in set(grams(x)):
                count.setdefault(g, [0, 0])[side] += 1
    return sum(a * b for a, b in count.values())


def test_few_pairs_are_scored(spark):
    cands = site_names(4000)
    rng = random.Random(7)
    names = sorted({broken(rng, c) for c in cands[::4]})
    n, c = spark.createDataFrame([(x,) for x in names], "_n string"), spark.createDataFrame([(x,) for x in cands], "_c string")
    pairs = fuzzy._candidate_pairs(n, c, fuzzy.THRESHOLD).count()
    assert pairs * 20 < bigram_pairs(names, cands)


def test_no_names(spark):
    some = spark.createDataFrame([("abc",)], "name string")
    none = spark.createDataFrame([], "id int, cand string")
    assert [r.match_id for r in fuzzy_best_match(some, "name", none, "id", "cand").collect()] == [None]
    blank = spark.createDataFrame([(1, " "), (2, None)], "id int, cand string")
    assert [r.match_id for r in fuzzy_best_match(some, "name", blank, "id", "cand").collect()] == [None]
    assert fuzzy_best_match(some.where(F.lit(False)), "name", none, "id", "cand").collect() == []


def test_given_names_equal_scoring_all_pairs(spark):
    from furrow.plans import catalog

    sf = "/root/testdata/sf0.01"
    dim = {}
    for r in spark.read.parquet(f"{sf}/part.parquet").select("p_name", "p_partkey").collect():
        dim[r.p_name] = min(r.p_partkey, dim.get(r.p_name, r.p_partkey))
    got = {r.name: r.match_id for r in catalog.queries()["fuzzy_best_match"](spark, sf).collect()}
    want = {}
    for name in dim:
        x = name.replace("e", "")
        best, key = min((-score_names(x, c), k) for c, k in dim.items())
        want["GH - " + x.upper()] = key if -best >= fuzzy.THRESHOLD else None
    assert got == want
