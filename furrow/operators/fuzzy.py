"""Fuzzy name matching (§2.5 ``fuzzy_best_match``).

Names are normalised and de-duplicated (each distinct name is scored once),
and scored with Python's block-matching similarity ratio; if one contains the
other the score is at least 0.9. The candidate with the best (score,
preference) at or above the threshold wins, ties going to the smallest id.

Only pairs that can reach the threshold t are scored. For lengths n and m, let
S = n + m and M = ceil(t S / 2), the characters that must match:

* the matching blocks are at most S - 2M + 1, as an unmatched character
  stands between any two; so at least 3M - S - 1 bigrams match, or, where
  that is below one, M single characters.
* if T of the grams of both names match, the first |A| - T + 1 and
  |B| - T + 1 in any common order hold a matching one (all places of a gram
  count as one in the order). The order is rarest first, so frequent grams
  are hardly ever joined on. Names are joined on (n, m, gram).
* a matched character stands at most max(n, m) - M places apart in both names.
* n - M characters of the one and m - M of the other may be without a partner; a
  bit mask of each name's characters tells when more are.
* a contained name has all its trigrams in the other one: joined on its rarest.

All are necessary conditions, so the answer is that of scoring all pairs at
any size of either side.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.text import normalize_match_name
from furrow.session import ship_package, written_table

# Acceptance threshold and the containment score floor.
THRESHOLD = 0.78
CONTAINMENT_SCORE = 0.9


def score_names(a: str, b: str, threshold: float = 0.0) -> float:
    """Similarity of two names; 0 as soon as it can't reach ``threshold``."""
    if not a or not b:
        return 0.0
    m = difflib.SequenceMatcher(None, a, b)
    floor = CONTAINMENT_SCORE if a in b or b in a else 0.0
    if floor < threshold and (m.real_quick_ratio() < threshold or m.quick_ratio() < threshold):
        return 0.0
    return max(m.ratio(), floor)


def site_preference(name) -> Column:
    """Of equally similar sites: food-contact sites first, legs and bottom shelves last."""
    n = F.lower(name)
    return F.when(n.contains("fcs"), 3).when(n.contains("leg") | n.contains("bottom shelf"), 0).otherwise(2)


_SINGLE, _PAIR, _TRIPLE = 1, 2, 3


def _grams(c: Column, k: int) -> Column:
    """Array of (gram, place) of all substrings of length k; the gram carries its length."""
    n = F.length(c) - (k - 1)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.concat(F.lit(f"{k}|"), F.substr(c, i, F.lit(k))).alias("g"), i.alias("pos")))


def _mask(c: Column) -> Column:
    """64 bits, one for each hash of a character and the number of equal ones up to it."""
    chars = F.split(c, "")
    numbered = F.transform(chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda y: y == x)).cast("string")))
    one = F.lit(1).cast("long")
    return F.aggregate(numbered, F.lit(0).cast("long"),
                       lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))


def _ordered(side: DataFrame, frequency: DataFrame) -> DataFrame:
    """(_x, n, mask, k, size, g, pos, r): the grams of each name; ``size`` are of length k, and a gram is the r-th of them,
    rarest first (all places of a gram have the number of its first one)."""
    tokens = side.select("_x", F.explode(F.concat(*[_grams(F.col("_x"), k) for k in (_SINGLE, _PAIR, _TRIPLE)])).alias("t")).select("_x", "t.*")
    grams = F.sort_array(F.collect_list(F.struct("f", "g", "pos"))).alias("grams")  # as long as the name
    listed = tokens.join(frequency, "g").groupBy("_x", F.substr("g", F.lit(1), F.lit(1)).cast("int").alias("k")).agg(grams) \
        .select("_x", "k", F.length("_x").alias("n"), _mask(F.col("_x")).alias("mask"), F.size("grams").alias("size"),
                F.col("grams.g").alias("gs"), F.explode("grams").alias("t"))
    return listed.select("_x", "n", "mask", "k", "size", "t.g", "t.pos", F.array_position("gs", F.col("t.g")).alias("r"))


def _near_keys(side: DataFrame, lengths: DataFrame, threshold: float, swap: bool) -> DataFrame:
    """(_x, n, m, g, pos, mask, must): the grams of the prefix for each length of a partner that is near enough; mask of the
    name's characters and the number that must match."""
    lo = threshold / (2 - threshold)
    first, last = F.greatest(F.ceil(F.col("n") * lo - 1e-9), F.lit(1)).cast("int"), F.floor(F.col("n") / lo + 1e-9).cast("int")
    total = F.col("n") + F.col("m")
    out = side.where(F.col("k") != _TRIPLE).withColumn("m", F.explode(F.sequence(first, last))) \
        .withColumn("must", F.ceil(total * threshold / 2 - 1e-9).cast("int")).withColumn("pairs", F.col("must") * 3 - total - 1)
    shared = F.when(F.col("k") == _PAIR, F.col("pairs")).otherwise(F.col("must"))
    out = out.where(((F.col("k") == _PAIR) == (F.col("pairs") >= 1)) & (F.col("r") <= F.col("size") - shared + 1)).join(lengths, "m")
    own, partner = ("m", "n") if swap else ("n", "m")
    return out.select("_x", F.col("n").alias(own), F.col("m").alias(partner), "g", "pos", "mask", "must")


def _candidate_pairs(names: DataFrame, cands: DataFrame, threshold: float) -> DataFrame:
    """(_n, _c) pairs that may reach the threshold, each once."""
    both = {"_n": names.select(F.col("_n").alias("_x")), "_c": cands.select(F.col("_c").alias("_x"))}
    every = both["_n"].union(both["_c"]).select(F.explode(F.concat(*[_grams(F.col("_x"), k) for k in (_SINGLE, _PAIR, _TRIPLE)])).alias("t"))
    frequency = every.groupBy("t.g").agg(F.count(F.lit(1)).alias("f"))
    side = {c: written_table(_ordered(x, frequency), f"grams{c}") for c, x in both.items()}
    lengths = {c: x.select(F.col("n").alias("m")).distinct() for c, x in side.items()}
    a = _near_keys(side["_n"], lengths["_c"], threshold, swap=False).withColumnRenamed("_x", "_n")
    b = _near_keys(side["_c"], lengths["_n"], threshold, swap=True) \
        .select("n", "m", "g", F.col("_x").alias("_c"), F.col("pos").alias("pos_c"), F.col("mask").alias("mask_c"))
    possible = F.expr("abs(pos - pos_c) <= greatest(n, m) - must AND bit_count(mask & ~mask_c) <= n - must AND bit_count(mask_c & ~mask) <= m - must")
    near = a.join(b, ["n", "m", "g"]).where(possible).select("_n", "_c")

    def inside(inner: str, outer: str) -> DataFrame:
        # the contained name's rarest gram of three, or of all its characters, and all of those of the other
        rarest = side[inner].where((F.col("k") == F.least(F.col("n"), F.lit(_TRIPLE))) & (F.col("r") == 1))
        rarest = rarest.select(F.col("_x").alias(inner), "g").distinct()
        pieces = side[outer].select(F.col("_x").alias(outer), "g").distinct()
        return rarest.join(pieces, "g").where(F.contains(outer, inner)).select("_n", "_c")

    return near.union(inside("_c", "_n")).union(inside("_n", "_c")).distinct()


def fuzzy_best_match(df: DataFrame, name: str, candidates: DataFrame, cand_id: str, cand_name: str,
                     threshold: float = THRESHOLD, out: str = "match_id", prefer=None) -> DataFrame:
    """``df`` with the id of the best candidate, NULL where none reaches the
    threshold. ``prefer``: function of the candidate's name column giving the
    preference among equal scores (greater first)."""
    ship_package(df.sparkSession)
    raw = df.select(F.col(name).alias("_raw")).distinct().withColumn("_n", normalize_match_name(F.col("_raw")))
    names = raw.where("_n <> ''").select("_n").distinct()
    cands = candidates.select(F.col(cand_id).alias("_id"), normalize_match_name(F.col(cand_name)).alias("_c"),
                              (F.lit(0) if prefer is None else prefer(F.col(cand_name))).alias("_p")).where("_c <> ''")

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([score_names(x, y, threshold) for x, y in zip(a, b)], dtype="float64")

    scored = _candidate_pairs(names, cands.select("_c").distinct(), threshold).withColumn("_s", score("_n", "_c"))
    rank = F.struct((-F.col("_s")).alias("s"), (-F.col("_p")).alias("p"), F.col("_id").alias("i"))
    best = scored.where(F.col("_s") >= threshold).join(cands, "_c").groupBy("_n").agg(F.min_by("_id", rank).alias(out))
    matched = raw.join(best, "_n", "left").select(F.col("_raw").alias(name), out)
    return df.join(matched, df[name].eqNullSafe(matched[name]), "left").drop(matched[name])
