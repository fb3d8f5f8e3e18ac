"""Window-style operators (§2.7).

Where the result is one row per key (first, last, latest) the operators
aggregate with ``min_by`` over an order struct instead of ranking inside
a window: the partial aggregate runs map-side, so a key holding a third
of all rows is reduced before the shuffle. Windows are kept only where
every row needs a per-key neighbour (lag / lead / running totals), and
those windows are partitioned by bounded keys (key + day bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.operators._order import rank_struct, window_order


def _first_by(df: DataFrame, keys, order, reverse: bool) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    r = rank_struct(df, order, reverse=reverse)
    agg = F.min_by(F.struct(*[F.col(c) for c in payload]), r).alias("_row")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """First-seen row per key (the ``seen`` set rule) in ``order``."""
    return _first_by(df, keys, order, reverse=False)


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """Last-wins row per key (dict assignment rule) in ``order``."""
    return _first_by(df, keys, order, reverse=True)


def latest_snapshot(df: DataFrame, keys, order) -> DataFrame:
    """``DISTINCT ON (keys) ORDER BY keys, <order>``; order like ['-date', '-created']."""
    return _first_by(df, keys, order, reverse=False)


def current_previous_period(df: DataFrame, date_col: str) -> DataFrame:
    """One row (cur_date, prev_date): the newest and second-newest distinct
    dates. Two aggregates instead of an unpartitioned DENSE_RANK window."""
    cur = df.agg(F.max(date_col).alias("cur_date"))
    return cur.select(
        "cur_date",
        df.where(F.col(date_col) < cur.select("cur_date").scalar()).select(F.max(date_col)).scalar().alias("prev_date"),
    )


def period_number(df: DataFrame, date_col: str, out: str = "pp", year_col: str = "year") -> DataFrame:
    """DENSE_RANK of dates within their year, computed on the distinct
    (year, date) set (at most 366 rows per year) and joined back."""
    dates = df.select(F.year(date_col).alias(year_col), F.col(date_col)).distinct()
    ranked = dates.withColumn(out, F.dense_rank().over(Window.partitionBy(year_col).orderBy(date_col)))
    return df.withColumn(year_col, F.year(date_col)).join(ranked, [year_col, date_col], "left")


def lead_interval(df: DataFrame, by, ts: str, value: str, out: str = "dli", scale: float = 1e6,
                  bucket: str = "day") -> DataFrame:
    """value x seconds to the next reading of the same key / ``scale``; the
    last reading of a key gets 0 (left Riemann sum).

    The window is partitioned by (key, time bucket), so a key with a third
    of all rows is still spread across many tasks; the next reading of the
    last row in a bucket comes from the first reading of the next non-empty
    bucket, found on the small (key, bucket) table.
    """
    keys = list(by)
    b = F.date_trunc(bucket, F.col(ts))
    d = df.withColumn("_bucket", b)
    w = Window.partitionBy(*keys, "_bucket").orderBy(ts)
    d = d.withColumn("_next", F.lead(ts).over(w))
    firsts = d.groupBy(*keys, "_bucket").agg(F.min(ts).alias("_first"))
    wb = Window.partitionBy(*keys).orderBy("_bucket")
    nxt = firsts.select(*keys, "_bucket", F.lead("_first").over(wb).alias("_next_bucket_first"))
    d = d.join(nxt, [*keys, "_bucket"], "left")
    nxt_ts = F.coalesce(F.col("_next"), F.col("_next_bucket_first"))
    secs = F.timestamp_diff("MICROSECOND", F.col(ts), nxt_ts)
    val = F.coalesce(F.col(value) * (secs / 1e6) / F.lit(scale), F.lit(0.0))
    return d.withColumn(out, val).drop("_bucket", "_next", "_next_bucket_first")


def window_total_status(df: DataFrame, by, value: str, threshold, out_total: str = "week_total",
                        out_status: str = "status") -> DataFrame:
    """Per-group total attached to every row plus above / at / below a
    threshold (column name or number). Aggregate + join, not a window, so
    the total is combined map-side."""
    tot = df.groupBy(*by).agg(F.sum(value).alias(out_total))
    thr = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    j = df.join(tot, list(by), "left")
    return j.withColumn(
        out_status,
        F.when(F.col(out_total) > thr, "above").when(F.col(out_total) == thr, "at").otherwise("below"),
    )


def cumulative_to_delta(df: DataFrame, by, order, cum: str, out: str = "delta") -> DataFrame:
    """max(0, cum - previous cum) within (by) in ``order``; NULL cells are
    dropped first so they do not move the previous value."""
    d = df.where(F.col(cum).isNotNull())
    w = Window.partitionBy(*by).orderBy(*([order] if isinstance(order, str) else order))
    prev = F.lag(cum).over(w)
    return d.withColumn(out, F.greatest(F.col(cum) - F.coalesce(prev, F.lit(0)), F.lit(0)))


def dup_suffix(df: DataFrame, code: str, order, sep: str = "_", out: str | None = None) -> DataFrame:
    """2nd, 3rd, ... row of a duplicate code gets '_2', '_3' in ``order``."""
    out = out or code
    w = Window.partitionBy(code).orderBy(*window_order(order))
    rn = F.row_number().over(w)
    return df.withColumn(out, F.when(rn > 1, F.concat(F.col(code), F.lit(sep), rn.cast("string"))).otherwise(F.col(code)))


def dup_name_suffix(df: DataFrame, by, name: str, code: str, out: str | None = None) -> DataFrame:
    """Every member of a colliding (by, name) group gets ' (code)'."""
    out = out or name
    counts = df.groupBy(*by, name).agg(F.count(F.lit(1)).alias("_n"))
    j = df.join(counts, [*by, name], "left")
    return j.withColumn(
        out, F.when(F.col("_n") > 1, F.concat(F.col(name), F.lit(" ("), F.col(code).cast("string"), F.lit(")"))).otherwise(F.col(name))
    ).drop("_n")


def first_last_active(df: DataFrame, by, order: str, value: str) -> DataFrame:
    """First and last ``order`` value with a positive measure per group."""
    pos = F.col(value) > 0
    return df.groupBy(*by).agg(
        F.min(F.when(pos, F.col(order))).alias("first_active"),
        F.max(F.when(pos, F.col(order))).alias("last_active"),
    )


def attach_once(df: DataFrame, by, order, c: str) -> DataFrame:
    """Keep ``c`` only on the first row of each group (NULL elsewhere)."""
    w = Window.partitionBy(*by).orderBy(*window_order(order))
    return df.withColumn(c, F.when(F.row_number().over(w) == 1, F.col(c)))


def gap_days(df: DataFrame, by, date: str, out: str = "gap_days", tie=()) -> DataFrame:
    """Days since the previous date of the same key (``tie`` orders equal dates)."""
    w = Window.partitionBy(*by).orderBy(date, *tie)
    return df.withColumn(out, F.datediff(F.col(date), F.lag(date).over(w)))


def first_nonblank(df: DataFrame, by, order: str, c: str, last: bool = False, out: str | None = None) -> DataFrame:
    """First (or last) non-blank value of ``c`` per group in ``order``."""
    out = out or c
    ok = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    val = F.when(ok, F.col(c))
    ordv = F.when(ok, F.col(order))
    fn = F.max_by if last else F.min_by
    return df.groupBy(*by).agg(fn(val, ordv).alias(out))


def row_number_within(df: DataFrame, by, order, out: str = "rn") -> Column:
    w = Window.partitionBy(*by).orderBy(*window_order(order))
    return df.withColumn(out, F.row_number().over(w))


# ---------------------------------------------------------------------------
# Skew-safe per-key sequence operators.
#
# A window partitioned only by a key sends a key holding a third of all rows
# to one task. These helpers partition by (key, bucket), where the bucket is a
# caller-supplied expression that is monotone in the order (a month of the
# first order column, an integer range of a numeric key, ...), and carry the
# state across buckets through a small per-(key, bucket) table.
# ---------------------------------------------------------------------------


def prev_value(df: DataFrame, by, order, c: str, bucket, out: str = "prev") -> DataFrame:
    """Value of ``c`` on the previous row of the same key in ``order``."""
    keys = list(by)
    d = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*window_order(order))
    d = d.withColumn("_rn", F.row_number().over(w)).withColumn("_lag", F.lag(c).over(w))
    last = d.groupBy(*keys, "_b").agg(F.max_by(F.col(c), rank_struct(d, order)).alias("_last"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    carry = last.select(*keys, "_b", F.lag("_last").over(wb).alias("_carry"))
    d = d.join(carry, [*keys, "_b"], "left")
    return d.withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag"))).drop("_b", "_rn", "_lag", "_carry")


def row_number_bucketed(df: DataFrame, by, order, bucket, out: str = "rn") -> DataFrame:
    """1-based row number per key in ``order``: number inside the bucket
    plus the row count of the key's earlier buckets."""
    keys = list(by)
    d = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*window_order(order))
    d = d.withColumn("_rnb", F.row_number().over(w))
    counts = d.groupBy(*keys, "_b").agg(F.max("_rnb").alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    return d.join(offs, [*keys, "_b"], "left").withColumn(out, F.col("_rnb") + F.col("_off")).drop("_b", "_rnb", "_off")


def gap_days_bucketed(df: DataFrame, by, date: str, bucket, out: str = "gap_days", tie=()) -> DataFrame:
    """``gap_days`` with the per-key window split by ``bucket``."""
    p = prev_value(df, by, [date, *tie], date, bucket, out="_prev_d")
    return p.withColumn(out, F.datediff(F.col(date), F.col("_prev_d"))).drop("_prev_d")


def dup_suffix_bucketed(df: DataFrame, code: str, order, bucket, sep: str = "_", out: str | None = None) -> DataFrame:
    """``dup_suffix`` with the per-code numbering split by ``bucket``."""
    out = out or code
    r = row_number_bucketed(df, [code], order, bucket, out="_rn")
    return r.withColumn(out, F.when(F.col("_rn") > 1, F.concat(F.col(code), F.lit(sep), F.col("_rn").cast("string"))).otherwise(F.col(code))).drop("_rn")


def attach_once_bucketed(df: DataFrame, by, order, c: str, bucket) -> DataFrame:
    """``attach_once`` without a whole-key window: the first row per key is
    the ``min_by`` of an order struct, joined back by that struct."""
    r = rank_struct(df, order)
    firsts = df.groupBy(*by).agg(F.min(r).alias("_first"))
    d = df.withColumn("_me", r).join(firsts, list(by), "left")
    return d.withColumn(c, F.when(F.col("_me") == F.col("_first"), F.col(c))).drop("_me", "_first")


def value_runs(df: DataFrame, by, number: str, values, span: int = 1000) -> DataFrame:
    """Maximal runs of consecutive ``number`` values (unique per ``by``) with
    equal ``values``: by, ``number``_from, ``number``_to, n, values. A number less
    its rank among the rows of equal values is the same all along a run; ranks
    are counted per ``span`` of numbers, so a long key is spread over tasks. The
    input is read twice: pass a written table if it is costly."""
    same = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    ranked = row_number_bucketed(df.withColumn("_same", same), [*by, "_same"], [number], F.floor(F.col(number) / span), out="_rn")
    runs = ranked.groupBy(*by, "_same", (F.col(number) - F.col("_rn")).alias("_run")).agg(
        F.min(number).alias(f"{number}_from"), F.max(number).alias(f"{number}_to"), F.count(F.lit(1)).alias("n"),
        *[F.first(v).alias(v) for v in values])
    return runs.drop("_same", "_run")
