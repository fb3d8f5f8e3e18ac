"""Aggregations (§2.6). All are ``groupBy().agg()`` plans with partial
(map-side) aggregation; pivots always take an explicit value list so no
extra distinct job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.operators._order import rank_struct


def group_sum(df: DataFrame, by, cols, dtype: str | None = None) -> DataFrame:
    def s(c):
        x = F.col(c) if dtype is None else F.col(c).cast(dtype)
        return F.sum(x).alias(c)

    return df.groupBy(*by).agg(*[s(c) for c in cols])


def group_max_min(df: DataFrame, by, mx=(), mn=()) -> DataFrame:
    return df.groupBy(*by).agg(
        *[F.max(c).alias(f"max_{c}") for c in mx], *[F.min(c).alias(f"min_{c}") for c in mn]
    )


def agg_of_agg(df: DataFrame, by1, aggs1, by2, aggs2) -> DataFrame:
    """Two-stage aggregation: ``aggs1`` per ``by1``, then ``aggs2`` per ``by2``."""
    return df.groupBy(*by1).agg(*aggs1).groupBy(*by2).agg(*aggs2)


def sum_product(df: DataFrame, by, a: str, b: str, default=1, out: str = "total", as_int: bool = True) -> DataFrame:
    """sum(a x coalesce(b, default)); NUMERIC::int rounds, so round before cast."""
    v = F.sum(F.col(a) * F.coalesce(F.col(b), F.lit(default)))
    return df.groupBy(*by).agg((F.round(v).cast("long") if as_int else v).alias(out))


def count_per_key(base: DataFrame, facts: DataFrame, by, out: str = "n") -> DataFrame:
    """Count facts per key of ``base``; keys without facts keep 0."""
    counts = facts.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
    return base.join(counts, list(by), "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def count_distinct(df: DataFrame, by, c: str, out: str = "n_distinct") -> DataFrame:
    return df.groupBy(*by).agg(F.countDistinct(c).alias(out))


def agg_filter(df: DataFrame, by, c: str, cond, fn=F.max, out: str | None = None) -> DataFrame:
    """``MAX(c) FILTER (WHERE cond)``."""
    return df.groupBy(*by).agg(fn(F.when(cond, F.col(c))).alias(out or c))


def pivot_weekday(df: DataFrame, by, dow: str, text: str, prefix: str = "d") -> DataFrame:
    """Seven conditional-max columns (Sunday = 0 ... Saturday = 6)."""
    aggs = [F.max(F.when(F.col(dow) == i, F.col(text))).alias(f"{prefix}{i}") for i in range(7)]
    return df.groupBy(*by).agg(*aggs)


def pivot_channels(df: DataFrame, by, channel: str, value: str, channels, order: str) -> DataFrame:
    """Long (key, channel, value) -> one wide row per key; last write wins
    per cell (``max_by`` on the arrival order)."""
    aggs = [F.max_by(F.when(F.col(channel) == ch, F.col(value)), F.when(F.col(channel) == ch, F.col(order))).alias(ch)
            for ch in channels]
    return df.groupBy(*by).agg(*aggs)


def any_value_dims(df: DataFrame, by, cols, sums=()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.max(c).alias(c) for c in cols], *[F.sum(c).alias(c) for c in sums])


def group_header_first(df: DataFrame, by, order, cols) -> DataFrame:
    """Header per group with the attributes of its first line in ``order``."""
    r = rank_struct(df, order)
    return df.groupBy(*by).agg(F.min_by(F.struct(*cols), r).alias("_h")).select(*by, *[F.col("_h")[c].alias(c) for c in cols])


def merge_lines_sum(df: DataFrame, by, qty, first_cols, order) -> DataFrame:
    """Duplicate lines in one order: quantities summed, other attributes of
    the first line."""
    r = rank_struct(df, order)
    aggs = [F.sum(q).alias(q) for q in qty] + [F.min_by(F.struct(*first_cols), r).alias("_f")]
    return df.groupBy(*by).agg(*aggs).select(*by, *qty, *[F.col("_f")[c].alias(c) for c in first_cols])


def any_flag_status(df: DataFrame, by, any_true: dict, all_true: dict, default: str) -> DataFrame:
    """Status label from "any line satisfies" / "all lines satisfy" rules,
    checked in the given order."""
    aggs = {}
    for label, cond in any_true.items():
        aggs[f"_any_{label}"] = F.max(cond.cast("int"))
    for label, cond in all_true.items():
        aggs[f"_all_{label}"] = F.min(cond.cast("int"))
    g = df.groupBy(*by).agg(*[v.alias(k) for k, v in aggs.items()])
    status = None
    for label in any_true:
        cond = F.col(f"_any_{label}") == 1
        status = F.when(cond, label) if status is None else status.when(cond, label)
    for label in all_true:
        cond = F.col(f"_all_{label}") == 1
        status = F.when(cond, label) if status is None else status.when(cond, label)
    status = status.otherwise(default)
    return g.select(*by, status.alias("status"))


def day_leftover_rollup(df: DataFrame, by, cols) -> DataFrame:
    """Sums per day; emit the day only if any sum is positive."""
    g = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cols])
    anypos = None
    for c in cols:
        cond = F.coalesce(F.col(c) > 0, F.lit(False))
        anypos = cond if anypos is None else (anypos | cond)
    return g.where(anypos)


def mode_per_key(df: DataFrame, by, c: str, default=None, out: str | None = None) -> DataFrame:
    """Most frequent value per key (ties: smallest value); two-stage count
    so no per-key value map is held."""
    out = out or c
    counts = df.where(F.col(c).isNotNull()).groupBy(*by, c).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v"))
    best = counts.groupBy(*by).agg(F.min_by(F.col(c), rank).alias(out))
    if default is not None:
        best = best.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return best


def collect_children(df: DataFrame, by, fields, out: str = "children", order=None) -> DataFrame:
    """Parent -> sorted array of child structs (nested output only; each
    parent's children are a bounded line list)."""
    s = F.struct(*([F.col(o) for o in (order or [])] + [F.col(f) for f in fields]))
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(s)).alias(out))


# Mean-gap bands (days, inclusive) of recurring orders.
CADENCE_BANDS = ((5, 9, "Weekly"), (12, 16, "Biweekly"), (25, 35, "Monthly"))


def interval_regularity(df: DataFrame, by, date: str, min_n: int = 3, bands=CADENCE_BANDS, after=None) -> DataFrame:
    """Orders per key (only those after ``after`` when given): with at
    least ``min_n`` orders, the mean gap between consecutive order dates
    -> Weekly / Biweekly / Monthly, NULL when irregular. The mean of
    consecutive gaps telescopes to (last - first) / (n - 1), so this is a
    partial aggregate, not a per-key window."""
    x = df.select(*by, F.col(date).cast("date").alias("_d"))
    if after is not None:
        x = x.where(F.col("_d") > F.lit(after).cast("date"))
    g = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n_orders"), F.min("_d").alias("first_date"), F.max("_d").alias("last_date"))
    mean_gap = F.datediff("last_date", "first_date") / (F.col("n_orders") - 1)
    label = None
    for lo, hi, name in bands:
        cond = (mean_gap >= lo) & (mean_gap <= hi)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    return g.where(F.col("n_orders") >= min_n).withColumn("mean_gap_days", F.round(mean_gap, 4)).withColumn("cadence", label)


def block_extent(df: DataFrame, site: str, block: str, order, value: str, first_seen, bucket=None) -> DataFrame:
    """Per (site, block): min / max value, block number by first appearance
    within the site, direction Forward when ascending steps (in ``order``)
    are at least the descending ones. The step counts compare neighbours in
    a window per (block, ``bucket``) - a column that doesn't fall along the
    order - with the last row of the bucket before; block numbering ranks the
    small (site, block) table."""
    from pyspark.sql import Window

    from furrow.operators.windows import prev_value

    df = prev_value(df, [site, block], list(order), value, F.lit(0) if bucket is None else bucket, out="_prev")
    prev = F.col("_prev")
    steps = df.select(site, block, value, *[F.col(o.lstrip("-")) for o in first_seen if o.lstrip("-") not in (site, block, value)],
                      F.when(F.col(value) > prev, 1).otherwise(0).alias("_up"), F.when(F.col(value) < prev, 1).otherwise(0).alias("_down"))
    r = rank_struct(steps, first_seen)
    g = steps.groupBy(site, block).agg(F.min(value).alias("row_from"), F.max(value).alias("row_to"), F.sum("_up").alias("_up"),
                                       F.sum("_down").alias("_down"), F.min(r).alias("_first"))
    g = g.withColumn("block_number", F.dense_rank().over(Window.partitionBy(site).orderBy("_first")))
    return g.select(site, block, "block_number", "row_from", "row_to",
                    F.when(F.col("_up") >= F.col("_down"), "Forward").otherwise("Reverse").alias("direction"))


def planned_capacity(df: DataFrame, by, cell: str, measure: str, sep: str = "/") -> DataFrame:
    """Per (by, variety): measure and row count; a pair cell 'A/B' splits
    50/50 between its two varieties (exact DECIMAL shares)."""
    parts = F.split(F.col(cell), sep)
    n = F.size(parts)
    share = F.lit(1).cast("decimal(10,4)") / n.cast("decimal(10,4)")
    x = df.select(*by, F.col(measure).cast("decimal(18,4)").alias("_m"),
                  F.explode(F.transform(parts, lambda v: F.struct(F.trim(v).alias("variety"), share.cast("decimal(10,4)").alias("share")))).alias("_v"))
    return x.groupBy(*by, F.col("_v.variety").alias("variety")).agg(
        F.sum(F.col("_m") * F.col("_v.share")).cast("decimal(18,4)").alias(measure), F.sum("_v.share").cast("decimal(18,4)").alias("rows"))


def daily_packer_rollup(df: DataFrame, day: str, product_cols: dict, reporter: str, order) -> DataFrame:
    """Per-packer rows with one column per product -> (day, product) totals
    and the first reporter of the day (in ``order``); zero totals dropped."""
    arr = F.array(*[F.struct(F.lit(p).alias("product"), F.col(c).alias("qty")) for p, c in product_cols.items()])
    long = df.select(day, reporter, *[F.col(o.lstrip("-")) for o in order if o.lstrip("-") not in (day, reporter)],
                     F.explode(arr).alias("_p")).select("*", "_p.product", "_p.qty").drop("_p")
    r = rank_struct(long, order)
    g = long.groupBy(day, "product").agg(F.sum("qty").alias("total"), F.min_by(F.col(reporter), r).alias("first_reporter"))
    return g.where(F.col("total") > 0)


def alloc_proportional(totals: DataFrame, weights: DataFrame, on, share_key: str, weight: str, measures,
                       fallback_key: str, scale: int = 2, zero_total_keep=()) -> DataFrame:
    """Split each total row across ``weights`` rows by their share of the
    per-total weight sum (exact half-away-from-zero rounding; weights count with all decimals of their type, floats
    with nine); rows without
    weights keep the total under ``fallback_key``. Measures in
    ``zero_total_keep`` keep the full amount when the weight sum is 0
    (others become 0). Weights are pre-aggregated per (on, share_key) so
    the join fans out only to distinct accounts, never to raw rows."""
    from furrow.functions.arith import share_round

    w = weights.groupBy(*on, share_key).agg(F.sum(weight).alias(weight))
    wsum = w.groupBy(*on).agg(F.sum(weight).alias("_wtotal"))
    with_w = totals.join(w, list(on), "inner").join(wsum, list(on), "inner")
    without = totals.join(wsum.select(*on), list(on), "left_anti").withColumn(share_key, F.col(fallback_key)) \
        .withColumn(weight, F.lit(0).cast(w.schema[weight].dataType)).withColumn("_wtotal", F.lit(None).cast(wsum.schema["_wtotal"].dataType))
    out = with_w.unionByName(without.select(*with_w.columns))
    dec = f"decimal(18,{scale})"
    kind = weights.schema[weight].dataType
    weight_scale = kind.scale if isinstance(kind, T.DecimalType) else 9 if isinstance(kind, T.FractionalType) else 0
    for m in measures:
        alloc = (F.when(F.col("_wtotal").isNull(), F.col(m).cast(dec))
                 .when(F.col("_wtotal") > 0, share_round(F.col(m), F.col(weight), F.col("_wtotal"), scale, weight_scale))
                 .otherwise(F.col(m).cast(dec) if m in zero_total_keep else F.lit(0).cast(dec)))
        out = out.withColumn(m, alloc.cast(dec))
    return out.drop("_wtotal")


def delta_residual(df: DataFrame, measures, cur_prefix: str = "c_", prev_prefix: str = "p_", suffix: str = "_delta") -> DataFrame:
    """current - previous per measure with NULL as 0."""
    return df.withColumns({
        f"{m}{suffix}": F.coalesce(F.col(cur_prefix + m), F.lit(0)) - F.coalesce(F.col(prev_prefix + m), F.lit(0))
        for m in measures
    })


def load_counters(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(reason).agg(F.count(F.lit(1)).alias("n_rows"))


def json_agg_rows(df: DataFrame, by=None, order=None, page_size: int = 1000, bucket=None, out: str = "rows_json") -> DataFrame:
    """Rows -> JSON array text per group (``by``), in pages of at most
    ``page_size`` rows (``page`` column, 0-based, in ``order``), so a group
    holding a third of all rows never becomes one array in one task; the
    page numbers come from the bucketed row number (``bucket`` monotone in
    ``order``). Without ``by`` each row is rendered as its own JSON object."""
    payload = [c for c in df.columns if not by or c not in by]
    if not by:
        return df.select(F.to_json(F.struct(*payload)).alias(out))
    from furrow.operators._order import rank_struct
    from furrow.operators.windows import row_number_bucketed, row_number_within

    order = list(order or payload)
    numbered = row_number_bucketed(df, by, order, bucket, out="_rn") if bucket is not None else row_number_within(df, by, order, out="_rn")
    paged = numbered.withColumn("page", ((F.col("_rn") - 1) / page_size).cast("long"))
    r = rank_struct(paged, order)
    return paged.groupBy(*by, "page").agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(r.alias("_k"), F.struct(*payload).alias("_v")))), lambda x: x["_v"])).alias(out))
