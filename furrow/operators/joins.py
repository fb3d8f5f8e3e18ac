"""Joins (§2.5).

Dimension lookups are written as plain left joins: with AQE on, Spark
replaces the sort-merge join by a broadcast hash join only when the
measured size of the dimension after its stage is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; a dimension that grows
past it keeps the shuffle join. Explicit ``broadcast()`` is used only for
inputs whose size is fixed by construction (literal tables).

Theta joins are rewritten into equi-joins by a bounded fan-out (days of a
period, levels up to the caller's level, prefixes of a code), so no plan
here contains a cartesian product or a nested-loop join over fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.operators.windows import keep_first, keep_last


def _norm(c):
    """Lower case without white space (of any kind) at the ends."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def lookup_join(df: DataFrame, dim: DataFrame, on: str, dim_key: str, take, on_duplicate: str = "first",
                order=None, normalise: bool = True, priority=None) -> DataFrame:
    """Many-to-one lookup by (normalised) key; misses give NULL. Duplicate
    dimension keys are resolved explicitly: first / last in ``order``, or
    ``priority`` = (column, [preferred values in rank order]) - e.g. the
    preferred item category - with ``order`` breaking ties."""
    extra = [o.lstrip("-") for o in (order or [])]
    if priority is not None:
        extra.append(priority[0])
    d = dim.select(F.col(dim_key), *[F.col(t) for t in take], *[F.col(c) for c in dict.fromkeys(extra) if c not in take and c != dim_key])
    d = d.withColumn("_lk", _norm(F.col(dim_key).cast("string")) if normalise else F.col(dim_key))
    d = d.where(F.col("_lk").isNotNull())
    if on_duplicate == "priority":
        pcol, ranked = priority
        pos = F.array_position(F.array(*[F.lit(v) for v in ranked]), F.col(pcol))  # 0 when absent
        rank = F.when(F.coalesce(pos, F.lit(0)) == 0, F.lit(len(ranked) + 1)).otherwise(pos)
        d = keep_first(d.withColumn("_prio", rank.cast("long")), ["_lk"], ["_prio", *(order or [dim_key])])
    else:
        d = (keep_first if on_duplicate == "first" else keep_last)(d, ["_lk"], order or [dim_key])
    d = d.select("_lk", *take)
    left = df.withColumn("_lk", _norm(F.col(on).cast("string")) if normalise else F.col(on))
    return left.join(d, "_lk", "left").drop("_lk")


def cascade_lookup(df: DataFrame, steps, out: str) -> DataFrame:
    """Try key 1, then key 2, ...: ``steps = [(dim, left_col, dim_key, value)]``;
    the first hit by priority wins."""
    cur = df
    outs = []
    for i, (dim, left_col, dim_key, value) in enumerate(steps):
        d = dim.select(_norm(F.col(dim_key).cast("string")).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        d = d.where(F.col(f"_k{i}").isNotNull()).groupBy(f"_k{i}").agg(F.min(f"_v{i}").alias(f"_v{i}"))
        cur = cur.withColumn(f"_k{i}", _norm(F.col(left_col).cast("string"))).join(d, f"_k{i}", "left").drop(f"_k{i}")
        outs.append(F.col(f"_v{i}"))
    return cur.withColumn(out, F.coalesce(*outs)).drop(*[f"_v{i}" for i in range(len(steps))])


def multi_alias_lookup(df: DataFrame, on: str, dim: DataFrame, id_col: str, aliases, out: str):
    """One entity reachable by several aliases, ``aliases = [(priority, Column)]``
    over ``dim``. Returns (joined, collisions): an alias claimed by several
    ids at its best priority resolves to the smallest id and is reported
    (one row per alias and id)."""
    exploded = dim.select(
        F.col(id_col).alias("_id"),
        F.explode(F.array(*[F.struct(F.lit(p).alias("p"), _norm(c).alias("a")) for p, c in aliases])).alias("_al"),
    ).select("_id", F.col("_al.p").alias("_p"), F.col("_al.a").alias("_a")).where(F.col("_a").isNotNull() & (F.col("_a") != ""))
    best = exploded.groupBy("_a").agg(
        F.min_by(F.col("_id"), F.struct("_p", "_id")).alias("_id"),
        F.min("_p").alias("_p"),
    )
    at_best = exploded.join(best.select("_a", F.col("_p").alias("_bp")), "_a").where(F.col("_p") == F.col("_bp"))
    pairs = at_best.select("_a", "_id").distinct()
    # long form (one row per alias and id): an alias shared by millions of
    # ids never becomes one array in one task
    n = pairs.groupBy("_a").agg(F.count(F.lit(1)).alias("n_ids")).where(F.col("n_ids") > 1)
    collisions = pairs.join(n, "_a").select(F.col("_a").alias("alias"), F.col("_id").alias("id"), "n_ids")
    joined = df.withColumn("_a", _norm(F.col(on))).join(best.select("_a", F.col("_id").alias(out)), "_a", "left").drop("_a")
    return joined, collisions


def star_left_join(df: DataFrame, dims) -> DataFrame:
    """Fact with several optional dimensions: ``dims = [(dim, on)]``; unmatched facts kept."""
    for dim, on in dims:
        df = df.join(dim, on, "left")
    return df


def inner_join_multi(df: DataFrame, joins) -> DataFrame:
    for dim, on in joins:
        df = df.join(dim, on, "inner")
    return df


def inequality_join(a: DataFrame, b: DataFrame, a_level: str, b_required: str, keys=()) -> DataFrame:
    """``a.level >= b.required`` for small non-negative integer levels:
    each ``a`` row fans out to the levels 0..level (bounded by the level
    domain) and joins ``b`` on equality; a negative level meets nothing."""
    fan = a.where(F.col(a_level) >= 0).withColumn("_lvl", F.explode(F.sequence(F.lit(0), F.col(a_level).cast("int"))))
    return fan.join(b.withColumnRenamed(b_required, "_lvl"), [*keys, "_lvl"], "inner").withColumn(b_required, F.col("_lvl")).drop("_lvl")


def range_join(points: DataFrame, ranges: DataFrame, eq, point: str, lo: str, hi: str, bucket: str = "month",
               max_buckets: int | None = None) -> DataFrame:
    """``points.eq = ranges.eq AND point::date BETWEEN lo AND hi``.

    Bucketed equi-join: every range expands into the calendar buckets
    (months by default) it overlaps and every point gets its own bucket,
    so the join is an equi-join on (eq, bucket) followed by the exact
    BETWEEN test. Fan-out is 1-3 rows per pay period instead of one row per
    day, and a hot key is still split by bucket. A long range simply spans
    more buckets; only when ``max_buckets`` is given are ranges longer than
    that joined on the keys with the residual test instead (that branch
    re-reads the points, so it is off by default).
    """
    pts = points.withColumn("_day", F.col(point).cast("date")).withColumn("_b", F.date_trunc(bucket, F.col("_day")).cast("date"))
    lo_b = F.date_trunc(bucket, F.col(lo).cast("date")).cast("date")
    hi_b = F.date_trunc(bucket, F.col(hi).cast("date")).cast("date")
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    ranges = ranges.where(F.col(lo).cast("date") <= F.col(hi).cast("date"))  # an inverted range holds no point
    n_buckets = F.size(F.sequence(lo_b, hi_b, step))
    if max_buckets is None:
        short, long_ = ranges, None
    else:
        short = ranges.where(n_buckets <= max_buckets)
        long_ = ranges.where(~(n_buckets <= max_buckets))
    r = short.withColumn("_b", F.explode(F.sequence(lo_b, hi_b, step)))
    out = pts.join(r, [*eq, "_b"], "inner").where(F.col("_day").between(F.col(lo), F.col(hi))).drop("_b")
    if long_ is not None:
        rl = long_.alias("r")
        cond = [pts[k] == F.col(f"r.{k}") for k in eq] + [pts["_day"].between(F.col(f"r.{lo}"), F.col(f"r.{hi}"))]
        out_long = pts.join(rl, cond, "inner").drop(*[F.col(f"r.{k}") for k in eq]).drop("_b")
        out = out.unionByName(out_long.select(*out.columns))
    return out.drop("_day")


def asof_next(df: DataFrame, events: DataFrame, keys, ref: str, ev: str, out: str = "next_event") -> DataFrame:
    """First event date >= the reference date per key: union both sides
    and take the first non-null event value over a following frame."""
    from pyspark.sql import Window

    # reference rows sort before events at the same instant, so ">=" holds
    left = df.withColumn("_t", F.col(ref)).withColumn("_side", F.lit(0)).withColumn("_ev", F.lit(None).cast(events.schema[ev].dataType))
    right = events.select(*keys, F.col(ev).alias("_t"), F.lit(1).alias("_side"), F.col(ev).alias("_ev"))
    u = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return u.withColumn(out, F.first("_ev", ignorenulls=True).over(w)).where(F.col("_side") == 0).drop("_t", "_side", "_ev")


def asof_next_bucketed(df: DataFrame, events: DataFrame, keys, ref: str, ev: str, bucket: str = "month",
                       out: str = "next_event") -> DataFrame:
    """``asof_next`` with the per-key window split by calendar bucket: the
    first event >= ref inside the ref's bucket, else the earliest event of
    any later bucket (a suffix minimum over the small per-(key, bucket)
    table of earliest events)."""
    from pyspark.sql import Window

    b = lambda c: F.date_trunc(bucket, F.col(c))
    left = df.withColumn("_t", F.col(ref)).withColumn("_side", F.lit(0)).withColumn("_ev", F.lit(None).cast(events.schema[ev].dataType))
    right = events.select(*keys, F.col(ev).alias("_t"), F.lit(1).alias("_side"), F.col(ev).alias("_ev"))
    u = left.unionByName(right, allowMissingColumns=True).withColumn("_b", b("_t"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_side").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    u = u.withColumn("_in", F.first("_ev", ignorenulls=True).over(w)).where(F.col("_side") == 0)
    # every (key, bucket) holding a reference or an event, with the
    # bucket's earliest event (NULL when it has none), then a suffix minimum
    firsts = events.select(*keys, b(ev).alias("_b"), F.col(ev).alias("_first")).unionByName(
        df.select(*keys, b(ref).alias("_b"), F.lit(None).cast(events.schema[ev].dataType).alias("_first"))
    ).groupBy(*keys, "_b").agg(F.min("_first").alias("_first"))
    wl = Window.partitionBy(*keys).orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
    later = firsts.select(*keys, "_b", F.min("_first").over(wl).alias("_later"))
    u = u.join(later, [*keys, "_b"], "left")
    return u.withColumn(out, F.coalesce("_in", "_later")).drop("_t", "_side", "_ev", "_b", "_in", "_later")


def latest_per_key_join(df: DataFrame, snaps: DataFrame, keys, order) -> DataFrame:
    return df.join(keep_first(snaps, keys, order), list(keys), "left")


def semi_join_exists(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def not_in_cleanup(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None, keep: bool = True) -> DataFrame:
    """Keep rows whose key is referenced (``keep``) or unreferenced; an anti
    join has none of NOT IN's NULL trap."""
    r = ref.select(F.col(ref_key or key).alias(key)).where(F.col(key).isNotNull())
    return df.join(r, key, "left_semi" if keep else "left_anti")


def full_outer_compare(cur: DataFrame, prev: DataFrame, keys, measures, nullsafe=(), cur_prefix: str = "c_",
                       prev_prefix: str = "p_", attrs=()) -> DataFrame:
    """Current vs previous: full outer join on ``keys`` (plain equality,
    except null-safe for ``nullsafe``), keys and attributes coalesced,
    measures kept on both sides with prefixes."""
    c = cur.select(*[F.col(k).alias("c__" + k) for k in keys], *[F.col(a).alias("c__" + a) for a in attrs],
                   *[F.col(m).alias(cur_prefix + m) for m in measures])
    p = prev.select(*[F.col(k).alias("p__" + k) for k in keys], *[F.col(a).alias("p__" + a) for a in attrs],
                    *[F.col(m).alias(prev_prefix + m) for m in measures])
    cond = [(F.col("c__" + k).eqNullSafe(F.col("p__" + k)) if k in nullsafe else (F.col("c__" + k) == F.col("p__" + k))) for k in keys]
    j = c.join(p, cond, "full")
    return j.select(
        *[F.coalesce(F.col("c__" + k), F.col("p__" + k)).alias(k) for k in keys],
        *[F.coalesce(F.col("c__" + a), F.col("p__" + a)).alias(a) for a in attrs],
        *[F.col(cur_prefix + m) for m in measures],
        *[F.col(prev_prefix + m) for m in measures],
    )


def cross_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row result as scalar subqueries (no join)."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def join_using(df: DataFrame, others, on, how: str = "left") -> DataFrame:
    for o in others:
        df = df.join(o, list(on), how)
    return df


def prefix_join(df: DataFrame, cell: str, codes: DataFrame, code: str) -> DataFrame:
    """``code startswith cell``: each code emits its prefixes (as many as it
    has characters), turning the theta join into an equi-join on the prefix."""
    pref = codes.where(F.length(code) > 0).withColumn(
        "_p", F.explode(F.transform(F.sequence(F.lit(1), F.length(code)), lambda n: F.substr(F.col(code), F.lit(1), n))))
    return df.join(pref, df[cell] == pref["_p"], "inner").drop("_p")


def multi_code_join(df: DataFrame, cell: str, codes: DataFrame, code: str, id_col: str, sep: str = r"\+",
                    out: str = "matched_ids", keys=()) -> DataFrame:
    """Split a cell on ``sep``; each part matches a code exactly or by its
    base (a trailing '_N' stripped); distinct ids per source row. Without
    ``keys`` a row is told apart by all its columns and comes back as often
    as it was given."""
    grp = list(keys) or list(df.columns)
    if not keys:
        df = df.groupBy(*grp).agg(F.count("*").alias("_rows"))
    parts = df.withColumn("_part", F.explode_outer(F.filter(F.transform(F.split(F.col(cell), sep), lambda x: F.lower(F.trim(x))), lambda x: x != "")))
    alias_tbl = codes.select(F.col(id_col), F.explode(F.array_distinct(F.array(
        F.lower(F.col(code)), F.lower(F.regexp_replace(F.col(code), r"_\d+$", ""))))).alias("_part"))
    j = parts.join(alias_tbl, "_part", "left")
    if keys:
        return j.groupBy(*grp).agg(F.sort_array(F.collect_set(id_col)).alias(out))
    found = j.groupBy(*grp, "_rows").agg(F.sort_array(F.collect_set(id_col)).alias(out))
    return found.withColumn("_rows", F.explode(F.sequence(F.lit(1).cast("long"), "_rows"))).drop("_rows")


def strip_prefix_retry_join(df: DataFrame, on: str, dim: DataFrame, dim_key: str, value: str, prefix: str = "S-",
                            out: str | None = None) -> DataFrame:
    """Exact key match, else retry with ``prefix`` removed; the smallest
    candidate value wins for determinism."""
    out = out or value
    d = dim.groupBy(F.upper(F.col(dim_key)).alias("_k")).agg(F.min(value).alias("_v"))
    first = df.withColumn("_k", F.upper(F.col(on))).join(d, "_k", "left").withColumnRenamed("_v", "_v1").drop("_k")
    stripped = F.regexp_replace(F.upper(F.col(on)), "^" + prefix.upper(), "")
    second = first.withColumn("_k", stripped).join(d, "_k", "left").drop("_k")
    return second.withColumn(out, F.coalesce("_v1", "_v")).drop("_v1", "_v")


def contains_lookup(c, rules, default: str = "Other"):
    """First dictionary key contained in the text (case-insensitive), in
    rule order; ``rules = [(needle, label)]`` is a fixed list, so this is
    an ordered CASE, not a join."""
    s = F.lower(c)
    out = None
    for needle, label in rules:
        cond = s.contains(needle.lower())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def event_key_match(df: DataFrame, events: DataFrame, ts: str, who: str, ev_ts: str, ev_who: str, ev_id: str,
                    out: str = "event_id") -> DataFrame:
    """Link entries to events by (second-precision timestamp, reporter);
    the first (smallest id) match wins."""
    from furrow.functions.codes import normalize_ts_key

    e = events.select(normalize_ts_key(F.col(ev_ts)).alias("_ts"), F.lower(F.trim(F.col(ev_who))).alias("_who"), F.col(ev_id))
    e = e.groupBy("_ts", "_who").agg(F.min(ev_id).alias(out))
    left = df.withColumn("_ts", normalize_ts_key(F.col(ts))).withColumn("_who", F.lower(F.trim(F.col(who))))
    return left.join(e, ["_ts", "_who"], "left").drop("_ts", "_who")


def self_link(df: DataFrame, id_col: str, link_code: str, code: str, out: str) -> DataFrame:
    """Row -> the row whose ``code`` equals this row's ``link_code`` (smallest id wins)."""
    ref = df.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("_c")).agg(F.min(id_col).alias(out))
    return df.join(ref, df[link_code] == ref["_c"], "left").drop("_c")


def earliest_link(df: DataFrame, events: DataFrame, keys, ts: str, ev_id: str, out: str) -> DataFrame:
    """Attach the earliest event of each key to rows lacking a link."""
    first = events.groupBy(*keys).agg(F.min_by(F.col(ev_id), F.struct(F.col(ts), F.col(ev_id))).alias("_first"))
    j = df.join(first, list(keys), "left")
    if out in df.columns:
        return j.withColumn(out, F.coalesce(F.col(out), F.col("_first"))).drop("_first")
    return j.withColumnRenamed("_first", out)


def hierarchy_lookup(df: DataFrame, nodes: DataFrame, fk: str, node_id: str, parent: str, name: str,
                     out_prefix: str = "parent_") -> DataFrame:
    """Row -> its node -> the node's parent (one self-join per level)."""
    n = nodes.select(F.col(node_id).alias(fk), F.col(parent).alias("_pid"), F.col(name).alias(f"node_{name}"))
    p = nodes.select(F.col(node_id).alias("_pid"), F.col(name).alias(f"{out_prefix}{name}"))
    return df.join(n, fk, "left").join(p, "_pid", "left").withColumnRenamed("_pid", f"{out_prefix}id")


def recall_join(holds: DataFrame, sessions: DataFrame, keys) -> DataFrame:
    return holds.join(sessions, list(keys), "inner")


def two_hop_sync(child: DataFrame, parent: DataFrame, fk: str, pk: str, cols) -> DataFrame:
    """Copy parent attributes onto children through ``fk`` (parent wins when present)."""
    p = parent.select(F.col(pk).alias(fk), *[F.col(c).alias("_p_" + c) for c in cols])
    j = child.join(p, fk, "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col("_p_" + c), F.col(c)) if c in child.columns else F.col("_p_" + c)).drop("_p_" + c)
    return j


def _key_text(cols) -> Column:
    """Values as one text, each with its length, so that no two keys share it; NULL if any is NULL."""
    parts = [F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in (c.cast("string") for c in cols)]
    return F.concat(*parts)


def _keyed(levels) -> Column:
    """Array of (level, key) of the keys that have all values."""
    keys = [F.struct(F.lit(i).alias("_level"), _key_text(cols).alias("_key")) for i, cols in enumerate(levels)]
    return F.filter(F.array(*keys), lambda k: k["_key"].isNotNull())


def prioritised_match(df: DataFrame, id_col: str, keys, targets: DataFrame, target_keys, target: str, order, out: str,
                      level: str | None = None) -> DataFrame:
    """``df`` with the target that its first matching key gives. ``keys`` and
    ``target_keys`` are lists of equally many keys, best first, each a list of
    columns (constants tell kinds of targets apart); a key with a NULL matches
    nothing. Of several targets under a key the first in ``order`` counts.
    ``level``: column for the number of the key that matched.

    All keys of a side go through one join: targets are reduced to one per key
    before the shuffle, rows meet at most one target per key and are put
    together again by ``id_col``, which is unique."""
    best = targets.select(F.explode(_keyed(target_keys)).alias("_k"), F.struct(*[F.col(o) for o in order], F.col(target).alias("_t")).alias("_o")) \
        .groupBy("_k._level", "_k._key").agg(F.min("_o").alias("_o")).select("_level", "_key", F.col("_o._t").alias("_target"))
    rest = [c for c in df.columns if c != id_col]
    rows = df.select(id_col, F.struct(*rest).alias("_row"), F.explode_outer(_keyed(keys)).alias("_k")).select(id_col, "_row", "_k.*")
    hit = F.col("_target").isNotNull()
    found = rows.join(best, ["_level", "_key"], "left").groupBy(id_col).agg(
        F.first("_row").alias("_row"), F.min(F.when(hit, F.struct("_level", "_target"))).alias("_hit"))
    extra = [F.col("_hit._level").alias(level)] if level else []
    return found.select(*[F.col(id_col) if c == id_col else F.col("_row")[c].alias(c) for c in df.columns], F.col("_hit._target").alias(out), *extra)
