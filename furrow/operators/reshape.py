"""Reshape: unpivot, explode, generate (§2.10).

Every fan-out here is bounded per input row (a fixed slot list, the
parts of one cell, the days of one interval), so output grows linearly
with the input and no operator pairs rows with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.codes import parse_cycle_code
from furrow.functions.lists import split_list


def unpivot_measures(df: DataFrame, id_cols, value_cols, name: str = "metric", value: str = "value",
                     config: DataFrame | None = None, config_key: str | None = None) -> DataFrame:
    """Wide readings -> (ids, metric, value); NULL readings dropped; an
    optional metric config (fixed-size) is joined on the metric name."""
    long = df.unpivot(list(id_cols), list(value_cols), name, value).where(F.col(value).isNotNull())
    if config is not None:
        if config_key is None or config_key == name:
            long = long.join(config, name, "inner")
        else:
            long = long.join(config, long[name] == config[config_key], "inner").drop(config_key)
    return long


def _any_not_null(cols):
    """OR of IS NOT NULL over columns of possibly different types."""
    cond = None
    for c in cols:
        x = F.col(c).isNotNull()
        cond = x if cond is None else (cond | x)
    return cond


def unpivot_slots(df: DataFrame, id_cols, slots, slot_col: str = "slot", drop_all_null: bool = True) -> DataFrame:
    """Numbered column groups -> one row per slot. ``slots`` is a list of
    dicts {field: column}; the slot number is its position (1-based)."""
    fields = list(slots[0].keys())

    def c(v):
        return F.col(v) if isinstance(v, str) else v

    arr = F.array(*[F.struct(F.lit(i + 1).alias(slot_col), *[c(s[f]).alias(f) for f in fields]) for i, s in enumerate(slots)])
    out = df.select(*id_cols, F.explode(arr).alias("_s")).select(*id_cols, "_s.*")
    if drop_all_null:
        out = out.where(_any_not_null(fields))
    return out


def unpivot_prefix_groups(df: DataFrame, id_cols, prefixes, fields, label: str = "group", sep: str = "_",
                          drop_if_null=None) -> DataFrame:
    """Column groups named ``{prefix}{sep}{field}`` -> one row per prefix
    with the prefix in ``label``; a row is dropped when all its fields (or
    the ``drop_if_null`` ones) are NULL. Variety blocks, scenarios, photo
    columns and per-product price blocks are all this shape."""
    arr = F.array(*[F.struct(F.lit(p).alias(label), *[F.col(f"{p}{sep}{f}").alias(f) for f in fields]) for p in prefixes])
    out = df.select(*id_cols, F.explode(arr).alias("_g")).select(*id_cols, "_g.*")
    keep = drop_if_null or list(fields)
    return out.where(_any_not_null(keep))


def explode_channel_index(sensors: DataFrame, device: str, channels: str, types: DataFrame, type_key: str) -> DataFrame:
    """Sensors with channel arrays -> one row per (device, channel) with the
    channel's type and exponent from a fixed type table; channels whose
    type is not listed (skipped types) drop out of the inner join."""
    x = sensors.select(F.col(device).alias("device_id"), F.explode(F.col(channels)).alias(type_key))
    return x.join(types, type_key, "inner")


def unpivot_questions(df: DataFrame, id_cols, questions, out_prefix: str = "response_") -> DataFrame:
    """Row x question list -> typed answers. ``questions = [(question_id,
    column, type)]`` with type boolean / numeric / enum / text. A fixed
    list, so this is an explode of literals, not a join."""
    arr = F.array(*[F.struct(F.lit(q).alias("question_id"), F.lit(t).alias("_type"), F.col(c).cast("string").alias("_raw"))
                    for q, c, t in questions])
    long = df.select(*id_cols, F.explode(arr).alias("_q")).select(*id_cols, "_q.*").where(F.trim(F.col("_raw")) != "")
    from furrow.functions.parse import parse_bool3, parse_number

    return long.select(
        *id_cols, "question_id",
        F.when(F.col("_type") == "boolean", parse_bool3(F.col("_raw"), ("Y", "T", "PASS"), ("N", "F", "FAIL"))).alias(out_prefix + "boolean"),
        F.when(F.col("_type") == "numeric", parse_number(F.col("_raw"))).alias(out_prefix + "numeric"),
        F.when(F.col("_type") == "enum", F.trim(F.col("_raw"))).alias(out_prefix + "enum"),
        F.when(F.col("_type") == "text", F.trim(F.col("_raw"))).alias(out_prefix + "text"),
    )


def explode_list_cell(df: DataFrame, c: str, out: str, sep: str = r"[+;&,]", dedupe: bool = True, outer: bool = False) -> DataFrame:
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(out, fn(split_list(F.col(c), sep, dedupe=dedupe)))


def fanout_children(df: DataFrame, specs: dict) -> dict:
    """One staged source -> several child tables: ``specs = {name: fn(df)}``."""
    return {name: fn(df) for name, fn in specs.items()}


def split_evenly(df: DataFrame, amount: str, list_col: str, out: str = "share", item: str = "item") -> DataFrame:
    """Amount divided across the items of a list; an empty list keeps one
    row with a NULL item and the whole amount."""
    n = F.greatest(F.size(F.col(list_col)), F.lit(1))
    return df.withColumn(out, F.col(amount) / n).withColumn(item, F.explode_outer(F.col(list_col)))


def explode_docs(df: DataFrame, line_col: str, header_cols, line_fields: dict, line_no: str = "line_num") -> DataFrame:
    """Nested document -> one row per line (``posexplode``); missing line
    numbers take the 1-based position. ``line_fields = {out: Column over 'l'}``."""
    x = df.select(*header_cols, F.posexplode(F.col(line_col)).alias("_pos", "l"))
    return x.select(*header_cols, *[c.alias(n) for n, c in line_fields.items()], (F.col("_pos") + 1).alias("_pos1")) \
        .withColumn(line_no, F.coalesce(F.col(line_no), F.col("_pos1")) if line_no in line_fields else F.col("_pos1")).drop("_pos1")


def series_days(df: DataFrame, start: str, end: str, day: str = "day", clip: bool = True, drop_empty: bool = False) -> DataFrame:
    """One row per calendar day of [start, end]; with ``clip`` each row
    carries the part of the interval inside that day. Like the source
    system, an interval ending exactly at midnight yields a zero-length
    last day unless ``drop_empty``. An interval that ends before it starts
    has no day."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    d = df.where(first <= last).withColumn(day, F.explode(F.sequence(first, last)))
    if clip:
        day_start = F.col(day).cast("timestamp_ntz")
        d = d.withColumn("day_start", F.greatest(F.col(start), day_start)) \
             .withColumn("day_end", F.least(F.col(end), F.date_add(F.col(day), 1).cast("timestamp_ntz")))
        if drop_empty:
            d = d.where(F.col("day_end") > F.col("day_start"))
    return d


def series_cycles(df: DataFrame, anchor: str, slot: str, period_days: int, as_of, horizon, out: str = "cycle_start",
                  slot_days: int = 7) -> DataFrame:
    """Rotation: first start = anchor + slot offset (mod the period),
    fast-forwarded to ``as_of``, then every ``period_days`` up to ``horizon``."""
    base = F.date_add(F.col(anchor), (F.col(slot).cast("int") * slot_days) % period_days)
    behind = F.greatest(F.datediff(F.lit(as_of).cast("date"), base), F.lit(0))
    first = F.date_add(base, F.ceil(behind / period_days).cast("int") * period_days)
    return df.withColumn(out, F.explode(F.sequence(first, F.lit(horizon).cast("date"), F.expr(f"INTERVAL {period_days} DAYS"))))


def stub_parents(codes: DataFrame, code: str, existing: DataFrame, existing_code: str) -> DataFrame:
    """Distinct unmatched codes -> parsed stub parents (invalid codes dropped)."""
    d = codes.select(F.upper(F.trim(F.col(code))).alias("code")).where(F.col("code").isNotNull()).distinct()
    e = existing.select(F.upper(F.col(existing_code)).alias("code"))
    miss = d.join(e, "code", "left_anti")
    return miss.withColumn("_p", parse_cycle_code(F.col("code"))).where(F.col("_p").isNotNull()).select("code", "_p.*")


def json_array_elements(df: DataFrame, c: str, out: str = "element", prefix: str | None = None) -> DataFrame:
    """JSON array text -> one row per element, optionally only those with a prefix."""
    x = df.withColumn(out, F.explode(F.from_json(F.col(c), "array<string>")))
    return x.where(F.col(out).startswith(prefix)) if prefix else x


def entitlement_grid(df: DataFrame, modules, out: str = "module") -> DataFrame:
    """Each row x a fixed list of enabled modules (explode of literals)."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(m) for m in modules])))


def rotation_calendar(slots: DataFrame, slot: str, anchor_slot: int, anchor_date: str, n_slots: int, after: str, until: str,
                      out: str, slot_days: int = 7) -> DataFrame:
    """The days in (``after``, ``until``] on which each slot of a rotation comes
    round: the anchor slot on ``anchor_date``, the next one ``slot_days`` later,
    again after all ``n_slots``; never before the first round. Each slot's
    first and last round are computed, not searched."""
    cycle = n_slots * slot_days
    first = F.date_add(F.lit(anchor_date).cast("date"), (F.pmod(F.col(slot) - anchor_slot, F.lit(n_slots)) * slot_days).cast("int"))
    begin = F.greatest(F.floor(F.datediff(F.lit(after).cast("date"), first) / cycle) + 1, F.lit(0))
    end = F.floor(F.datediff(F.lit(until).cast("date"), first) / cycle)
    rounds = F.when(end >= begin, F.sequence(begin, end)).otherwise(F.array().cast("array<bigint>"))
    return slots.withColumn("_round", F.explode(rounds)).withColumn(out, F.date_add(first, (F.col("_round") * cycle).cast("int"))).drop("_round")


def typed_events(df: DataFrame, keys, events, amount: str = "amount") -> DataFrame:
    """The events a record holds, one row each: ``keys``, event_no (1.. within
    the record, in the given order), event, unit, the further fields and the
    amount. ``events`` is [(event, amount column, unit, {field: column})], all
    with the same fields; an event takes place if its amount is positive."""
    each = [F.when(F.coalesce(a > 0, F.lit(False)), F.struct(
        F.lit(name).alias("event"), F.lit(unit).alias("unit"), *[c.alias(f) for f, c in fields.items()], a.cast("double").alias(amount)))
        for name, a, unit, fields in events]
    there = F.filter(F.array(*each), lambda e: e.isNotNull())
    return df.select(*keys, F.posexplode(there).alias("_no", "_e")).select(*keys, (F.col("_no") + 1).alias("event_no"), "_e.*")
