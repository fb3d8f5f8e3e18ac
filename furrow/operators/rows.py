"""Projections, filters and row quarantine (§2.4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_map(df: DataFrame, spec: dict) -> DataFrame:
    """Sheet -> table projection: ``spec = {out: source name | Column | literal}``."""
    def one(v):
        if isinstance(v, Column):
            return v
        if isinstance(v, str) and v in df.columns:
            return F.col(v)
        return F.lit(v)

    return df.select(*[one(v).alias(k) for k, v in spec.items()])


def filter_soft_delete(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def filter_active_asof(df: DataFrame, end: str, as_of, start: str | None = None) -> DataFrame:
    """Not ended as of ``as_of`` (and, with ``start``, already started)."""
    a = F.lit(as_of).cast("date")
    cond = F.col(end).isNull() | (F.col(end).cast("date") > a)
    if start:
        cond = cond & (F.col(start).isNull() | (F.col(start).cast("date") <= a))
    return df.where(cond)


def filter_domain(df: DataFrame, c: str, allow=None, deny=None, null_ok: bool = False) -> DataFrame:
    """IN / NOT IN / IS DISTINCT FROM filters; ``null_ok`` keeps NULLs on a deny list."""
    cond = F.lit(True)
    if allow is not None:
        cond = cond & F.col(c).isin(*allow)
    if deny is not None:
        d = ~F.col(c).isin(*deny)
        cond = cond & (F.coalesce(d, F.lit(True)) if null_ok else d)
    return df.where(cond)


def quarantine(df: DataFrame, rules, reason: str = "reason", detail: str = "detail"):
    """Route rows by the first failing rule. ``rules = [(reason, bad_cond,
    detail Column | None)]``. Returns (kept, rejected) with
    ``kept + rejected = input``."""
    r = None
    d = None
    for name, bad, det in rules:
        r = F.when(bad, F.lit(name)) if r is None else r.when(bad, F.lit(name))
        dv = det if det is not None else F.lit(None).cast("string")
        d = F.when(bad, dv.cast("string")) if d is None else d.when(bad, dv.cast("string"))
    tagged = df.withColumn(reason, r).withColumn(detail, d)
    return tagged.where(F.col(reason).isNull()).drop(reason, detail), tagged.where(F.col(reason).isNotNull())


def known_key_filter(df: DataFrame, ref: DataFrame, keys) -> DataFrame:
    return df.join(ref.select(*keys).distinct(), list(keys), "left_semi")


def catch_all_member(c, known: DataFrame | None = None, default: str = "other") -> Column:
    """Blank or unknown keys map to a catch-all member (column form; pair
    it with a left join against the known keys)."""
    s = F.trim(c)
    return F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(s)


def skip_all_null_group(df: DataFrame, cols) -> DataFrame:
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def keep_nonzero(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c) > 0)


def filter_planned_only(df: DataFrame, link: str, start: str) -> DataFrame:
    return df.where(F.col(link).isNull() & F.col(start).isNotNull())
