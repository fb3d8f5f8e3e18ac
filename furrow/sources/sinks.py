"""Sinks and load semantics (§2.2).

Load semantics are DataFrame functions that compute the *new state* of a
target table (upsert, insert-ignore, child replacement, soft delete ...),
so they are testable like any query; ``write_*`` functions persist a
state. Writes go to a new version folder and never overwrite a path the
same plan reads from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.windows import keep_first, keep_last


def _one_per_key(df: DataFrame, keys, order=None) -> DataFrame:
    """The last row of each key in ``order``; without one, the greatest by all other columns."""
    rest = [c for c in df.columns if c not in keys]
    if order:
        return keep_last(df, list(keys), list(order))
    if not rest:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def write_append(df: DataFrame, path: str, partition_by=()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_full_refresh(df: DataFrame, path: str, scope_cols=()) -> None:
    """Clear the scope, then reinsert: dynamic partition overwrite on the
    scope columns replaces only the scopes present in ``df``."""
    w = df.write.mode("overwrite")
    if scope_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*scope_cols)
    w.parquet(path)


def write_scoped_replace(df: DataFrame, path: str, tenant_col: str = "org_id") -> None:
    write_full_refresh(df, path, [tenant_col])


def export_summary(df: DataFrame, path: str, fmt: str = "csv") -> None:
    (df.write.mode("overwrite").option("header", True).csv(path) if fmt == "csv" else df.write.mode("overwrite").parquet(path))


def upsert_by_key(target: DataFrame, updates: DataFrame, keys, update_cols=None, order=None) -> DataFrame:
    """Insert new keys; for existing keys overwrite ``update_cols`` (all
    non-key columns by default). Of duplicate keys in ``updates`` the last
    in ``order`` wins."""
    update_cols = list(update_cols or [c for c in target.columns if c not in keys])
    u = _one_per_key(updates, keys, order).select(*keys, *update_cols).withColumn("_new", F.lit(True))
    t = target.withColumn("_new", F.lit(False))
    j = t.join(u.select(*keys, *[F.col(c).alias("_u_" + c) for c in update_cols], F.col("_new").alias("_hit")), list(keys), "left")
    updated = j.select(*keys, *[F.when(F.col("_hit"), F.col("_u_" + c)).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
                                for c in target.columns if c not in keys])
    inserted = u.join(target.select(*keys), list(keys), "left_anti")
    for c in target.columns:
        if c not in inserted.columns:
            inserted = inserted.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    return updated.select(*target.columns).unionByName(inserted.select(*target.columns))


def insert_ignore(target: DataFrame, new: DataFrame, keys, order=None) -> DataFrame:
    """Rows of ``new`` whose key is unseen (in target and earlier in ``new``,
    by ``order``) appended to the target: ``ON CONFLICT DO NOTHING``."""
    rest = [c for c in new.columns if c not in keys]
    first = keep_first(new, list(keys), list(order or rest)) if rest else new.distinct()
    fresh = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert_parent_replace_children(parents: DataFrame, children: DataFrame, new_parents: DataFrame, new_children: DataFrame,
                                   parent_key, child_fk):
    """Upsert headers; drop every child of a touched header; add the new
    lines. Returns (parents_state, children_state)."""
    p_state = upsert_by_key(parents, new_parents, parent_key)
    touched = new_parents.select(*[F.col(k).alias(f) for k, f in zip(parent_key, child_fk)], F.lit(True).alias("_touched"))
    # a left join, since an anti join would be moved below the caller's partitioning of the children; touched rows go, repeated or not
    kept = children.join(touched, list(child_fk), "left").where(F.col("_touched").isNull()).select(*children.columns)
    return p_state, kept.unionByName(new_children.select(*children.columns))


def update_from_values(target: DataFrame, values: DataFrame, keys, cols, order=None) -> DataFrame:
    """Keyed bulk update of chosen columns (one VALUES join): a matched row
    gets the given values, NULL included; of duplicate keys the last in
    ``order`` counts."""
    v = _one_per_key(values.select(*keys, *cols, *[o.lstrip("-") for o in order or () if o.lstrip("-") not in (*keys, *cols)]), keys, order)
    v = v.select(*keys, *[F.col(c).alias("_v_" + c) for c in cols], F.lit(True).alias("_hit"))
    j = target.join(v, list(keys), "left")
    return j.select(*[F.when(F.col("_hit"), F.col("_v_" + c)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in target.columns])


def update_if_distinct(target: DataFrame, values: DataFrame, key: str, cols, key_fn=F.lower):
    """Case-insensitive key match; update only values that really change.
    Returns (new_state, changed_rows)."""
    v = _one_per_key(values.select(key_fn(F.col(key)).alias("_k"), *[F.col(c).alias("_v_" + c) for c in cols]), ["_k"])
    j = target.withColumn("_k", key_fn(F.col(key))).join(v, "_k", "left")
    changed = F.lit(False)
    for c in cols:
        changed = changed | (F.col("_v_" + c).isNotNull() & ~F.col(c).eqNullSafe(F.col("_v_" + c)))
    j = j.withColumn("_changed", changed)
    state = j.select(*[F.when(F.col("_changed") & F.col("_v_" + c).isNotNull(), F.col("_v_" + c)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in target.columns])
    return state, j.where("_changed").select(*target.columns)


def soft_delete_missing(target: DataFrame, extract: DataFrame, keys, scope_col: str | None = None, scope_value=None,
                        flag: str = "is_deleted") -> DataFrame:
    """Rows of the tenant absent from the new extract -> ``is_deleted = true``."""
    seen = extract.select(*keys).distinct().withColumn("_seen", F.lit(True))
    j = target.join(seen, list(keys), "left")
    in_scope = F.lit(True) if scope_col is None else (F.col(scope_col) == F.lit(scope_value))
    return j.withColumn(flag, F.when(in_scope & F.col("_seen").isNull(), F.lit(True)).otherwise(F.coalesce(F.col(flag), F.lit(False)))
                        if flag in target.columns else (in_scope & F.col("_seen").isNull())).drop("_seen")


def insert_missing_dims(dim: DataFrame, facts: DataFrame, fact_key: str, dim_key: str, defaults: dict) -> DataFrame:
    """New inactive dimension rows for fact keys the dimension lacks; an
    existing id is never overwritten. Returns only the rows to add."""
    miss = facts.select(F.col(fact_key).alias(dim_key)).where(F.col(dim_key).isNotNull()).distinct() \
        .join(dim.select(dim_key), dim_key, "left_anti")
    for c in dim.columns:
        if c != dim_key:
            miss = miss.withColumn(c, F.lit(defaults.get(c)).cast(dim.schema[c].dataType))
    return miss.select(*dim.columns)


def stamp_audit(df: DataFrame, user_col: str | None = None, system_user: str = "system", at=None) -> DataFrame:
    who = F.coalesce(F.col(user_col), F.lit(system_user)) if user_col else F.lit(system_user)
    when = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    return df.withColumns({"created_by": who, "updated_by": who, "created_at": when, "updated_at": when})


def surrogate_id(df: DataFrame, keys, out: str = "id") -> DataFrame:
    """Deterministic id from the natural key (stable on recompute, so
    children get the parent id without a round trip). Each value goes in
    with its length, so no two keys share a text."""
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (F.col(k).cast("string") for k in keys)]
    return df.withColumn(out, F.substr(F.sha2(F.concat_ws("|", *parts), 256), F.lit(1), F.lit(32)))


def drop_null_payload(df: DataFrame, defaults: dict) -> DataFrame:
    """Let column defaults apply where a value is missing."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})

