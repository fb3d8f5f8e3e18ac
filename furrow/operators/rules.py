"""Validation, thresholds and access policy (§2.11).

Database triggers and row policies become set-based batch operators:
checks return violation DataFrames, derivations return new columns, and
access rules take the principal as an explicit parameter (a small,
per-caller literal), never a hidden session lookup.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions._util import col


@dataclass(frozen=True)
class Principal:
    """Caller identity: orgs it belongs to, its role and employee id per org."""

    user_id: str
    orgs: tuple = ()
    role_by_org: dict = field(default_factory=dict)
    employee_by_org: dict = field(default_factory=dict)


# Roles that see every row / roles that see money columns masked.
ALL_ROWS_ROLES = ("Owner", "Admin", "Team Lead")
MASKED_ROLES = ("Team Lead",)


def flag_out_of_range(value, lo=None, hi=None, pass_set=None) -> Column:
    """below min or above max (NULL bounds open, NULL reading -> False); for
    enum readings, not in the pass set."""
    v = col(value)
    out = F.lit(False)
    if lo is not None:
        out = out | F.coalesce(v < col(lo), F.lit(False))
    if hi is not None:
        out = out | F.coalesce(v > col(hi), F.lit(False))
    if pass_set is not None:
        out = out | F.coalesce(~F.array_contains(col(pass_set), v.cast("string")), F.lit(False))
    return out


def test_pass_fail(df: DataFrame, cfg: DataFrame, on: str, value: str, lo: str, hi: str, out: str = "passed") -> DataFrame:
    """Join the test config; pass when the reading is within its bounds
    (NULL reading -> NULL)."""
    j = df.join(cfg, on, "left")
    v = F.col(value)
    inside = F.coalesce(v >= F.col(lo), F.lit(True)) & F.coalesce(v <= F.col(hi), F.lit(True))
    return j.withColumn(out, F.when(v.isNotNull(), inside))


def terminate_on_fail(obs: DataFrame, trial: str, ts: str, failed: Column, reason: Column) -> DataFrame:
    """Per trial, the first failing observation: (trial, terminated_at,
    termination_reason). Idempotent: depends only on the observations."""
    f = obs.where(failed)
    return f.groupBy(trial).agg(
        F.min(ts).alias("terminated_at"),
        F.min_by(reason, F.struct(F.col(ts), reason)).alias("termination_reason"),
    )


def terminate_flagged(obs: DataFrame, by, ts: str, flag: str) -> DataFrame:
    """Last termination date among flagged observations per trial."""
    return obs.where(F.col(flag)).groupBy(*by).agg(F.max(ts).alias("terminated_at"))


def derive_day_offset(child: DataFrame, parent: DataFrame, fk: str, pk: str, child_date: str, parent_date: str,
                      out: str = "day_offset") -> DataFrame:
    p = parent.select(F.col(pk).alias(fk), F.col(parent_date).alias("_pd"))
    return child.join(p, fk, "left").withColumn(out, F.datediff(F.col(child_date), F.col("_pd"))).drop("_pd")


def default_best_by(df: DataFrame, products: DataFrame, key: str, harvest: str, shelf_days: str, out: str = "best_by") -> DataFrame:
    p = products.select(F.col(key), F.col(shelf_days).alias("_sd"))
    j = df.join(p, key, "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.date_add(F.col(harvest), F.coalesce(F.col("_sd"), F.lit(0)).cast("int")))
                        if out in df.columns else F.date_add(F.col(harvest), F.coalesce(F.col("_sd"), F.lit(0)).cast("int"))).drop("_sd")


def audit_immutable(old: DataFrame, new: DataFrame, id_col: str, cols) -> DataFrame:
    """Rows whose identity columns changed between two snapshots:
    (id, column, old_value, new_value)."""
    o = old.select(F.col(id_col), *[F.col(c).cast("string").alias("o_" + c) for c in cols])
    n = new.select(F.col(id_col), *[F.col(c).cast("string").alias("n_" + c) for c in cols])
    j = o.join(n, id_col, "inner")
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col("o_" + c).alias("old_value"), F.col("n_" + c).alias("new_value"),
                             (~F.col("o_" + c).eqNullSafe(F.col("n_" + c))).alias("changed")) for c in cols])
    return j.select(id_col, F.explode(arr).alias("_v")).where("_v.changed").select(id_col, "_v.column", "_v.old_value", "_v.new_value")


def audit_set_once(old: DataFrame, new: DataFrame, id_col: str, cols, requires: dict | None = None) -> DataFrame:
    """Set-once columns: a value may go from NULL to set, never change
    after; ``requires = {col: prerequisite}`` (stop needs start)."""
    v = audit_immutable(old.select(id_col, *cols), new.select(id_col, *cols), id_col, cols).where(F.col("old_value").isNotNull()) \
        .withColumn("rule", F.lit("set_once"))
    if requires:
        extra = []
        for c, pre in requires.items():
            extra.append(new.where(F.col(c).isNotNull() & F.col(pre).isNull())
                         .select(id_col, F.lit(c).alias("column"), F.lit(None).cast("string").alias("old_value"),
                                 F.col(c).cast("string").alias("new_value"), F.lit("requires_" + pre).alias("rule")))
        for e in extra:
            v = v.unionByName(e)
    return v


def check_unique(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_foreign_key(df: DataFrame, ref: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Orphans: non-NULL foreign keys without a parent."""
    r = ref.select(F.col(pk or fk).alias(fk))
    return df.where(F.col(fk).isNotNull()).join(r, fk, "left_anti")


def check_domain(df: DataFrame, c: str, allowed=None, lo=None, hi=None) -> DataFrame:
    bad = F.lit(False)
    if allowed is not None:
        bad = bad | ~F.col(c).isin(*allowed)
    if lo is not None:
        bad = bad | (F.col(c) < lo)
    if hi is not None:
        bad = bad | (F.col(c) > hi)
    return df.where(F.col(c).isNotNull() & bad)


def check_exactly_one(df: DataFrame, cols) -> DataFrame:
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.where(n != 1)


def coverage_report(df: DataFrame, ref: DataFrame, keys) -> DataFrame:
    """Distinct used keys with no reference row."""
    return df.select(*keys).where(F.coalesce(*[F.col(k).isNotNull() for k in keys])).distinct().join(ref.select(*keys), list(keys), "left_anti")


def policy_tenant(df: DataFrame, p: Principal, org_col: str = "org_id") -> DataFrame:
    return df.where(F.col(org_col).isin(*p.orgs))


def _role_col(p: Principal, org_col: str) -> Column:
    m = F.create_map(*[x for k, v in p.role_by_org.items() for x in (F.lit(k), F.lit(v))]) if p.role_by_org else None
    return F.try_element_at(m, F.col(org_col)) if m is not None else F.lit(None).cast("string")


def _employee_col(p: Principal, org_col: str) -> Column:
    m = F.create_map(*[x for k, v in p.employee_by_org.items() for x in (F.lit(k), F.lit(v))]) if p.employee_by_org else None
    return F.try_element_at(m, F.col(org_col)) if m is not None else F.lit(None)


def policy_row_scope(df: DataFrame, p: Principal, org_col: str, emp_col: str, manager_col: str) -> DataFrame:
    """Owner / Admin / Team Lead see all rows of the org; a Manager sees
    their own reports and themselves; other roles see nothing."""
    role = _role_col(p, org_col)
    me = _employee_col(p, org_col)
    ok = role.isin(*ALL_ROWS_ROLES) | ((role == "Manager") & ((F.col(manager_col) == me) | (F.col(emp_col) == me)))
    return df.where(F.coalesce(ok, F.lit(False)))


def policy_mask_columns(df: DataFrame, p: Principal, org_col: str, cols) -> DataFrame:
    role = _role_col(p, org_col)
    masked = F.coalesce(role.isin(*MASKED_ROLES), F.lit(False))
    return df.withColumns({c: F.when(~masked, F.col(c)) for c in cols})


def resolve_principal(employees: DataFrame, user_col: str, user_id, org_col: str, id_col: str, level_col: str) -> DataFrame:
    """(user, org) -> employee id and access level (smallest id when several)."""
    return employees.where(F.col(user_col) == F.lit(user_id)).groupBy(org_col).agg(
        F.min_by(F.struct(F.col(id_col).alias("employee_id"), F.col(level_col).alias("access_level")), F.col(id_col)).alias("_p")
    ).select(org_col, "_p.*")


def nav_entitlements(users: DataFrame, modules: DataFrame, grants: DataFrame, user_key: str, level: str,
                     module_key: str, required: str, enabled: str) -> DataFrame:
    """Modules a user may open: module enabled AND user level >= required
    level AND a per-user grant. The level test is an equi-join on the
    user's levels 0..level (bounded fan-out)."""
    from furrow.operators.joins import inequality_join

    m = modules.where(F.col(enabled))
    ok = inequality_join(users, m, level, required)
    return ok.join(grants.select(user_key, module_key), [user_key, module_key], "left_semi")
