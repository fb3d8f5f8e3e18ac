"""Set operations (§2.9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def except_keys(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b`` (anti join, NULL-safe)."""
    return a.join(b.select(*keys).where(F.coalesce(*[F.col(k).isNotNull() for k in keys])), list(keys), "left_anti")


def union_keys(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    return a.select(*keys).unionByName(b.select(*keys)).distinct()


def distinct_pairs(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).dropDuplicates(list(cols))


def snapshot_diff(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Keys only in ``a`` ('only_a') or only in ``b`` ('only_b')."""
    ka = a.select(*keys).distinct()
    kb = b.select(*keys).distinct()
    return ka.join(kb, list(keys), "left_anti").withColumn("side", F.lit("only_a")).unionByName(
        kb.join(ka, list(keys), "left_anti").withColumn("side", F.lit("only_b"))
    )


def set_changes(current: DataFrame, wanted: DataFrame, keys, cols) -> DataFrame:
    """What makes ``current`` equal ``wanted``: one row per key that differs, with
    op 'insert', 'update' or 'delete' and the wanted values (NULL for 'delete').
    Keys are unique in both and not NULL; of equal sets there are no changes."""
    a = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in cols], F.lit(True).alias("_has"))
    b = wanted.select(*keys, *cols, F.lit(True).alias("_wants"))
    j = a.join(b, list(keys), "full")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    op = F.when(F.col("_has").isNull(), "insert").when(F.col("_wants").isNull(), "delete").when(~same, "update")
    return j.withColumn("op", op).where(F.col("op").isNotNull()).select(*keys, *cols, "op")


def apply_changes(current: DataFrame, changes: DataFrame, keys, cols) -> DataFrame:
    """``current`` after ``set_changes``."""
    kept = current.select(*keys, *cols).join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes.where(F.col("op") != "delete").select(*keys, *cols))
