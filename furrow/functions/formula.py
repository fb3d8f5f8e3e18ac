"""Stored formulas (§2.3 ``formula_eval``): formula text kept as data in a
small configuration table, evaluated as Spark SQL expressions.

Each formula is checked against a whitelist (input names, numbers,
+ - * / ( ) and ROUND) before it reaches ``F.expr``; each distinct formula
text of the configuration is compiled once and applied to all keys that
have it, so the evaluation itself stays JVM-side for every row.

``formula_join`` is for a configuration of any size: keys are joined, and
only the distinct formula texts reach the driver. ``formula_eval`` puts the keys
into the expression, for small configurations.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.session import written_table

# Distinct formula texts that one expression takes.
MAX_FORMULAS = 1000

_TOKEN = re.compile(r"\s*(?:(ROUND)\b|([A-Za-z_][A-Za-z0-9_]*)|(\d+(?:\.\d+)?)|([-+*/(),]))")


def compile_formula(text: str, inputs: dict[str, str]) -> str:
    """Whitelisted formula -> Spark SQL text with input names mapped to
    backticked columns; raises ValueError on anything else."""
    out, pos = [], 0
    while pos < len(text):
        if text[pos:].strip() == "":
            break
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(f"formula {text!r}: unexpected text at {pos}")
        fn, name, num, op = m.groups()
        if fn:
            out.append("ROUND")
        elif name:
            if name not in inputs:
                raise ValueError(f"formula {text!r}: unknown input {name!r}")
            out.append(f"`{inputs[name]}`")
        else:
            out.append(num or op)
        pos = m.end()
    return " ".join(out)


def formula_eval(df: DataFrame, config: DataFrame, key: str, formula_col: str, inputs: dict[str, str]) -> Column:
    """A Column over ``df`` (``key`` must exist in both): one branch per
    distinct formula text, chosen by the configuration keys that have it. The
    keys become part of the plan: for small configurations."""
    rows = config.select(key, formula_col).distinct().collect()
    keys_of: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), str(r[1]))):
        if r[0] is not None and r[1] is not None:
            keys_of.setdefault(r[1], []).append(r[0])
    expr = F.when(F.lit(False), F.lit(None))
    for text, keys in keys_of.items():
        expr = expr.when(F.col(key).isin(*keys), F.expr(compile_formula(text, inputs)))
    return expr


def formula_join(df: DataFrame, config: DataFrame, key: str, formula_col: str, inputs: dict[str, str], out: str) -> DataFrame:
    """``df`` with ``out``, the value of the formula that ``config`` gives for the row's ``key`` (NULL without one; of
    several the alphabetically first). The configuration is joined; each distinct text, at most ``MAX_FORMULAS``, is a
    branch on its number, and all texts are compiled before any row is read."""
    spark = df.sparkSession
    cfg = config.where(F.col(key).isNotNull() & F.col(formula_col).isNotNull()).groupBy(F.col(key).alias("_key")) \
        .agg(F.min(formula_col).alias("_text"))
    texts = sorted(r[0] for r in cfg.select("_text").distinct().limit(MAX_FORMULAS + 1).collect())
    if len(texts) > MAX_FORMULAS:
        raise ValueError(f"more than {MAX_FORMULAS} different formulas")
    compiled = [F.expr(compile_formula(t, inputs)) for t in texts]
    numbers = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "_text string, _formula int")
    # written, so that the rows of a frequent key can be split over tasks in the join
    cfg = written_table(cfg.join(F.broadcast(numbers), "_text").select("_key", "_formula"), "formulas")
    value = F.when(F.lit(False), F.lit(None).cast("double"))
    for i, e in enumerate(compiled):
        value = value.when(F.col("_formula") == i, e)
    j = df.join(cfg, df[key] == cfg["_key"], "left")
    return j.select(*[df[c] for c in df.columns], value.alias(out))
