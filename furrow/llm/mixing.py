"""Mixing sources to target weights by iterative proportional fitting.

Token totals of the (source, lang, topic) cells are raked until their marginals meet the targets of every source,
language and topic. A cell's calibration factor is its raked over its own weight; the sampling probability of a
document is its cell's factor, scaled so that the largest factor is 1: the expected token mix is the raked one. A
document is kept if a hash of its id, uniform in [0, 1), is below its probability, so the choice doesn't depend on
partitions or repeats, and a larger probability keeps a superset.

Targets: each value's share of tokens to the power ``ALPHA`` (temperature), normalised; a caller may pass his own
target tables instead.

The cells are a contingency table. Up to ``LOCAL_CELLS`` of them, raking runs on arrays in the driver; a larger
table is raked by Spark with the same rounds. Tokens are runs of other than ASCII white space.

Cases: null source or lang are a value of their own ('' in the result stays null in the row); null text has no tokens,
counts as weight zero and has its cell's probability; a table without any token keeps every document; repeated rows share
one fate; an empty table gives no rows; further columns are ignored by the report and kept by the sampler.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import quoted, written

ALPHA = 0.9
ROUNDS = 25
LOCAL_CELLS = 200_000
DIMS = ("source", "lang", "topic")

# Topics by what a text holds; the first that applies. Fixed values: (topic, one of these parts, then this pattern if any).
TOPICS = (
    ("licence", ("icensed under", "eleased under the", "ublic License"), None),
    ("table", ("|",), r"\|[^|\n]*\|"),
    ("contact", ("@",), r"[A-Za-z0-9._-]@[A-Za-z0-9-]+\.[a-z]"),
    ("emphatic", ("!!", "###", "$$$", "%%%"), None),
)
OTHER_TOPIC = "prose"


def n_tokens(text: Column) -> Column:
    """Runs of other than ASCII white space: each with the white space around it becomes one letter."""
    marks = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.when(marks.startswith("x"), F.length(marks)).otherwise(0)


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, parts, pattern in reversed(TOPICS):
        has = text.contains(parts[0])
        for p in parts[1:]:
            has = has | text.contains(p)
        out = F.when(has if pattern is None else has & text.rlike(pattern), name).otherwise(out)
    return out


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """(value, target): shares of the dimension's token totals to the power alpha, which sum to 1."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("base").alias("s")).where("s > 0")
    raw = sums.select("value", F.pow(F.col("s").cast("double"), F.lit(alpha)).alias("p"))
    total = raw.agg(F.sum("p")).first()[0]
    return raw.select("value", (F.col("p") / F.lit(total)).alias("target"))


def rake_local(values: list[np.ndarray], base: np.ndarray, targets: list[dict], rounds: int) -> np.ndarray:
    """Raked weights of the cells; ``values``: per dimension the value of each cell."""
    w = base / base.sum()
    for _ in range(rounds):
        for col, target in zip(values, targets):
            names, code = np.unique(col, return_inverse=True)
            sums = np.bincount(code, weights=w, minlength=len(names))
            want = np.array([target.get(n, 0.0) for n in names])
            w = w * np.divide(want, sums, out=np.zeros(len(names)), where=sums > 0)[code]
    return w


def rake_spark(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """The same by joins with each dimension's factors; a table is written every round to cut the lineage."""
    total = cells.agg(F.sum("base")).first()[0]
    w = cells.withColumn("w", F.col("base") / F.lit(float(total)))
    for _ in range(rounds):
        for dim, target in targets.items():
            f = w.groupBy(dim).agg(F.sum("w").alias("s")).join(target, F.col(dim) == F.col("value"), "left")
            f = f.select(F.col(dim).alias("_v"), F.when(F.col("s") > 0, F.coalesce("target", F.lit(0.0)) / F.col("s"))
                         .otherwise(0.0).alias("_f"))
            w = w.join(f, F.col(dim) == F.col("_v")).withColumn("w", F.col("w") * F.col("_f")).drop("_v", "_f")
        w = written(w, "raked")
    return w


def calibrated(tokens: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA,
               rounds: int = ROUNDS, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """(source, lang, topic, factor, prob) of every cell of ``tokens`` (source, lang, topic, n_tokens), nulls as ''."""
    dims = list(DIMS)
    cells = written(tokens.groupBy(*dims).agg(F.sum("n_tokens").alias("base")), "cells")
    spark = tokens.sparkSession
    filled = cells.where("base > 0")
    n = filled.count()
    if not n:
        return cells.select(*dims, F.lit(1.0).alias("factor"), F.lit(1.0).alias("prob"))
    goals = targets or {d: tempered(filled, d, alpha) for d in dims}
    if n <= local_cells:
        rows = sorted(filled.collect(), key=lambda r: [r[d] for d in dims])
        base = np.array([r.base for r in rows], float)
        values = [np.array([r[d] for r in rows], object) for d in dims]
        wanted = [{r.value: r.target for r in goals[d].collect()} for d in dims]  # values of cells, or the caller's
        factor = rake_local(values, base, wanted, rounds) / (base / base.sum())
        raked = spark.createDataFrame([(*[r[d] for d in dims], float(f)) for r, f in zip(rows, factor)],
                                      ", ".join(f"{d} string" for d in dims) + ", factor double").coalesce(1)
    else:
        total = float(filled.agg(F.sum("base")).first()[0])
        raked = rake_spark(filled, {d: written(goals[d], "targets") for d in dims}, rounds) \
            .select(*dims, (F.col("w") / (F.col("base") / total)).alias("factor"))
    top = raked.agg(F.max("factor")).first()[0]
    keys = [cells[d].eqNullSafe(raked[d]) for d in dims]
    return cells.join(raked, keys[0] & keys[1] & keys[2], "left").select(
        *[cells[d] for d in dims], F.coalesce("factor", F.lit(float(top))).alias("factor"),
        F.coalesce(F.col("factor") / F.lit(float(top)), F.lit(1.0)).alias("prob"))


def uniform(doc_id: Column) -> Column:
    """In [0, 1), from the first 32 bits of an MD5 of the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), topic_of(F.col("text")).alias("topic"),
        n_tokens(F.col("text")).cast("long").alias("n_tokens"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_tokens, prob (6 decimals), kept."""
    rows = written(_tokens(docs), "mix")
    cells = calibrated(rows, **options)
    out = rows.join(F.broadcast(cells) if _few(cells) else cells, list(DIMS))
    return out.select("doc_id", *DIMS, "n_tokens", F.round("prob", 6).alias("prob"),
                      (uniform(F.col("doc_id")) < F.col("prob")).alias("kept"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    cells = calibrated(_tokens(docs).drop("doc_id"), **options)
    cells = cells.select(*[F.col(d).alias(f"_furrow_{d}") for d in DIMS], F.col("prob").alias("_furrow_prob"))
    same = (F.coalesce(F.col("source").cast("string"), F.lit("")) == F.col("_furrow_source")) \
        & (F.coalesce(F.col("lang").cast("string"), F.lit("")) == F.col("_furrow_lang")) \
        & (topic_of(F.col("text")) == F.col("_furrow_topic"))
    out = docs.join(F.broadcast(cells) if _few(cells) else cells, same)
    return out.where(uniform(F.col("doc_id")) < F.col("_furrow_prob")).select(*[quoted(c) for c in docs.columns])


def _few(cells: DataFrame) -> bool:
    return cells.count() <= LOCAL_CELLS


def oracle_sql() -> str:
    """The report in DuckDB SQL: the raking as a chain of window sums."""
    def holds(parts, pattern):
        some = " OR ".join(f"contains(text, '{p}')" for p in parts)
        return f"({some})" + (f" AND regexp_matches(text, '{pattern}')" if pattern else "")

    topic = "CASE " + " ".join(f"WHEN {holds(p, r)} THEN '{n}'" for n, p, r in TOPICS) + f" ELSE '{OTHER_TOPIC}' END"
    parts = [f"""rows AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents)""",
             """cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS base FROM rows
  GROUP BY ALL HAVING sum(n_tokens) > 0)"""]
    for d in DIMS:
        parts.append(f"""target_{d} AS (SELECT {d} AS v, pow(sum(base), {ALPHA}) / sum(pow(sum(base), {ALPHA})) OVER () AS t
  FROM cells GROUP BY {d})""")
    parts.append("""w0 AS (SELECT c.*, base / sum(base) OVER () AS w, a.t AS t_source, b.t AS t_lang, d.t AS t_topic
  FROM cells c JOIN target_source a ON a.v = source JOIN target_lang b ON b.v = lang JOIN target_topic d ON d.v = topic)""")
    step = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            step += 1
            parts.append(f"""w{step} AS (SELECT source, lang, topic, base, t_source, t_lang, t_topic,
  w * t_{d} / sum(w) OVER (PARTITION BY {d}) AS w FROM w{step - 1})""")
    parts.append(f"f AS (SELECT source, lang, topic, w / (base / sum(base) OVER ()) AS factor FROM w{step})")
    parts.append("p AS (SELECT source, lang, topic, factor / max(factor) OVER () AS prob FROM f)")
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(prob, 1.0), 6) AS prob,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(prob, 1.0) AS kept
FROM rows LEFT JOIN p USING (source, lang, topic)"""
