"""Grow / pack aggregates, stored formulas and set-once audits bound to
the given tables (§2.3 formula_eval, §2.6, §2.11 audit_set_once)."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions.formula import formula_join
from furrow.operators import aggregates as agg
from furrow.operators import rules
from furrow.plans.registry import register
from furrow.sources.tables import Tables


@register("block_extent", """
WITH s AS (SELECT l_suppkey AS site, l_returnflag AS block, l_partkey AS rn, l_orderkey, l_linenumber,
                  lag(l_partkey) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS prev FROM lineitem),
g AS (SELECT site, block, min(rn) AS row_from, max(rn) AS row_to, SUM(CASE WHEN rn > prev THEN 1 ELSE 0 END) AS up,
             SUM(CASE WHEN rn < prev THEN 1 ELSE 0 END) AS down, min((l_orderkey, l_linenumber)) AS first_seen FROM s GROUP BY 1, 2)
SELECT site, block, dense_rank() OVER (PARTITION BY site ORDER BY first_seen) AS block_number, row_from, row_to,
       CASE WHEN up >= down THEN 'Forward' ELSE 'Reverse' END AS direction FROM g""")
def q_block_extent(spark, d):
    li = Tables(spark, d).lineitem.select(F.col("l_suppkey").alias("site"), F.col("l_returnflag").alias("block"), F.col("l_partkey").alias("rn"),
                                          "l_orderkey", "l_linenumber")
    out = agg.block_extent(li, "site", "block", ["l_orderkey", "l_linenumber", "rn"], "rn", ["l_orderkey", "l_linenumber"],
                           bucket=F.floor(F.col("l_orderkey") / 10_000))
    return out.withColumn("block_number", F.col("block_number").cast("long"))


@register("planned_capacity", """
WITH x AS (SELECT l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag || '/' || l_linestatus ELSE l_returnflag END AS cell,
                  CAST(l_quantity AS DECIMAL(18,4)) AS q FROM lineitem),
e AS (SELECT l_suppkey, trim(unnest(string_split(cell, '/'))) AS variety, q,
             CAST(CAST(1 AS DECIMAL(10,4)) / CAST(len(string_split(cell, '/')) AS DECIMAL(10,4)) AS DECIMAL(10,4)) AS share FROM x)
SELECT l_suppkey, variety, CAST(SUM(q * share) AS DECIMAL(18,4)) AS l_quantity, CAST(SUM(share) AS DECIMAL(18,4)) AS rows FROM e GROUP BY 1, 2""")
def q_planned_capacity(spark, d):
    li = Tables(spark, d).lineitem.withColumn(
        "cell", F.when(F.col("l_linenumber") % 2 == 0, F.concat_ws("/", "l_returnflag", "l_linestatus")).otherwise(F.col("l_returnflag")))
    return agg.planned_capacity(li, ["l_suppkey"], "cell", "l_quantity")


@register("daily_packer_rollup", """
WITH x AS (SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey, l_orderkey, l_linenumber, l_partkey, 'accepted' AS product,
                  CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS qty FROM lineitem
           UNION ALL SELECT CAST(l_shipdate AS DATE), l_suppkey, l_orderkey, l_linenumber, l_partkey, 'returned',
                  CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END FROM lineitem)
SELECT day, product, SUM(qty) AS total, arg_min(l_suppkey, (l_orderkey, l_linenumber, l_partkey)) AS first_reporter FROM x
GROUP BY 1, 2 HAVING SUM(qty) > 0""")
def q_daily_packer_rollup(spark, d):
    li = Tables(spark, d).lineitem.select(
        F.col("l_shipdate").cast("date").alias("day"), "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0).alias("acc"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("ret"))
    return agg.daily_packer_rollup(li, "day", {"accepted": "acc", "returned": "ret"}, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"])


# Fixed binding values: one stored formula per part type (inputs a, b, c).
TYPE_FORMULAS = {"ECONOMY": "ROUND(a*2+b)*3+48", "LARGE": "(a/(b*c+1))*100", "MEDIUM": "a*3+1", "PROMO": "ROUND(a/4)",
                 "SMALL": "(a+b)/(c+1)", "STANDARD": "a"}


@register("formula_eval", """
SELECT l.l_orderkey, l.l_linenumber, CASE p.p_type WHEN 'ECONOMY' THEN ROUND(l.l_quantity*2+l.l_discount)*3+48
  WHEN 'LARGE' THEN (l.l_quantity/(l.l_discount*l.l_tax+1))*100 WHEN 'MEDIUM' THEN l.l_quantity*3+1 WHEN 'PROMO' THEN ROUND(l.l_quantity/4)
  WHEN 'SMALL' THEN (l.l_quantity+l.l_discount)/(l.l_tax+1) WHEN 'STANDARD' THEN l.l_quantity END AS net_weight
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def q_formula_eval(spark, d):
    t = Tables(spark, d)
    cfg = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in TYPE_FORMULAS.items()) + " AS t(p_type, formula)")
    j = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    e = formula_join(j, cfg, "p_type", "formula", {"a": "l_quantity", "b": "l_discount", "c": "l_tax"}, "net_weight")
    return e.select("l_orderkey", "l_linenumber", F.col("net_weight").cast("double").alias("net_weight"))


@register("audit_set_once", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS started_at,
                  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS stopped_at, o_orderkey % 50 = 0 AS m1, o_orderkey % 77 = 0 AS m2
           FROM orders),
n AS (SELECT o_orderkey, CASE WHEN m1 AND started_at IS NOT NULL THEN started_at + INTERVAL 1 DAY WHEN m2 THEN NULL ELSE started_at END AS started_at,
             CASE WHEN m2 THEN COALESCE(stopped_at, TIMESTAMP '2002-01-01 00:00:00') ELSE stopped_at END AS stopped_at FROM o)
SELECT o.o_orderkey, 'started_at' AS column, CAST(o.started_at AS VARCHAR) AS old_value, CAST(n.started_at AS VARCHAR) AS new_value, 'set_once' AS rule
FROM o JOIN n USING (o_orderkey) WHERE o.started_at IS NOT NULL AND o.started_at IS DISTINCT FROM n.started_at
UNION ALL
SELECT o.o_orderkey, 'stopped_at', CAST(o.stopped_at AS VARCHAR), CAST(n.stopped_at AS VARCHAR), 'set_once'
FROM o JOIN n USING (o_orderkey) WHERE o.stopped_at IS NOT NULL AND o.stopped_at IS DISTINCT FROM n.stopped_at
UNION ALL
SELECT o_orderkey, 'stopped_at', NULL, CAST(stopped_at AS VARCHAR), 'requires_started_at' FROM n WHERE stopped_at IS NOT NULL AND started_at IS NULL""")
def q_audit_set_once(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("started_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("stopped_at"),
        (F.col("o_orderkey") % 50 == 0).alias("m1"), (F.col("o_orderkey") % 77 == 0).alias("m2"))
    new = o.select("o_orderkey",
                   F.when(F.col("m1") & F.col("started_at").isNotNull(), F.col("started_at") + F.expr("INTERVAL 1 DAY"))
                   .when(F.col("m2"), F.lit(None)).otherwise(F.col("started_at")).alias("started_at"),
                   F.when(F.col("m2"), F.coalesce(F.col("stopped_at"), F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"))).otherwise(F.col("stopped_at"))
                   .alias("stopped_at"))
    return rules.audit_set_once(o.select("o_orderkey", "started_at", "stopped_at"), new, "o_orderkey", ["started_at", "stopped_at"],
                                requires={"stopped_at": "started_at"})
