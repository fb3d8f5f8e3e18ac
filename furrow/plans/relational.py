"""Row, join, aggregate, window, sort and set operators (§2.4–2.9) bound
to the given tables, one registered query each, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators import aggregates as agg
from furrow.operators import joins as jn
from furrow.operators import rows
from furrow.operators import setops
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.sources.tables import Tables

# ---------------------------------------------------------------- §2.4 rows


@register("filter_soft_delete", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_returnflag = 'R')""")
def q_filter_soft_delete(spark, d):
    li = Tables(spark, d).lineitem.withColumn("is_deleted", F.col("l_returnflag") == "R")
    return rows.filter_soft_delete(li).select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_active_asof", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate IS NULL OR CAST(o_orderdate AS DATE) > DATE '2000-06-30'""")
def q_filter_active_asof(spark, d):
    o = Tables(spark, d).orders
    return rows.filter_active_asof(o, "o_orderdate", "2000-06-30").select("o_orderkey", "o_custkey")


@register("filter_domain", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IS DISTINCT FROM 'P'""")
def q_filter_domain(spark, d):
    o = Tables(spark, d).orders
    o = rows.filter_domain(o, "o_orderpriority", allow=["1-URGENT", "2-HIGH"])
    return rows.filter_domain(o, "o_orderstatus", deny=["P"], null_ok=True).select("o_orderkey", "o_orderpriority", "o_orderstatus")


QUARANTINE_SQL = """
WITH tagged AS (
  SELECT *, CASE WHEN l_discount = 0 THEN 'no_discount' WHEN l_quantity > 45 THEN 'bulk_quantity'
                 WHEN l_returnflag = 'R' THEN 'returned' END AS reason
  FROM lineitem)"""


def _quarantine(spark, d):
    li = Tables(spark, d).lineitem
    return rows.quarantine(li, [
        ("no_discount", F.col("l_discount") == 0, F.col("l_orderkey")),
        ("bulk_quantity", F.col("l_quantity") > 45, F.col("l_quantity")),
        ("returned", F.col("l_returnflag") == "R", None),
    ])


@register("quarantine", QUARANTINE_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, reason FROM tagged WHERE reason IS NOT NULL""")
def q_quarantine(spark, d):
    kept, rejected = _quarantine(spark, d)
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", "reason")


@register("load_counters", QUARANTINE_SQL + """
SELECT COALESCE(reason, 'kept') AS reason, COUNT(*) AS n_rows FROM tagged GROUP BY 1""")
def q_load_counters(spark, d):
    kept, rejected = _quarantine(spark, d)
    counts = agg.load_counters(rejected, "reason")
    return counts.unionByName(kept.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reason", F.lit("kept")))


@register("known_key_filter", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)""")
def q_known_key_filter(spark, d):
    t = Tables(spark, d)
    ref = t.part.where(F.col("p_size") > 25).select(F.col("p_partkey").alias("l_partkey"))
    return rows.known_key_filter(t.lineitem, ref, ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@register("catch_all_member", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_mktsegment ELSE 'other' END AS segment
FROM customer""")
def q_catch_all_member(spark, d):
    c = Tables(spark, d).customer
    known = F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD")
    return c.select("c_custkey", rows.catch_all_member(F.when(known, F.col("c_mktsegment"))).alias("segment"))


@register("skip_all_null_group", """
SELECT l_orderkey, l_linenumber, disc, tax FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_discount END AS disc,
         CASE WHEN l_tax > 0.04 THEN l_tax END AS tax FROM lineitem) WHERE COALESCE(disc, tax) IS NOT NULL""")
def q_skip_all_null_group(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("disc"),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("tax"))
    return rows.skip_all_null_group(li, ["disc", "tax"])


@register("keep_nonzero", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0""")
def q_keep_nonzero(spark, d):
    return rows.keep_nonzero(Tables(spark, d).lineitem, "l_discount").select("l_orderkey", "l_linenumber", "l_discount")


@register("filter_planned_only", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE (CASE WHEN l_linenumber > 3 THEN l_orderkey END) IS NULL AND l_shipdate IS NOT NULL""")
def q_filter_planned_only(spark, d):
    li = Tables(spark, d).lineitem.withColumn("tracker_id", F.when(F.col("l_linenumber") > 3, F.col("l_orderkey")))
    return rows.filter_planned_only(li, "tracker_id", "l_shipdate").select("l_orderkey", "l_linenumber")


@register("project_map", """
SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, 'sheet' AS source,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders""")
def q_project_map(spark, d):
    o = Tables(spark, d).orders
    return rows.project_map(o, {"id": "o_orderkey", "customer_id": "o_custkey", "order_date": F.col("o_orderdate").cast("date"),
                                "source": "sheet", "amount": F.col("o_totalprice").cast("decimal(18,2)")})


# ---------------------------------------------------------------- §2.5 joins


@register("lookup_join", """
WITH dim AS (SELECT lower(trim(p_name)) AS k, min(p_partkey) AS canonical_id FROM part GROUP BY 1)
SELECT p.p_partkey, dim.canonical_id FROM part p LEFT JOIN dim ON lower(trim(p.p_name)) = dim.k""")
def q_lookup_join(spark, d):
    p = Tables(spark, d).part
    dim = p.select("p_name", F.col("p_partkey").alias("canonical_id"))
    return jn.lookup_join(p.select("p_partkey", "p_name"), dim, "p_name", "p_name", ["canonical_id"], on_duplicate="first",
                          order=["canonical_id"]).select("p_partkey", "canonical_id")


@register("lookup_join_last", """
WITH dim AS (SELECT lower(trim(p_name)) AS k, max(p_partkey) AS canonical_id FROM part GROUP BY 1)
SELECT p.p_partkey, dim.canonical_id FROM part p LEFT JOIN dim ON lower(trim(p.p_name)) = dim.k""")
def q_lookup_join_last(spark, d):
    p = Tables(spark, d).part
    dim = p.select("p_name", F.col("p_partkey").alias("canonical_id"))
    return jn.lookup_join(p.select("p_partkey", "p_name"), dim, "p_name", "p_name", ["canonical_id"], on_duplicate="last",
                          order=["canonical_id"]).select("p_partkey", "canonical_id")


@register("lookup_join_priority", """
WITH dim AS (SELECT lower(trim(p_name)) AS k,
                    arg_min(p_partkey, (CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END, p_partkey)) AS canonical_id
             FROM part GROUP BY 1)
SELECT p.p_partkey, dim.canonical_id FROM part p LEFT JOIN dim ON lower(trim(p.p_name)) = dim.k""")
def q_lookup_join_priority(spark, d):
    """Preferred-category rule: among parts sharing a name, PROMO beats SMALL
    beats the rest, then the smallest key."""
    p = Tables(spark, d).part
    dim = p.select("p_name", "p_type", F.col("p_partkey").alias("canonical_id"))
    return jn.lookup_join(p.select("p_partkey", "p_name"), dim, "p_name", "p_name", ["canonical_id"], on_duplicate="priority",
                          order=["canonical_id"], priority=("p_type", ["PROMO", "SMALL"])).select("p_partkey", "canonical_id")


@register("cascade_lookup", """
SELECT l.l_orderkey, l.l_linenumber, COALESCE(p.p_name, s.s_name) AS resolved
FROM lineitem l
LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS k, min(p_name) AS p_name FROM part WHERE p_size > 40 GROUP BY 1) p
  ON lower(trim(CAST(l.l_partkey AS VARCHAR))) = p.k
LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS k, min(s_name) AS s_name FROM supplier GROUP BY 1) s
  ON lower(trim(CAST(l.l_suppkey AS VARCHAR))) = s.k""")
def q_cascade_lookup(spark, d):
    t = Tables(spark, d)
    steps = [(t.part.where(F.col("p_size") > 40), "l_partkey", "p_partkey", "p_name"), (t.supplier, "l_suppkey", "s_suppkey", "s_name")]
    return jn.cascade_lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), steps, "resolved") \
        .select("l_orderkey", "l_linenumber", "resolved")


@register("multi_alias_lookup", """
WITH al AS (
  SELECT c_custkey AS id, 1 AS p, lower(trim(c_name)) AS a FROM customer
  UNION ALL SELECT c_custkey, 2, lower(trim(c_mktsegment)) FROM customer
  UNION ALL SELECT c_custkey, 3, lower(trim('nation ' || CAST(c_nationkey AS VARCHAR))) FROM customer),
best AS (SELECT a, min(p) AS bp FROM al GROUP BY a),
pairs AS (SELECT DISTINCT al.a, al.id FROM al JOIN best ON al.a = best.a AND al.p = best.bp),
n AS (SELECT a, COUNT(*) AS n_ids FROM pairs GROUP BY a HAVING COUNT(*) > 1)
SELECT pairs.a AS alias, pairs.id AS id, n.n_ids FROM pairs JOIN n USING (a)""")
def q_multi_alias_lookup(spark, d):
    c = Tables(spark, d).customer
    aliases = [(1, F.col("c_name")), (2, F.col("c_mktsegment")), (3, F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")))]
    _, collisions = jn.multi_alias_lookup(c.select("c_name"), "c_name", c, "c_custkey", aliases, "employee_id")
    return collisions


@register("multi_alias_lookup_resolve", """
WITH al AS (
  SELECT c_custkey AS id, 1 AS p, lower(trim(c_name)) AS a FROM customer
  UNION ALL SELECT c_custkey, 2, lower(trim(c_mktsegment)) FROM customer),
best AS (SELECT a, arg_min(id, (p, id)) AS id FROM al GROUP BY a)
SELECT o.o_orderkey, best.id AS employee_id FROM orders o
LEFT JOIN best ON lower(trim(CASE WHEN o.o_orderstatus = 'F' THEN 'Customer#' || lpad(CAST(o.o_custkey AS VARCHAR), 9, '0')
                                  ELSE o.o_orderpriority END)) = best.a""")
def q_multi_alias_resolve(spark, d):
    t = Tables(spark, d)
    c = t.customer
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
                        .otherwise(F.col("o_orderpriority")).alias("name"))
    joined, _ = jn.multi_alias_lookup(o, "name", c, "c_custkey", [(1, F.col("c_name")), (2, F.col("c_mktsegment"))], "employee_id")
    return joined.select("o_orderkey", "employee_id")


@register("star_left_join", """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand, s.s_name, o.o_custkey
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_star_left_join(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dims = [(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
            (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
            (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")]
    return jn.star_left_join(li, dims).select("l_orderkey", "l_linenumber", "p_brand", "s_name", "o_custkey")


@register("inner_join_multi", """
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_inner_join_multi(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return jn.inner_join_multi(c, [(t.nation, "n_nationkey"), (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")]) \
        .select("c_custkey", "n_name", "r_name")


@register("inequality_join", """
SELECT c.c_custkey, COUNT(*) AS n_modules
FROM customer c JOIN nation n ON c.c_nationkey // 5 >= n.n_regionkey
GROUP BY c.c_custkey""")
def q_inequality_join(spark, d):
    t = Tables(spark, d)
    users = t.customer.select("c_custkey", (F.col("c_nationkey") / 5).cast("int").alias("level"))
    modules = t.nation.select("n_nationkey", F.col("n_regionkey").alias("required"))
    return jn.inequality_join(users, modules, "level", "required").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_modules"))


@register("range_join", """
WITH p AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS ps,
                  last_day(CAST(date_trunc('month', o_orderdate) AS DATE)) AS pe FROM orders)
SELECT p.o_custkey, p.ps, COUNT(*) AS n_lines, SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS qty
FROM p JOIN lineitem l ON l.l_partkey = p.o_custkey AND CAST(l.l_shipdate AS DATE) BETWEEN p.ps AND p.pe
GROUP BY 1, 2""")
def q_range_join(spark, d):
    t = Tables(spark, d)
    ps = F.trunc(F.col("o_orderdate").cast("date"), "month")
    periods = t.orders.select("o_custkey", ps.alias("ps"), F.last_day(ps).alias("pe"))
    pts = t.lineitem.select(F.col("l_partkey").alias("o_custkey"), "l_shipdate", "l_quantity")
    j = jn.range_join(pts, periods, ["o_custkey"], "l_shipdate", "ps", "pe")
    return j.groupBy("o_custkey", "ps").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty"))


@register("asof_next", """
SELECT o.o_orderkey, (SELECT min(e.o_orderdate) FROM orders e WHERE e.o_custkey = o.o_custkey AND e.o_orderstatus = 'F'
                      AND e.o_orderdate >= o.o_orderdate) AS next_event
FROM orders o""")
def q_asof_next(spark, d):
    o = Tables(spark, d).orders
    ev = o.where(F.col("o_orderstatus") == "F").select("o_custkey", F.col("o_orderdate").alias("ev_date"))
    return jn.asof_next_bucketed(o.select("o_orderkey", "o_custkey", "o_orderdate"), ev, ["o_custkey"], "o_orderdate", "ev_date") \
        .select("o_orderkey", "next_event")


@register("latest_per_key_join", """
WITH s AS (SELECT l_partkey, l_shipdate, l_quantity FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC NULLS FIRST, l_orderkey DESC,
                                      l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT p.p_partkey, s.l_shipdate, s.l_quantity FROM part p LEFT JOIN s ON s.l_partkey = p.p_partkey""")
def q_latest_per_key_join(spark, d):
    t = Tables(spark, d)
    snaps = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_shipdate", "l_quantity", "l_orderkey", "l_linenumber",
                              "l_suppkey", "l_extendedprice")
    j = jn.latest_per_key_join(t.part.select("p_partkey"), snaps, ["p_partkey"],
                               ["-l_shipdate", "-l_orderkey", "-l_linenumber", "-l_suppkey", "-l_extendedprice"])
    return j.select("p_partkey", "l_shipdate", "l_quantity")


@register("semi_join_exists", """
SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'
  AND o.o_orderstatus = 'O')""")
def q_semi_join_exists(spark, d):
    t = Tables(spark, d)
    o = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")).select(F.col("o_custkey").alias("c_custkey"))
    return jn.semi_join_exists(t.customer.select("c_custkey"), o, "c_custkey")


@register("anti_join", """
SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 2000)""")
def q_anti_join(spark, d):
    t = Tables(spark, d)
    o = t.orders.where(F.year("o_orderdate") == 2000).select(F.col("o_custkey").alias("c_custkey"))
    return jn.anti_join(t.customer.select("c_custkey"), o, "c_custkey")


@register("not_in_cleanup", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48 AND l_partkey IS NOT NULL)""")
def q_not_in_cleanup(spark, d):
    t = Tables(spark, d)
    ref = t.lineitem.where(F.col("l_quantity") > 48)
    return jn.not_in_cleanup(t.part.select("p_partkey"), ref, "p_partkey", "l_partkey", keep=False)


@register("full_outer_compare", """
WITH c AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1),
     p AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
SELECT COALESCE(c.o_custkey, p.o_custkey) AS o_custkey, c.amount AS c_amount, p.amount AS p_amount,
       COALESCE(c.amount, 0) - COALESCE(p.amount, 0) AS amount_delta
FROM c FULL OUTER JOIN p ON c.o_custkey = p.o_custkey""")
def q_full_outer_compare(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))

    def yr(y):
        return o.where(F.year("o_orderdate") == y).groupBy("o_custkey").agg(F.sum("amount").alias("amount"))

    j = jn.full_outer_compare(yr(1998), yr(1997), ["o_custkey"], ["amount"])
    return agg.delta_residual(j, ["amount"])


@register("full_outer_nullsafe", """
WITH b AS (SELECT CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_nationkey END AS mgr, c.c_mktsegment AS seg, o.o_orderdate,
                  CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
c AS (SELECT mgr, seg, SUM(amount) AS amount FROM b WHERE year(o_orderdate) = 1998 GROUP BY 1, 2),
p AS (SELECT mgr, seg, SUM(amount) AS amount FROM b WHERE year(o_orderdate) = 1997 GROUP BY 1, 2)
SELECT COALESCE(c.mgr, p.mgr) AS mgr, COALESCE(c.seg, p.seg) AS seg, c.amount AS c_amount, p.amount AS p_amount
FROM c FULL OUTER JOIN p ON c.mgr IS NOT DISTINCT FROM p.mgr AND c.seg = p.seg""")
def q_full_outer_nullsafe(spark, d):
    t = Tables(spark, d)
    o, c = t.orders, t.customer
    b = o.join(c, o.o_custkey == c.c_custkey).select(
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("mgr"), F.col("c_mktsegment").alias("seg"),
        "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))

    def yr(y):
        return b.where(F.year("o_orderdate") == y).groupBy("mgr", "seg").agg(F.sum("amount").alias("amount"))

    return jn.full_outer_compare(yr(1998), yr(1997), ["mgr", "seg"], ["amount"], nullsafe=("mgr",))


@register("cross_scalar", """
SELECT o_orderkey, datediff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS days_before_last FROM orders""")
def q_cross_scalar(spark, d):
    o = Tables(spark, d).orders
    j = jn.cross_scalar(o.select("o_orderkey", "o_orderdate"), o.agg(F.max("o_orderdate").alias("last_date")))
    return j.select("o_orderkey", F.datediff(F.col("last_date"), F.col("o_orderdate")).alias("days_before_last"))


@register("join_using", """
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n_orders FROM orders GROUP BY 1),
     b AS (SELECT CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT a.day, a.n_orders, b.n_lines FROM a LEFT JOIN b USING (day)""")
def q_join_using(spark, d):
    t = Tables(spark, d)
    a = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_lines"))
    return jn.join_using(a, [b], ["day"])


@register("prefix_join", """
SELECT a.n_name AS cell, b.n_name AS code FROM nation a JOIN nation b ON starts_with(b.n_name, a.n_name)""")
def q_prefix_join(spark, d):
    n = Tables(spark, d).nation
    j = jn.prefix_join(n.select(F.col("n_name").alias("cell")), "cell", n.select(F.col("n_name").alias("code")), "code")
    return j.select("cell", "code")


MULTI_CODE_CELL_SQL = ("'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '+' || "
                       "'Supplier#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '_2'")


@register("multi_code_join", f"""
WITH parts AS (SELECT l_orderkey, l_linenumber, lower(trim(unnest(string_split({MULTI_CODE_CELL_SQL}, '+')))) AS part FROM lineitem),
codes AS (SELECT s_suppkey, lower(s_name) AS a FROM supplier UNION SELECT s_suppkey, lower(regexp_replace(s_name, '_\\d+$', '')) FROM supplier)
SELECT p.l_orderkey, p.l_linenumber, array_to_string(list_transform(list_sort(list(DISTINCT c.s_suppkey) FILTER (WHERE c.s_suppkey IS NOT NULL)),
                                                       lambda e: CAST(e AS VARCHAR)), '|') AS matched_ids
FROM parts p LEFT JOIN codes c ON p.part = c.a
GROUP BY ALL""")
def q_multi_code_join(spark, d):
    """Cells of two codes, the line's supplier and another with a suffix; matched for every line."""
    t = Tables(spark, d)
    code = lambda c: F.concat(F.lit("Supplier#"), F.lpad(F.col(c).cast("string"), 9, "0"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(code("l_suppkey"), F.lit("+"), code("l_partkey"), F.lit("_2")).alias("cell"))
    j = jn.multi_code_join(li, "cell", t.supplier, "s_name", "s_suppkey", keys=["l_orderkey", "l_linenumber"])
    return j.withColumn("matched_ids", F.array_join(F.transform("matched_ids", lambda e: e.cast("string")), "|"))


@register("strip_prefix_retry_join", """
WITH dim AS (SELECT upper(p_name) AS k, min(p_partkey) AS v FROM part GROUP BY 1),
f AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'S-' ELSE '' END || upper(p.p_name) AS code
      FROM orders JOIN part p ON p.p_partkey = o_custkey)
SELECT f.o_orderkey, COALESCE(d1.v, d2.v) AS part_id FROM f LEFT JOIN dim d1 ON f.code = d1.k
LEFT JOIN dim d2 ON regexp_replace(f.code, '^S-', '') = d2.k""")
def q_strip_prefix_retry_join(spark, d):
    t = Tables(spark, d)
    o, p = t.orders, t.part
    f = o.join(p, p.p_partkey == o.o_custkey).select(
        "o_orderkey", F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("S-")).otherwise(F.lit("")), F.upper("p_name")).alias("code"))
    return jn.strip_prefix_retry_join(f, "code", t.part, "p_name", "p_partkey", out="part_id").select("o_orderkey", "part_id")


@register("contains_lookup", """
SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'Red' WHEN contains(lower(p_name), 'blue') THEN 'Blue'
                       WHEN contains(lower(p_name), 'gear') THEN 'Gear' ELSE 'Other' END AS category FROM part""")
def q_contains_lookup(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", jn.contains_lookup(F.col("p_name"), [("red", "Red"), ("blue", "Blue"), ("gear", "Gear")]).alias("category"))


@register("event_key_match", """
WITH e AS (SELECT date_trunc('second', ts) AS k, CAST(user_id AS VARCHAR) AS w, min(event_id) AS event_match FROM events GROUP BY 1, 2)
SELECT v.event_id, e.event_match FROM events v
LEFT JOIN e ON e.k = date_trunc('second', v.ts) AND e.w = CAST(v.user_id AS VARCHAR)""")
def q_event_key_match(spark, d):
    ev = Tables(spark, d).events
    log = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("logged_at"), F.col("user_id").cast("string").alias("who"))
    evs = ev.select(F.col("event_id").alias("eid"), "ts", F.col("user_id").cast("string").alias("uid"))
    return jn.event_key_match(log, evs, "logged_at", "who", "ts", "uid", "eid", out="event_match").select("event_id", "event_match")


@register("self_link", """
SELECT a.c_custkey, b.c_custkey AS manager_id FROM customer a
LEFT JOIN (SELECT c_custkey FROM customer) b ON CAST(a.c_nationkey AS BIGINT) = b.c_custkey""")
def q_self_link(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("mgr_code"))
    return jn.self_link(c, "c_custkey", "mgr_code", "c_custkey", "manager_id").select("c_custkey", "manager_id")


@register("earliest_link", """
SELECT o.o_orderkey, arg_min(l.l_linenumber, (l.l_shipdate, l.l_linenumber)) AS first_line
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""")
def q_earliest_link(spark, d):
    t = Tables(spark, d)
    ev = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber")
    return jn.earliest_link(t.orders.select("o_orderkey"), ev, ["o_orderkey"], "l_shipdate", "l_linenumber", "first_line")


@register("hierarchy_lookup", """
WITH nodes AS (SELECT n_nationkey AS id, n_regionkey + 1000 AS pid, n_name AS name FROM nation
               UNION ALL SELECT r_regionkey + 1000, NULL, r_name FROM region)
SELECT c.c_custkey, n.name AS node_name, p.name AS parent_name FROM customer c
LEFT JOIN nodes n ON n.id = c.c_nationkey LEFT JOIN nodes p ON p.id = n.pid""")
def q_hierarchy_lookup(spark, d):
    t = Tables(spark, d)
    nodes = t.nation.select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 1000).alias("pid"), F.col("n_name").alias("name")) \
        .unionByName(t.region.select((F.col("r_regionkey") + 1000).alias("id"), F.lit(None).cast("int").alias("pid"), F.col("r_name").alias("name")))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("node"))
    return jn.hierarchy_lookup(c, nodes, "node", "id", "pid", "name").select("c_custkey", F.col("node_name"), F.col("parent_name"))


@register("recall_join", """
SELECT h.l_orderkey, CAST(h.l_shipdate AS DATE) AS d, COUNT(*) AS n_sessions
FROM lineitem h JOIN lineitem s ON h.l_orderkey = s.l_orderkey AND CAST(h.l_shipdate AS DATE) = CAST(s.l_shipdate AS DATE)
WHERE h.l_returnflag = 'R' AND s.l_linestatus = 'F' GROUP BY 1, 2""")
def q_recall_join(spark, d):
    li = Tables(spark, d).lineitem.withColumn("d", F.col("l_shipdate").cast("date"))
    holds = li.where(F.col("l_returnflag") == "R").select("l_orderkey", "d")
    sessions = li.where(F.col("l_linestatus") == "F").select("l_orderkey", "d")
    return jn.recall_join(holds, sessions, ["l_orderkey", "d"]).groupBy("l_orderkey", "d").agg(F.count(F.lit(1)).alias("n_sessions"))


@register("two_hop_sync", """
SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS order_date FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_two_hop_sync(spark, d):
    t = Tables(spark, d)
    child = t.lineitem.select("l_orderkey", "l_linenumber")
    parent = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return jn.two_hop_sync(child, parent, "l_orderkey", "o_orderkey", ["order_date"]).select("l_orderkey", "l_linenumber", "order_date")


# ---------------------------------------------------------------- §2.6 aggregates


@register("group_sum", """
SELECT l_returnflag, l_linestatus, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS l_quantity,
       SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS l_extendedprice FROM lineitem GROUP BY 1, 2""")
def q_group_sum(spark, d):
    return agg.group_sum(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"], "decimal(18,2)")


@register("group_max_min", """
SELECT o_custkey, max(o_orderdate) AS max_o_orderdate, min(o_orderdate) AS min_o_orderdate FROM orders GROUP BY 1""")
def q_group_max_min(spark, d):
    return agg.group_max_min(Tables(spark, d).orders, ["o_custkey"], mx=["o_orderdate"], mn=["o_orderdate"])


@register("agg_of_agg", """
WITH per_order AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS order_total FROM lineitem GROUP BY 1)
SELECT o.o_custkey, SUM(p.order_total) AS customer_total, COUNT(*) AS n_orders
FROM per_order p JOIN orders o ON o.o_orderkey = p.l_orderkey GROUP BY 1""")
def q_agg_of_agg(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return agg.agg_of_agg(li, ["o_custkey", "l_orderkey"], [F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("order_total")],
                          ["o_custkey"], [F.sum("order_total").alias("customer_total"), F.count(F.lit(1)).alias("n_orders")])


@register("sum_product", """
SELECT l_returnflag, CAST(ROUND(SUM(l_quantity * COALESCE(CASE WHEN l_linenumber > 1 THEN l_linenumber END, 1))) AS BIGINT) AS total
FROM lineitem GROUP BY 1""")
def q_sum_product(spark, d):
    li = Tables(spark, d).lineitem.withColumn("factor", F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")))
    return agg.sum_product(li, ["l_returnflag"], "l_quantity", "factor")


@register("count_per_key", """
SELECT c.c_custkey, COALESCE(n.n, 0) AS n FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) n ON n.o_custkey = c.c_custkey""")
def q_count_per_key(spark, d):
    t = Tables(spark, d)
    facts = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return agg.count_per_key(t.customer.select("c_custkey"), facts, ["c_custkey"])


@register("count_distinct", """
SELECT year(o_orderdate) AS yr, o_orderpriority, COUNT(DISTINCT o_custkey) AS n_distinct FROM orders GROUP BY 1, 2""")
def q_count_distinct(spark, d):
    o = Tables(spark, d).orders.withColumn("yr", F.year("o_orderdate"))
    return agg.count_distinct(o, ["yr", "o_orderpriority"], "o_custkey")


@register("agg_filter", """
SELECT o_custkey, MAX(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS max_filled FROM orders GROUP BY 1""")
def q_agg_filter(spark, d):
    return agg.agg_filter(Tables(spark, d).orders, ["o_custkey"], "o_totalprice", F.col("o_orderstatus") == "F", out="max_filled")


@register("any_value_dims", """
SELECT o_custkey, MAX(o_orderpriority) AS o_orderpriority, MAX(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1""")
def q_any_value_dims(spark, d):
    return agg.any_value_dims(Tables(spark, d).orders, ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


@register("group_header_first", """
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
       arg_min(o_orderkey, o_orderkey) AS first_order, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority
FROM orders GROUP BY 1, 2""")
def q_group_header_first(spark, d):
    o = Tables(spark, d).orders.withColumn("m", F.trunc(F.col("o_orderdate").cast("date"), "month")).withColumn("first_order", F.col("o_orderkey"))
    return agg.group_header_first(o, ["o_custkey", "m"], ["o_orderkey"], ["first_order", "o_orderpriority"])


@register("merge_lines_sum", """
SELECT l_orderkey, l_partkey, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
       arg_min(l_extendedprice, (l_linenumber, l_suppkey, l_extendedprice)) AS l_extendedprice
FROM lineitem GROUP BY 1, 2""")
def q_merge_lines_sum(spark, d):
    li = Tables(spark, d).lineitem.withColumn("qty", F.col("l_quantity").cast("decimal(18,2)"))
    return agg.merge_lines_sum(li, ["l_orderkey", "l_partkey"], ["qty"], ["l_extendedprice"], ["l_linenumber", "l_suppkey", "l_extendedprice"])


@register("any_flag_status", """
SELECT l_orderkey, CASE WHEN MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 'returned'
                        WHEN MIN(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 'fulfilled' ELSE 'open' END AS status
FROM lineitem GROUP BY 1""")
def q_any_flag_status(spark, d):
    li = Tables(spark, d).lineitem
    return agg.any_flag_status(li, ["l_orderkey"], {"returned": F.col("l_returnflag") == "R"}, {"fulfilled": F.col("l_linestatus") == "F"}, "open")


@register("day_leftover_rollup", """
SELECT CAST(l_shipdate AS DATE) AS day, SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS returned_qty,
       SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS accepted_qty
FROM lineitem GROUP BY 1 HAVING SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) > 0
   OR SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) > 0""")
def q_day_leftover_rollup(spark, d):
    li = Tables(spark, d).lineitem
    q = F.col("l_quantity").cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    x = li.select(F.col("l_shipdate").cast("date").alias("day"),
                  F.when(F.col("l_returnflag") == "R", q).otherwise(zero).alias("returned_qty"),
                  F.when(F.col("l_returnflag") == "A", q).otherwise(zero).alias("accepted_qty"))
    return agg.day_leftover_rollup(x, ["day"], ["returned_qty", "accepted_qty"])


@register("mode_per_key", """
WITH c AS (SELECT l_suppkey, l_returnflag, COUNT(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1, 2)
SELECT l_suppkey, arg_min(l_returnflag, (-n, l_returnflag)) AS l_returnflag FROM c GROUP BY 1""")
def q_mode_per_key(spark, d):
    return agg.mode_per_key(Tables(spark, d).lineitem, ["l_suppkey"], "l_returnflag")


@register("collect_children", """
SELECT l_orderkey, array_to_string(list_transform(list_sort(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey})),
  lambda x: CAST(x.l_linenumber AS VARCHAR) || ':' || CAST(x.l_partkey AS VARCHAR) || ':' || CAST(x.l_suppkey AS VARCHAR)), ',') AS children
FROM lineitem GROUP BY 1""")
def q_collect_children(spark, d):
    c = agg.collect_children(Tables(spark, d).lineitem, ["l_orderkey"], ["l_partkey", "l_suppkey"], order=["l_linenumber"])
    flat = F.transform("children", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"),
                                                          x["l_suppkey"].cast("string")))
    return c.select("l_orderkey", F.array_join(flat, ",").alias("children"))


@register("interval_regularity", """
WITH g AS (SELECT o_custkey, o_orderpriority, COUNT(*) AS n_orders, min(CAST(o_orderdate AS DATE)) AS first_date,
                  max(CAST(o_orderdate AS DATE)) AS last_date
           FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1996-12-31' GROUP BY 1, 2)
SELECT *, ROUND(datediff('day', first_date, last_date) / (n_orders - 1), 4) AS mean_gap_days,
       CASE WHEN datediff('day', first_date, last_date) / (n_orders - 1) BETWEEN 5 AND 9 THEN 'Weekly'
            WHEN datediff('day', first_date, last_date) / (n_orders - 1) BETWEEN 12 AND 16 THEN 'Biweekly'
            WHEN datediff('day', first_date, last_date) / (n_orders - 1) BETWEEN 25 AND 35 THEN 'Monthly' END AS cadence
FROM g WHERE n_orders >= 3""")
def q_interval_regularity(spark, d):
    return agg.interval_regularity(Tables(spark, d).orders, ["o_custkey", "o_orderpriority"], "o_orderdate", after="1996-12-31")


@register("alloc_proportional", """
WITH w AS (SELECT l_orderkey, l_returnflag, SUM(CAST(CAST(l_quantity AS DECIMAL(18,3)) / 7 AS DECIMAL(18,3))) AS qty FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, (qty * 1000)::HUGEINT AS part, (SUM(qty) OVER (PARTITION BY l_orderkey) * 1000)::HUGEINT AS whole FROM w),
t AS (SELECT o_orderkey AS l_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority FROM orders)
SELECT l_orderkey, coalesce(l_returnflag, o_orderpriority) AS l_returnflag, coalesce(qty, 0)::DECIMAL(18,3) AS qty,
  CAST(CASE WHEN whole IS NULL THEN amount WHEN whole = 0 THEN 0 ELSE
    CAST((amount * 100)::HUGEINT * part // whole + CASE WHEN 2 * ((amount * 100)::HUGEINT * part % whole) >= whole THEN 1 ELSE 0 END AS DECIMAL(18,0))
    * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(18,2)) AS amount
FROM t LEFT JOIN s USING (l_orderkey)""")
def q_alloc_proportional(spark, d):
    t = Tables(spark, d)
    totals = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), "o_orderpriority")
    weights = t.lineitem.select("l_orderkey", "l_returnflag", (F.col("l_quantity").cast("decimal(18,3)") / 7).cast("decimal(18,3)").alias("qty"))
    out = agg.alloc_proportional(totals, weights, ["l_orderkey"], "l_returnflag", "qty", ["amount"], "o_orderpriority")
    return out.select("l_orderkey", "l_returnflag", "qty", "amount")


@register("json_agg_rows", """
SELECT o_custkey, page, to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY o_orderkey)) AS rows_json
FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS page FROM orders) GROUP BY 1, 2""")
def q_json_agg_rows(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return agg.json_agg_rows(o, by=["o_custkey"], order=["o_orderkey"], page_size=5, bucket=F.floor(F.col("o_orderkey") / 1000))


# ---------------------------------------------------------------- §2.7 windows


@register("latest_snapshot", """
SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC NULLS FIRST, l_orderkey DESC, l_linenumber DESC,
                           l_suppkey DESC, l_extendedprice DESC) = 1""")
def q_latest_snapshot(spark, d):
    li = Tables(spark, d).lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice")
    r = win.latest_snapshot(li, ["l_partkey"], ["-l_shipdate", "-l_orderkey", "-l_linenumber", "-l_suppkey", "-l_extendedprice"])
    return r.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate")


@register("current_previous_period", """
WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS m FROM orders WHERE o_orderstatus <> 'P')
SELECT (SELECT m FROM months ORDER BY m DESC LIMIT 1) AS cur_date, (SELECT m FROM months ORDER BY m DESC LIMIT 1 OFFSET 1) AS prev_date""")
def q_current_previous_period(spark, d):
    o = Tables(spark, d).orders.where(F.col("o_orderstatus") != "P").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("check_date"))
    return win.current_previous_period(o, "check_date")


@register("period_number", """
SELECT o_orderkey, year(o_orderdate) AS year,
       dense_rank() OVER (PARTITION BY year(o_orderdate) ORDER BY CAST(date_trunc('month', o_orderdate) AS DATE)) AS pp FROM orders""")
def q_period_number(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("check_date"))
    return win.period_number(o, "check_date").select("o_orderkey", "year", "pp")


@register("window_total_status", """
WITH s AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS yr, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
t AS (SELECT o_custkey, yr, SUM(amount) AS week_total FROM s GROUP BY 1, 2)
SELECT s.o_orderkey, t.week_total, CASE WHEN t.week_total > 500000 THEN 'above' WHEN t.week_total = 500000 THEN 'at' ELSE 'below' END AS status
FROM s JOIN t USING (o_custkey, yr)""")
def q_window_total_status(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "year").alias("yr"), "o_orderkey",
                                       F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return win.window_total_status(o, ["o_custkey", "yr"], "amount", 500000).select("o_orderkey", "week_total", "status")


CUM_SQL = """
WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id,
                  SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS cum
           FROM events)"""


@register("cumulative_to_delta", CUM_SQL + """
SELECT event_id, greatest(cum - COALESCE(lag(cum) OVER (PARTITION BY user_id, day ORDER BY ts, event_id), 0), 0) AS delta FROM c""")
def q_cumulative_to_delta(spark, d):
    from pyspark.sql import Window

    ev = Tables(spark, d).events.withColumn("day", F.col("ts").cast("date"))
    w = Window.partitionBy("user_id", "day").orderBy("ts", "event_id")
    cum = ev.withColumn("cum", F.sum(F.col("value").cast("decimal(18,2)")).over(w))
    return win.cumulative_to_delta(cum, ["user_id", "day"], ["ts", "event_id"], "cum").select("event_id", "delta")


@register("dup_suffix", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rn > 1 THEN code || '_' || CAST(rn AS VARCHAR) ELSE code END AS code FROM (
  SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS code,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
  FROM lineitem)""")
def q_dup_suffix(spark, d):
    li = Tables(spark, d).lineitem.withColumn("code", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    r = win.dup_suffix_bucketed(li, "code", ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
                                F.date_trunc("month", "l_shipdate"))
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code")


@register("dup_name_suffix", """
SELECT p_partkey, CASE WHEN COUNT(*) OVER (PARTITION BY p_brand, p_name) > 1 THEN p_name || ' (' || CAST(p_partkey AS VARCHAR) || ')'
                       ELSE p_name END AS p_name FROM part""")
def q_dup_name_suffix(spark, d):
    return win.dup_name_suffix(Tables(spark, d).part, ["p_brand"], "p_name", "p_partkey").select("p_partkey", "p_name")


@register("first_last_active", """
SELECT user_id, CAST(ts AS DATE) AS day, min(CASE WHEN value > 20 THEN hour(ts) END) AS first_active,
       max(CASE WHEN value > 20 THEN hour(ts) END) AS last_active FROM events GROUP BY 1, 2""")
def q_first_last_active(spark, d):
    ev = Tables(spark, d).events.select("user_id", F.col("ts").cast("date").alias("day"), F.hour("ts").alias("hr"),
                                        (F.col("value") - 20).alias("above_20"))
    return win.first_last_active(ev, ["user_id", "day"], "hr", "above_20")


@register("keep_first", """
SELECT l_orderkey, l_linenumber, arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey, l_extendedprice)) AS l_partkey
FROM lineitem GROUP BY 1, 2""")
def q_keep_first(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey", "l_extendedprice")
    return win.keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]) \
        .select("l_orderkey", "l_linenumber", "l_partkey")


@register("keep_last", """
SELECT l_orderkey, l_linenumber, arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey, l_extendedprice)) AS l_partkey
FROM lineitem GROUP BY 1, 2""")
def q_keep_last(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey", "l_extendedprice")
    return win.keep_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]) \
        .select("l_orderkey", "l_linenumber", "l_partkey")


@register("attach_once", """
SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
                                   THEN o_orderpriority END AS note FROM orders""")
def q_attach_once(spark, d):
    o = Tables(spark, d).orders.withColumn("note", F.col("o_orderpriority"))
    return win.attach_once_bucketed(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "note", F.date_trunc("year", "o_orderdate")) \
        .select("o_orderkey", "o_custkey", "note")


@register("gap_days", """
SELECT o_orderkey, datediff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap_days
FROM orders""")
def q_gap_days(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return win.gap_days_bucketed(o, ["o_custkey"], "o_orderdate", F.date_trunc("year", "o_orderdate"), tie=["o_orderkey"]) \
        .select("o_orderkey", "gap_days")


@register("first_nonblank", """
SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_type, ts) FILTER (WHERE event_type IS NOT NULL AND trim(event_type) <> '') AS event_type
FROM events GROUP BY 1, 2""")
def q_first_nonblank(spark, d):
    ev = Tables(spark, d).events.withColumn("day", F.col("ts").cast("date"))
    return win.first_nonblank(ev, ["user_id", "day"], "ts", "event_type")


# ---------------------------------------------------------------- §2.8 sorts, limits


@register("order_output", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey""")
def q_order_output(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@register("page_by_key", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100""")
def q_page_by_key(spark, d):
    o = Tables(spark, d).orders
    return o.where(F.col("o_orderkey") > 1000).orderBy("o_orderkey").limit(100).select("o_orderkey", "o_custkey")


@register("top_unmatched", """
SELECT l_partkey AS value, COUNT(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
GROUP BY 1 ORDER BY n DESC, value LIMIT 10""")
def q_top_unmatched(spark, d):
    t = Tables(spark, d)
    miss = t.lineitem.join(t.part.where(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti")
    return miss.groupBy(F.col("l_partkey").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(10)


@register("limit_one", """
SELECT c_mktsegment, arg_min(c_custkey, c_custkey) AS c_custkey FROM customer GROUP BY 1""")
def q_limit_one(spark, d):
    c = Tables(spark, d).customer
    return c.groupBy("c_mktsegment").agg(F.min_by("c_custkey", "c_custkey").alias("c_custkey"))


# ---------------------------------------------------------------- §2.9 set ops


@register("union_all", """
SELECT o_custkey AS k, 'order' AS src FROM orders
UNION ALL SELECT c_custkey, 'customer' FROM customer""")
def q_union_all(spark, d):
    t = Tables(spark, d)
    a = t.orders.select(F.col("o_custkey").alias("k"), F.lit("order").alias("src"))
    b = t.customer.select(F.col("c_custkey").alias("k"), F.lit("customer").alias("src"))
    return setops.union_all(a, b)


@register("union_distinct", """
SELECT lower(p_type) AS name FROM part UNION SELECT lower(c_mktsegment) FROM customer""")
def q_union_distinct(spark, d):
    t = Tables(spark, d)
    return setops.union_distinct(t.part.select(F.lower("p_type").alias("name")), t.customer.select(F.lower("c_mktsegment").alias("name")))


@register("except_keys", """
SELECT DISTINCT l_suppkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0)""")
def q_except_keys(spark, d):
    t = Tables(spark, d)
    a = t.lineitem.select("l_suppkey").distinct()
    b = t.supplier.where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"))
    return setops.except_keys(a, b, ["l_suppkey"])


@register("union_keys", """
SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part""")
def q_union_keys(spark, d):
    t = Tables(spark, d)
    a = t.lineitem.select(F.col("l_partkey").alias("k"))
    b = t.part.select(F.col("p_partkey").alias("k"))
    return setops.union_keys(a, b, ["k"])


@register("distinct_pairs", """
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem""")
def q_distinct_pairs(spark, d):
    return setops.distinct_pairs(Tables(spark, d).lineitem, ["l_partkey", "l_suppkey"])


@register("snapshot_diff", """
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1999),
     b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 2000)
SELECT o_custkey, 'only_a' AS side FROM a WHERE o_custkey NOT IN (SELECT o_custkey FROM b)
UNION ALL SELECT o_custkey, 'only_b' FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM a)""")
def q_snapshot_diff(spark, d):
    o = Tables(spark, d).orders
    return setops.snapshot_diff(o.where(F.year("o_orderdate") == 1999), o.where(F.year("o_orderdate") == 2000), ["o_custkey"])


@register("fuzzy_best_match", """
WITH dim AS (SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1)
SELECT 'GH - ' || upper(replace(p_name, 'e', '')) AS name, min(p_partkey) AS match_id FROM dim GROUP BY 1""")
def q_fuzzy_best_match(spark, d):
    """Distinct part names perturbed (dropped letter, prefix, case) matched back to the part-name dimension. Of the given names
    the one that was perturbed is always the nearest, which is all that the SQL says; scoring all pairs is in the tests."""
    from furrow.operators.fuzzy import fuzzy_best_match, site_preference

    p = Tables(spark, d).part
    names = p.select(F.concat(F.lit("GH - "), F.upper(F.regexp_replace("p_name", "e", ""))).alias("name")).distinct()
    dim = p.groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey"))
    return fuzzy_best_match(names, "name", dim, "p_partkey", "p_name", prefer=site_preference)
