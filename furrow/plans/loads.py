"""Reshape (§2.10), validation rules (§2.11) and load semantics (§2.2)
bound to the given tables, with DuckDB oracles. Load operators return the
new table state, so they are compared like any query."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators import reshape as rs
from furrow.operators import rules
from furrow.plans.registry import register
from furrow.session import spread
from furrow.sources import sinks
from furrow.sources.tables import Tables

# ---------------------------------------------------------------- §2.10 reshape


@register("unpivot_measures", """
SELECT l_orderkey, l_linenumber, metric, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS metric, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem) WHERE value IS NOT NULL""")
def q_unpivot_measures(spark, d):
    li = Tables(spark, d).lineitem
    return rs.unpivot_measures(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@register("unpivot_slots", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 1 AS slot, l_quantity AS amount, CASE WHEN l_discount > 0 THEN l_discount END AS rate FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 2, CASE WHEN l_returnflag = 'R' THEN l_extendedprice END, CASE WHEN l_tax > 0 THEN l_tax END FROM lineitem)
WHERE COALESCE(amount, rate) IS NOT NULL""")
def q_unpivot_slots(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("d1"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("a2"), F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("t2"))
    return rs.unpivot_slots(li, ["l_orderkey", "l_linenumber"], [{"amount": "l_quantity", "rate": "d1"}, {"amount": "a2", "rate": "t2"}])


@register("unpivot_questions", """
SELECT * FROM (
  SELECT o_orderkey, 'q_status' AS question_id, NULL::BOOLEAN AS response_boolean, NULL::DOUBLE AS response_numeric,
         trim(o_orderstatus) AS response_enum, NULL::VARCHAR AS response_text FROM orders WHERE trim(o_orderstatus) <> ''
  UNION ALL SELECT o_orderkey, 'q_total', NULL, TRY_CAST(trim(CAST(o_totalprice AS VARCHAR)) AS DOUBLE), NULL, NULL FROM orders
  UNION ALL SELECT o_orderkey, 'q_urgent', CASE WHEN upper(trim(CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' ELSE 'N' END)) IN ('TRUE', 'YES', '1', 'Y', 'T', 'PASS')
            THEN true ELSE false END, NULL, NULL, NULL FROM orders)""")
def q_unpivot_questions(spark, d):
    o = Tables(spark, d).orders.withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", "Y").otherwise("N"))
    return rs.unpivot_questions(o, ["o_orderkey"], [("q_status", "o_orderstatus", "enum"), ("q_total", "o_totalprice", "numeric"),
                                                    ("q_urgent", "urgent", "boolean")])


@register("explode_list_cell", """
SELECT DISTINCT o_orderkey, trim(x) AS item FROM orders, LATERAL (SELECT unnest(string_split(o_orderpriority, '-')) AS x) WHERE trim(x) <> ''""")
def q_explode_list_cell(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority")
    return rs.explode_list_cell(o, "o_orderpriority", "item", sep="-").select("o_orderkey", "item").distinct()


@register("split_evenly", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) / greatest(len(string_split(o_orderpriority, '-')), 1) AS share, unnest(string_split(o_orderpriority, '-')) AS item
FROM orders""")
def q_split_evenly(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amt"), F.split("o_orderpriority", "-").alias("lst"))
    return rs.split_evenly(o, "amt", "lst").select("o_orderkey", F.col("share").cast("double").alias("share"), "item")


@register("explode_docs", """
SELECT l_orderkey AS invoice_id, l_linenumber AS line_num, l_partkey AS item_id, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount FROM lineitem""")
def q_explode_docs(spark, d):
    li = Tables(spark, d).lineitem
    docs = li.groupBy(F.col("l_orderkey").alias("invoice_id")).agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("LineNum"), F.col("l_partkey").alias("ItemRef"), F.col("l_extendedprice").cast("decimal(14,2)").alias("Amount"))).alias("Line"))
    return rs.explode_docs(docs, "Line", ["invoice_id"], {"line_num": F.col("l.LineNum"), "item_id": F.col("l.ItemRef"), "amount": F.col("l.Amount")})


@register("series_cycles", """
SELECT p_partkey, CAST(c AS DATE) AS cycle_start FROM part, LATERAL (SELECT unnest(generate_series(
  CAST(DATE '2001-01-07' + ((p_size * 7) % 84) + CAST(ceil(greatest(datediff('day', DATE '2001-01-07' + ((p_size * 7) % 84), DATE '2001-06-01'), 0) / 84.0) AS INTEGER) * 84 AS TIMESTAMP),
  TIMESTAMP '2002-06-30', INTERVAL 84 DAY)) AS c)""")
def q_series_cycles(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.lit("2001-01-07").cast("date").alias("anchor"), F.col("p_size").alias("slot"))
    return rs.series_cycles(p, "anchor", "slot", 84, "2001-06-01", "2002-06-30").select("p_partkey", "cycle_start")


@register("stub_parents", """
WITH c AS (SELECT DISTINCT upper(trim(strftime(o_orderdate, '%y%m') || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') || o_orderstatus)) AS code FROM orders),
e AS (SELECT DISTINCT upper(strftime(o_orderdate, '%y%m') || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') || o_orderstatus) AS code FROM orders WHERE o_orderpriority = '1-URGENT'),
m AS (SELECT code FROM c WHERE code NOT IN (SELECT code FROM e))
SELECT code, false AS is_trial, CASE WHEN CAST(substr(code, 1, 2) AS INTEGER) >= 70 THEN CAST(substr(code, 1, 2) AS INTEGER) + 1900
  ELSE CAST(substr(code, 1, 2) AS INTEGER) + 2000 END AS year, CAST(substr(code, 3, 2) AS INTEGER) AS month, substr(code, 5, 2) AS site,
  substr(code, 7, 1) AS variety, make_date(CASE WHEN CAST(substr(code, 1, 2) AS INTEGER) >= 70 THEN CAST(substr(code, 1, 2) AS INTEGER) + 1900
  ELSE CAST(substr(code, 1, 2) AS INTEGER) + 2000 END, CAST(substr(code, 3, 2) AS INTEGER), 1) AS seeding_month FROM m""")
def q_stub_parents(spark, d):
    from furrow.functions.codes import cycle_code

    o = Tables(spark, d).orders.withColumn("code", cycle_code("o_orderdate", F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0"), "o_orderstatus"))
    return rs.stub_parents(o, "code", o.where(F.col("o_orderpriority") == "1-URGENT"), "code")


@register("json_array_elements", """
SELECT c_custkey, e AS element FROM customer, LATERAL (SELECT unnest(from_json('["' || c_mktsegment || '","' || c_name || '"]', '["VARCHAR"]')) AS e)
WHERE starts_with(e, 'Customer')""")
def q_json_array_elements(spark, d):
    c = Tables(spark, d).customer.withColumn("j", F.concat(F.lit('["'), "c_mktsegment", F.lit('","'), "c_name", F.lit('"]')))
    return rs.json_array_elements(c, "j", prefix="Customer").select("c_custkey", "element")


@register("entitlement_grid", """
SELECT c_custkey, m AS module FROM customer, (VALUES ('hr'), ('grow'), ('pack')) v(m)""")
def q_entitlement_grid(spark, d):
    c = Tables(spark, d).customer.select("c_custkey")
    return rs.entitlement_grid(c, ["hr", "grow", "pack"])


# ---------------------------------------------------------------- §2.11 rules


@register("flag_out_of_range", """
SELECT l.l_orderkey, l.l_linenumber, COALESCE(l.l_quantity < 5, false) OR COALESCE(l.l_quantity > p.p_size, false) AS out_of_range
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def q_flag_out_of_range(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    return j.select("l_orderkey", "l_linenumber", rules.flag_out_of_range("l_quantity", F.lit(5), F.col("p_size")).alias("out_of_range"))


@register("test_pass_fail", """
SELECT l.l_orderkey, l.l_linenumber, CASE WHEN l.l_quantity IS NOT NULL THEN COALESCE(l.l_quantity >= 5, true) AND COALESCE(l.l_quantity <= p.p_size, true) END AS passed
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""")
def q_test_pass_fail(spark, d):
    t = Tables(spark, d)
    cfg = t.part.select(F.col("p_partkey").alias("l_partkey"), F.lit(5).alias("lo"), F.col("p_size").alias("hi"))
    return rules.test_pass_fail(t.lineitem, cfg, "l_partkey", "l_quantity", "lo", "hi").select("l_orderkey", "l_linenumber", "passed")


@register("terminate_on_fail", """
SELECT l_orderkey, min(l_shipdate) AS terminated_at, arg_min('discount on line ' || CAST(l_linenumber AS VARCHAR),
  (l_shipdate, 'discount on line ' || CAST(l_linenumber AS VARCHAR))) AS termination_reason
FROM lineitem WHERE l_discount > 0.08 GROUP BY 1""")
def q_terminate_on_fail(spark, d):
    li = Tables(spark, d).lineitem
    return rules.terminate_on_fail(li, "l_orderkey", "l_shipdate", F.col("l_discount") > 0.08,
                                   F.concat(F.lit("discount on line "), F.col("l_linenumber").cast("string")))


@register("terminate_flagged", """
SELECT l_orderkey, max(l_shipdate) AS terminated_at FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""")
def q_terminate_flagged(spark, d):
    li = Tables(spark, d).lineitem.withColumn("flag", F.col("l_returnflag") == "R")
    return rules.terminate_flagged(li, ["l_orderkey"], "l_shipdate", "flag")


@register("derive_day_offset", """
SELECT l.l_orderkey, l.l_linenumber, datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS day_offset
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def q_derive_day_offset(spark, d):
    t = Tables(spark, d)
    child = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("sd"))
    parent = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("od"))
    return rules.derive_day_offset(child, parent, "l_orderkey", "o_orderkey", "sd", "od").select("l_orderkey", "l_linenumber", "day_offset")


@register("default_best_by", """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) + CAST(COALESCE(p.p_size, 0) AS INTEGER) AS best_by
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""")
def q_default_best_by(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("harvest"))
    return rules.default_best_by(li, t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey", "harvest", "p_size") \
        .select("l_orderkey", "l_linenumber", "best_by")


@register("audit_immutable", """
SELECT o_orderkey, 'o_orderpriority' AS column, o_orderpriority AS old_value, 'CHANGED' AS new_value FROM orders WHERE o_orderkey % 97 = 0""")
def q_audit_immutable(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    new = o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 97 == 0, F.lit("CHANGED")).otherwise(F.col("o_orderpriority")))
    return rules.audit_immutable(o, new, "o_orderkey", ["o_orderpriority", "o_orderstatus"])


@register("check_unique", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_check_unique(spark, d):
    return rules.check_unique(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@register("check_foreign_key", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def q_check_foreign_key(spark, d):
    t = Tables(spark, d)
    return rules.check_foreign_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                                   t.part.where(F.col("p_size") > 5), "l_partkey", "p_partkey")


@register("check_domain", """
SELECT p_partkey, p_size FROM part WHERE p_size IS NOT NULL AND (p_size < 2 OR p_size > 45)""")
def q_check_domain(spark, d):
    return rules.check_domain(Tables(spark, d).part.select("p_partkey", "p_size"), "p_size", lo=2, hi=45)


@register("check_exactly_one", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END) <> 1""")
def q_check_exactly_one(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0.05, 1).alias("a"),
                                          F.when(F.col("l_tax") > 0.05, 1).alias("b"))
    return rules.check_exactly_one(li, ["a", "b"]).select("l_orderkey", "l_linenumber")


@register("coverage_report", """
SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)""")
def q_coverage_report(spark, d):
    t = Tables(spark, d)
    return rules.coverage_report(t.lineitem, t.supplier.where(F.col("s_acctbal") > 1000).select(F.col("s_suppkey").alias("l_suppkey")), ["l_suppkey"])


@register("resolve_principal", """
SELECT c_nationkey, min(c_custkey) AS employee_id, arg_min(c_mktsegment, c_custkey) AS access_level FROM customer
WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def q_resolve_principal(spark, d):
    c = Tables(spark, d).customer
    return rules.resolve_principal(c, "c_mktsegment", "BUILDING", "c_nationkey", "c_custkey", "c_mktsegment")


# ---------------------------------------------------------------- §2.2 load semantics (new table state)


@register("upsert_by_key", """
WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
u AS (SELECT c_custkey, upper(c_name) AS c_name, c_acctbal FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT c_custkey + 100000, c_name, c_acctbal FROM customer WHERE c_acctbal > 9000)
SELECT t.c_custkey, COALESCE(u.c_name, t.c_name) AS c_name, CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal
FROM t LEFT JOIN u USING (c_custkey)
UNION ALL SELECT * FROM u WHERE c_custkey NOT IN (SELECT c_custkey FROM t)""")
def q_upsert_by_key(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_acctbal")
    upd = c.where(F.col("c_acctbal") < 0).withColumn("c_name", F.upper("c_name")).unionByName(
        c.where(F.col("c_acctbal") > 9000).withColumn("c_custkey", F.col("c_custkey") + 100000))
    return sinks.upsert_by_key(c, upd, ["c_custkey"])


@register("insert_ignore", """
WITH t AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT l_orderkey AS o_orderkey, min(l_suppkey) AS o_custkey FROM lineitem GROUP BY 1)
SELECT * FROM t UNION ALL SELECT n.* FROM n ANTI JOIN t USING (o_orderkey)""")
def q_insert_ignore(spark, d):
    """Finished orders, and a row for every line item's order from elsewhere: seen orders keep their row."""
    t = Tables(spark, d)
    finished = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"))
    return sinks.insert_ignore(finished, lines, ["o_orderkey"], order=["o_custkey"])


@register("upsert_parent_replace_children", """
WITH kids AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem),
touched AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM kids WHERE l_orderkey NOT IN (SELECT o_orderkey FROM touched)
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM touched)""")
def q_upsert_parent_replace_children(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", "o_orderstatus")
    kids = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey")
    newp = o.where(F.col("o_orderstatus") == "F")
    newc = kids.join(newp.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey") \
        .select("l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("l_quantity"))
    _, children = sinks.upsert_parent_replace_children(o, kids, newp, newc, ["o_orderkey"], ["l_orderkey"])
    return children


@register("update_from_values", """
WITH v AS (SELECT o_custkey AS c_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) AS c_acctbal
  FROM orders GROUP BY 1)
SELECT c.c_custkey, CASE WHEN v.c_custkey IS NULL THEN c.c_acctbal ELSE v.c_acctbal END AS c_acctbal FROM customer c LEFT JOIN v USING (c_custkey)""")
def q_update_from_values(spark, d):
    t = Tables(spark, d)
    open_ = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice").cast("decimal(18,2)"))  # none open: the value is NULL
    v = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(open_).cast("double").alias("c_acctbal"))
    return sinks.update_from_values(t.customer.select("c_custkey", "c_acctbal"), v, ["c_custkey"], ["c_acctbal"])


@register("update_if_distinct", """
WITH v AS (SELECT DISTINCT lower(c_name) AS k, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS seg FROM customer)
SELECT c.c_custkey, c.c_name, v.seg AS c_mktsegment FROM customer c JOIN v ON v.k = lower(c.c_name) WHERE v.seg IS DISTINCT FROM c.c_mktsegment""")
def q_update_if_distinct(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    vals = c.select(F.upper("c_name").alias("c_name"), F.when(F.col("c_acctbal") < 0, F.lit("DEBT")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    _, changed = sinks.update_if_distinct(c.drop("c_acctbal"), vals, "c_name", ["c_mktsegment"])
    return changed.select("c_custkey", "c_name", F.lit("DEBT").alias("c_mktsegment"))


@register("soft_delete_missing", """
SELECT c_custkey, c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998) AS is_deleted FROM customer""")
def q_soft_delete_missing(spark, d):
    t = Tables(spark, d)
    ext = t.orders.where(F.year("o_orderdate") == 1998).select(F.col("o_custkey").alias("c_custkey"))
    return sinks.soft_delete_missing(t.customer.select("c_custkey"), ext, ["c_custkey"]).select("c_custkey", "is_deleted")


@register("insert_missing_dims", """
SELECT DISTINCT l_suppkey + 50 AS s_suppkey, 'unknown supplier' AS s_name FROM lineitem
WHERE l_suppkey + 50 NOT IN (SELECT s_suppkey FROM supplier)""")
def q_insert_missing_dims(spark, d):
    t = Tables(spark, d)
    facts = t.lineitem.select((F.col("l_suppkey") + 50).alias("k"))
    return sinks.insert_missing_dims(t.supplier.select("s_suppkey", "s_name"), facts, "k", "s_suppkey", {"s_name": "unknown supplier"})


@register("surrogate_id", """
SELECT o_orderkey, substr(sha256(COALESCE(length(o_custkey::VARCHAR) || ':' || o_custkey::VARCHAR, '-') || '|' ||
  COALESCE(length(o_orderdate::VARCHAR) || ':' || o_orderdate::VARCHAR, '-')), 1, 32) AS id
FROM orders""")
def q_surrogate_id(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return sinks.surrogate_id(o, ["o_custkey", "o_orderdate"]).select("o_orderkey", "id")


@register("stamp_audit", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'clerk@farm.example' ELSE 'system' END AS created_by,
  CASE WHEN o_orderstatus = 'F' THEN 'clerk@farm.example' ELSE 'system' END AS updated_by,
  TIMESTAMP '2002-01-01 00:00:00' AS created_at, TIMESTAMP '2002-01-01 00:00:00' AS updated_at FROM orders""")
def q_stamp_audit(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lit("clerk@farm.example")).alias("who"))
    return sinks.stamp_audit(o, "who", at="2002-01-01 00:00:00").drop("who").withColumn("created_at", F.col("created_at").cast("timestamp_ntz")) \
        .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@register("drop_null_payload", """
SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, '3-MEDIUM') AS priority FROM orders""")
def q_drop_null_payload(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))
    return sinks.drop_null_payload(o, {"priority": "3-MEDIUM"})


@register("distinct_seed", """
SELECT DISTINCT trim(c_mktsegment) AS name FROM customer WHERE trim(c_mktsegment) <> ''""")
def q_distinct_seed(spark, d):
    from furrow.sources.readers import distinct_seed

    return distinct_seed(Tables(spark, d).customer, "c_mktsegment")


@register("scan_table", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def q_scan_table(spark, d):
    from furrow.sources.readers import scan_table
    from furrow.sources.tables import table_path

    return scan_table(spark, table_path(d, "orders"), cols=["o_orderkey", "o_totalprice"], eq={"o_orderstatus": "F"})
