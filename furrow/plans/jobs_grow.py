"""More nightly load jobs (§2.13), composed from the library operators over
raw renderings of the given tables: people, food safety, products, pack,
sales dimensions and CRM."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions import arith, codes, lists, parse, text
from furrow.operators import aggregates as agg
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import rows, rules
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.sources.tables import Tables


@register("etl_employees_alt", """
WITH r AS (SELECT c_custkey, c_mktsegment || ', Cust' || CAST(c_custkey % 50 AS VARCHAR) || ' Q.' AS full_name FROM customer),
p AS (SELECT c_custkey, trim(regexp_replace(trim(substr(full_name, strpos(full_name, ',') + 1)), '\\s+[A-Za-z]\\.?$', '')) AS first_name,
             trim(split_part(full_name, ',', 1)) AS last_name FROM r),
s AS (SELECT *, trim(regexp_replace(lower(trim(first_name || ' ' || last_name)), '[^a-z0-9_]+', '_', 'g'), '_') AS base FROM p)
SELECT c_custkey, first_name, last_name,
       CASE WHEN row_number() OVER (PARTITION BY base ORDER BY c_custkey) > 1
            THEN base || '_' || CAST(row_number() OVER (PARTITION BY base ORDER BY c_custkey) AS VARCHAR) ELSE base END AS id
FROM s""")
def q_etl_employees_alt(spark, d):
    c = Tables(spark, d).customer
    r = c.select("c_custkey", F.concat(F.col("c_mktsegment"), F.lit(", Cust"), (F.col("c_custkey") % 50).cast("string"), F.lit(" Q.")).alias("full_name"))
    p = r.withColumn("_n", text.split_person_name("full_name", style="comma")).select("c_custkey", "_n.first_name", "_n.last_name")
    p = p.withColumn("id", text.slug(F.concat_ws(" ", "first_name", "last_name")))
    return win.dup_suffix_bucketed(p, "id", ["c_custkey"], F.floor(F.col("c_custkey") / 1000)).select("c_custkey", "first_name", "last_name", "id")


@register("etl_maintenance", """
SELECT o_orderkey AS request_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS site_id,
       CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS equipment_id
FROM orders WHERE (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) + (CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) = 1""")
def q_etl_maintenance(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("request_id"),
                                       F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("site_id"),
                                       F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("equipment_id"))
    bad = rules.check_exactly_one(o, ["site_id", "equipment_id"]).select("request_id")
    return o.join(bad, "request_id", "left_anti")


@register("etl_lab_results", """
SELECT l.l_orderkey, l.l_linenumber, lower(n.n_name) || '_water_' || CAST(l.l_linenumber AS VARCHAR) AS site_key, 'ecoli' AS test,
       l.l_quantity AS result, l.l_quantity <= 45 AS passed
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def q_etl_lab_results(spark, d):
    t = Tables(spark, d)
    li, s, n = t.lineitem, t.supplier, t.nation
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    x = j.select("l_orderkey", "l_linenumber", codes.compose_key("{site}_water_{n}", site=F.lower("n_name"), n="l_linenumber").alias("site_key"),
                 F.lit("ecoli").alias("test"), F.col("l_quantity").alias("result"), F.lit(None).cast("double").alias("lo"), F.lit(45.0).alias("hi"))
    return x.withColumn("passed", ~rules.flag_out_of_range("result", "lo", "hi")).drop("lo", "hi")


@register("etl_food_safety_dims", """
SELECT n_nationkey AS site_id, lower(replace(n_name, 'NATION_', 'n')) || '_trap_' || CAST(s AS VARCHAR) AS trap_id
FROM nation, LATERAL (SELECT unnest(generate_series(1, n_regionkey + 1)) AS s)""")
def q_etl_food_safety_dims(spark, d):
    n = Tables(spark, d).nation.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("n_regionkey") + 1)))
    return n.select(F.col("n_nationkey").alias("site_id"),
                    codes.compose_key("{site}_trap_{s}", site=F.lower(F.regexp_replace("n_name", "NATION_", "n")), s="s").alias("trap_id"))


@register("etl_checklists", """
SELECT * FROM (
  SELECT o_orderkey, 'floor_clean' AS question_id, CASE WHEN o_orderstatus = 'F' THEN true ELSE false END AS response_boolean,
         NULL::DOUBLE AS response_numeric, COALESCE(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END, 'other') AS site FROM orders
  UNION ALL SELECT o_orderkey, 'temperature', NULL, ROUND(o_totalprice / 10000, 2),
         COALESCE(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END, 'other') FROM orders)""")
def q_etl_checklists(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("clean"),
        F.round(F.col("o_totalprice") / 10000, 2).alias("temp"),
        rows.catch_all_member(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority"))).alias("site"))
    long = rs.unpivot_questions(o, ["o_orderkey", "site"], [("floor_clean", "clean", "boolean"), ("temperature", "temp", "numeric")])
    return long.select("o_orderkey", "question_id", "response_boolean", "response_numeric", "site")


@register("etl_corrective_actions", """
WITH t AS (SELECT date_trunc('second', ts) AS k, CAST(user_id AS VARCHAR) AS w, min(event_id) AS tracker_id FROM events
           WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT e.event_id, t.tracker_id FROM events e LEFT JOIN t ON t.k = date_trunc('second', e.ts) AND t.w = CAST(e.user_id AS VARCHAR)
WHERE e.event_type = 'error'""")
def q_etl_corrective_actions(spark, d):
    ev = Tables(spark, d).events
    log = ev.where(F.col("event_type") == "error").select("event_id", F.col("ts").cast("string").alias("logged_at"), F.col("user_id").cast("string").alias("who"))
    trackers = ev.where(F.col("event_type") != "error").select(F.col("event_id").alias("tid"), "ts", F.col("user_id").cast("string").alias("uid"))
    return jn.event_key_match(log, trackers, "logged_at", "who", "ts", "uid", "tid", out="tracker_id").select("event_id", "tracker_id")


@register("etl_products", """
SELECT p_partkey AS product_id, ROUND(p_size + 0.5, 4) AS case_depth,
       CASE WHEN p_size <> 0 AND (p_size % 10 + 1) <> 0 THEN ROUND(CAST(p_size AS DOUBLE) * (p_size % 10 + 1) * 5, 2) END AS pallet_weight,
       NULLIF(concat_ws(chr(10) || chr(10), CASE WHEN NOT COALESCE(upper(trim(p_name)) IN ('', 'N/A'), true) THEN trim(p_name) END,
                        CASE WHEN NOT COALESCE(upper(trim(p_type)) IN ('', 'N/A'), true) THEN trim(p_type) END), '') AS description
FROM part""")
def q_etl_products(spark, d):
    p = Tables(spark, d).part
    dims = p.select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit(" 1/2")).alias("depth_txt"))
    spec = p.select("p_partkey", "p_name", "p_type")
    pack = p.select("p_partkey", F.col("p_size").alias("case_weight"), (F.col("p_size") % 10 + 1).alias("ti"), F.lit(5).alias("hi"))
    j = jn.join_using(p.select("p_partkey"), [dims, spec, pack], ["p_partkey"])
    return j.select(F.col("p_partkey").alias("product_id"), parse.parse_mixed_fraction("depth_txt").alias("case_depth"),
                    arith.bulk_weight(F.col("case_weight").cast("double"), "ti", "hi").alias("pallet_weight"),
                    lists.concat_paragraphs(["p_name", "p_type"]).alias("description"))


@register("etl_pack_day", """
WITH x AS (SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey, l_orderkey, l_linenumber, l_partkey, 'open' AS product,
                  CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END AS qty FROM lineitem
           UNION ALL SELECT CAST(l_shipdate AS DATE), l_suppkey, l_orderkey, l_linenumber, l_partkey, 'final',
                  CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END FROM lineitem)
SELECT day, product, SUM(qty) AS total, arg_min(l_suppkey, (l_orderkey, l_linenumber, l_partkey)) AS first_reporter FROM x
GROUP BY 1, 2 HAVING SUM(qty) > 0""")
def q_etl_pack_day(spark, d):
    li = Tables(spark, d).lineitem.select(
        F.col("l_shipdate").cast("date").alias("day"), "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0).alias("o"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0).alias("f"))
    return agg.daily_packer_rollup(li, "day", {"open": "o", "final": "f"}, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"])


@register("etl_shelf_life", """
SELECT o.o_orderkey AS trial_id, t.terminated_at, t.termination_reason
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS terminated_at,
                                arg_min('tax ' || CAST(l_tax AS VARCHAR), (l_shipdate, 'tax ' || CAST(l_tax AS VARCHAR))) AS termination_reason
                         FROM lineitem WHERE l_tax >= 0.07 GROUP BY 1) t ON t.l_orderkey = o.o_orderkey""")
def q_etl_shelf_life(spark, d):
    t = Tables(spark, d)
    term = rules.terminate_on_fail(t.lineitem, "l_orderkey", "l_shipdate", F.col("l_tax") >= 0.07,
                                   F.concat(F.lit("tax "), F.col("l_tax").cast("decimal(4,2)").cast("string")))
    trials = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return trials.join(term, "l_orderkey", "left").withColumnRenamed("l_orderkey", "trial_id")


@register("etl_moisture", """
SELECT o.o_orderkey, CASE WHEN c.c_custkey IS NULL AND o.o_orderpriority IS NOT NULL THEN
   CASE WHEN COALESCE(trim(CASE WHEN o.o_orderstatus = 'F' THEN 'dry' END), '') = '' THEN '[' || o.o_orderpriority || ']'
        ELSE '[' || o.o_orderpriority || '] ' || CASE WHEN o.o_orderstatus = 'F' THEN 'dry' END END
   ELSE CASE WHEN o.o_orderstatus = 'F' THEN 'dry' END END AS notes
FROM orders o LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = o.o_custkey""")
def q_etl_moisture(spark, d):
    t = Tables(spark, d)
    dryers = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("dryer_id"))
    o = t.orders.join(dryers, "o_custkey", "left").select("o_orderkey", "o_orderpriority", "dryer_id",
                                                           F.when(F.col("o_orderstatus") == "F", F.lit("dry")).alias("notes"))
    return o.select("o_orderkey", lists.carry_unmatched("o_orderpriority", "dryer_id", "notes").alias("notes"))


@register("etl_sales_dims", """
WITH segs AS (SELECT DISTINCT trim(c_mktsegment) AS name FROM customer WHERE trim(c_mktsegment) <> '')
SELECT name, name IN ('BUILDING', 'AUTOMOBILE') AS is_stackable_group FROM segs""")
def q_etl_sales_dims(spark, d):
    from furrow.sources.readers import distinct_seed

    segs = distinct_seed(Tables(spark, d).customer, "c_mktsegment")
    return segs.withColumn("is_stackable_group", F.col("name").isin("BUILDING", "AUTOMOBILE"))


@register("etl_crm", """
SELECT * FROM (
  SELECT o_orderkey AS visit_id, 'own' AS product, ROUND(o_totalprice / 1000, 2) AS price_per_tray, CAST(o_orderdate AS DATE) + 10 AS best_by FROM orders
  UNION ALL SELECT o_orderkey, 'competitor', CASE WHEN o_orderstatus = 'O' THEN ROUND(o_totalprice / 900, 2) END,
         CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) + 7 END FROM orders)
WHERE COALESCE(CAST(price_per_tray AS VARCHAR), CAST(best_by AS VARCHAR)) IS NOT NULL""")
def q_etl_crm(spark, d):
    o = Tables(spark, d).orders
    wide = o.select(F.col("o_orderkey").alias("visit_id"),
                    arith.round_binary(F.col("o_totalprice") / 1000, 2).alias("own_price_per_tray"),
                    F.date_add(F.col("o_orderdate").cast("date"), 10).alias("own_best_by"),
                    F.when(F.col("o_orderstatus") == "O", arith.round_binary(F.col("o_totalprice") / 900, 2)).alias("competitor_price_per_tray"),
                    F.when(F.col("o_orderstatus") == "O", F.date_add(F.col("o_orderdate").cast("date"), 7)).alias("competitor_best_by"))
    return rs.unpivot_prefix_groups(wide, ["visit_id"], ["own", "competitor"], ["price_per_tray", "best_by"], label="product")


@register("etl_chemistry", """
SELECT o_orderkey AS sample_id, CAST(o_orderdate AS DATE) AS sample_date, NULLIF(trim(o_orderpriority), '') AS nutrient,
       TRY_CAST(NULLIF(replace(trim(CAST(o_totalprice AS VARCHAR)), ',', ''), '') AS DOUBLE) AS result
FROM orders WHERE o_orderstatus <> 'P'""")
def q_etl_chemistry(spark, d):
    o = Tables(spark, d).orders
    x = o.select(F.col("o_orderkey").alias("sample_id"), F.col("o_orderdate").cast("date").alias("sample_date"),
                 text.clean_text("o_orderpriority").alias("nutrient"), parse.parse_number(F.col("o_totalprice").cast("string")).alias("result"),
                 "o_orderstatus")
    kept, _ = rows.quarantine(x, [("pending", F.col("o_orderstatus") == "P", None), ("no_result", F.col("result").isNull(), None)])
    return kept.drop("o_orderstatus")
