"""Remaining §2 operators, each with its own binding to the given tables:
date parts, batch channel pivot, residual deltas, the unpivot variants,
child fan-out, channel-index explode, row scope, entitlements, principal
resolution, session defaults, day series and tare resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions.arith import date_parts
from furrow.functions.codes import lot_code
from furrow.functions.formula import formula_join
from furrow.operators import aggregates as agg
from furrow.operators import reshape as rs
from furrow.operators import rules
from furrow.plans.registry import register
from furrow.sources.tables import Tables


@register("date_parts", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, year(l_shipdate) AS year, month(l_shipdate) AS month,
       isoyear(l_shipdate) AS iso_year, weekofyear(l_shipdate) AS iso_week, dayofweek(l_shipdate) AS dow FROM lineitem""")
def q_date_parts(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("d"))
    return date_parts(li, "d")


CHANNELS = ("view", "click", "purchase", "error", "signup")


@register("pivot_channels", """
SELECT user_id, date_trunc('hour', ts) AS hr, """ + ", ".join(
    f"arg_max(value, ts) FILTER (WHERE event_type = '{c}') AS {c}" for c in CHANNELS) + """
FROM events GROUP BY 1, 2""")
def q_pivot_channels(spark, d):
    ev = Tables(spark, d).events.withColumn("hr", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return agg.pivot_channels(ev, ["user_id", "hr"], "event_type", "value", CHANNELS, "ts")


@register("delta_residual", """
SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
       SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS filled,
       SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS open,
       SUM(CAST(o_totalprice AS DECIMAL(18,2))) - SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END)
         - SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS other
FROM orders GROUP BY 1""")
def q_delta_residual(spark, d):
    o = Tables(spark, d).orders.withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)"))
    zero = F.lit(0).cast("decimal(18,2)")
    g = o.groupBy("o_custkey").agg(F.sum("amt").alias("total"),
                                   F.sum(F.when(F.col("o_orderstatus") == "F", F.col("amt")).otherwise(zero)).alias("filled"),
                                   F.sum(F.when(F.col("o_orderstatus") == "O", F.col("amt")).otherwise(zero)).alias("open"))
    return g.withColumn("other", F.col("total") - F.col("filled") - F.col("open"))


@register("unpivot_tests", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 'quantity' AS test, l_quantity AS value_numeric, NULL::VARCHAR AS value_enum, l_quantity <= 45 AS passed FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'return_flag', NULL, l_returnflag, l_returnflag IN ('A', 'N') FROM lineitem)""")
def q_unpivot_tests(spark, d):
    li = Tables(spark, d).lineitem
    slots = [{"test": F.lit("quantity"), "value_numeric": F.col("l_quantity"), "value_enum": F.lit(None).cast("string"),
              "passed": F.col("l_quantity") <= 45},
             {"test": F.lit("return_flag"), "value_numeric": F.lit(None).cast("double"), "value_enum": F.col("l_returnflag"),
              "passed": F.col("l_returnflag").isin("A", "N")}]
    return rs.unpivot_slots(li, ["l_orderkey", "l_linenumber"], slots, drop_all_null=False).drop("slot")


@register("unpivot_prefix_groups", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 'accepted' AS product, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS qty,
         CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS price FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'returned', CASE WHEN l_returnflag = 'R' THEN l_quantity END,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice END FROM lineitem) WHERE COALESCE(qty, price) IS NOT NULL""")
def q_unpivot_prefix_groups(spark, d):
    li = Tables(spark, d).lineitem
    wide = li.select("l_orderkey", "l_linenumber",
                     *[F.when(F.col("l_returnflag") == flag, F.col(src)).alias(f"{p}_{f}")
                       for p, flag in (("accepted", "A"), ("returned", "R")) for f, src in (("qty", "l_quantity"), ("price", "l_extendedprice"))])
    return rs.unpivot_prefix_groups(wide, ["l_orderkey", "l_linenumber"], ["accepted", "returned"], ["qty", "price"], label="product")


@register("unpivot_variety_blocks", """
SELECT * FROM (
  SELECT o_orderkey, 'K' AS variety, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS seeds FROM orders
  UNION ALL SELECT o_orderkey, 'J', CASE WHEN o_orderstatus = 'O' THEN o_totalprice END FROM orders
  UNION ALL SELECT o_orderkey, 'E', CASE WHEN o_orderstatus = 'P' THEN o_totalprice END FROM orders) WHERE seeds IS NOT NULL""")
def q_unpivot_variety_blocks(spark, d):
    o = Tables(spark, d).orders
    wide = o.select("o_orderkey", *[F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).alias(f"{v}_seeds")
                                    for v, s in (("K", "F"), ("J", "O"), ("E", "P"))])
    return rs.unpivot_prefix_groups(wide, ["o_orderkey"], ["K", "J", "E"], ["seeds"], label="variety")


@register("unpivot_scenarios", """
SELECT * FROM (
  SELECT o_orderkey, 'current' AS scenario, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
  UNION ALL SELECT o_orderkey, 'planned', CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.1 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) FROM orders
  WHERE o_orderstatus <> 'F') WHERE amount IS NOT NULL""")
def q_unpivot_scenarios(spark, d):
    o = Tables(spark, d).orders
    amt = F.col("o_totalprice").cast("decimal(18,2)")
    wide = o.select("o_orderkey", amt.alias("current_amount"),
                    F.when(F.col("o_orderstatus") != "F", F.round(amt * F.lit(1.1).cast("decimal(2,1)"), 2).cast("decimal(18,2)")).alias("planned_amount"))
    return rs.unpivot_prefix_groups(wide, ["o_orderkey"], ["current", "planned"], ["amount"], label="scenario")


@register("unpivot_photos", """
SELECT * FROM (
  SELECT page_id, 'main' AS photo_type, url AS photo_url, 'page ' || CAST(page_id AS VARCHAR) AS caption FROM pages
  UNION ALL SELECT page_id, 'thumb', CASE WHEN contains(url, '#') THEN NULL ELSE url || '?thumb' END, 'thumbnail' FROM pages)
WHERE photo_url IS NOT NULL""")
def q_unpivot_photos(spark, d):
    p = Tables(spark, d).pages
    wide = p.select("page_id", F.col("url").alias("main_photo_url"), F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("main_caption"),
                    F.when(~F.col("url").contains("#"), F.concat("url", F.lit("?thumb"))).alias("thumb_photo_url"),
                    F.lit("thumbnail").alias("thumb_caption"))
    out = rs.unpivot_prefix_groups(wide, ["page_id"], ["main", "thumb"], ["photo_url", "caption"], label="photo_type", drop_if_null=["photo_url"])
    return out


@register("fanout_children", """
SELECT o_orderkey AS parent_id, 'line' AS kind, CAST(l_linenumber AS VARCHAR) AS child FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT o_orderkey, 'note', o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def q_fanout_children(spark, d):
    t = Tables(spark, d)
    staged = t.orders.select(F.col("o_orderkey").alias("parent_id"), "o_orderpriority", "o_orderstatus")
    li = t.lineitem.select(F.col("l_orderkey").alias("parent_id"), "l_linenumber")
    kids = rs.fanout_children(staged, {
        "line": lambda s: s.join(li, "parent_id").select("parent_id", F.lit("line").alias("kind"), F.col("l_linenumber").cast("string").alias("child")),
        "note": lambda s: s.where(F.col("o_orderstatus") == "P").select("parent_id", F.lit("note").alias("kind"), F.col("o_orderpriority").alias("child")),
    })
    return kids["line"].unionByName(kids["note"])


# Fixed binding values: channel types with exponent; 'error' readings are skipped.
CHANNEL_TYPES = [("view", "TEMPERATURE", 1), ("click", "HUMIDITY", 0), ("purchase", "WIND_AVERAGE_SPEED", 1), ("signup", "RAIN", 0)]


@register("explode_channel_index", """
WITH dev AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT dev.user_id AS device_id, c.label, c.data_type, c.exponent
FROM dev JOIN (VALUES ('view', 'TEMPERATURE', 1), ('click', 'HUMIDITY', 0), ('purchase', 'WIND_AVERAGE_SPEED', 1), ('signup', 'RAIN', 0))
  c(label, data_type, exponent) ON c.label = dev.event_type""")
def q_explode_channel_index(spark, d):
    from furrow.sources.readers import static_dim

    ev = Tables(spark, d).events
    sensors = ev.groupBy(F.col("user_id").alias("device_id")).agg(F.collect_set("event_type").alias("channels"))
    types = static_dim(spark, CHANNEL_TYPES, "label string, data_type string, exponent int")
    return rs.explode_channel_index(sensors, "device_id", "channels", types, "label")


@register("policy_row_scope", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey = 7 OR c_custkey = 7""")
def q_policy_row_scope(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_nationkey", F.lit(1).alias("org_id"), F.col("c_nationkey").cast("bigint").alias("mgr"))
    p = rules.Principal("user-7", orgs=(1,), role_by_org={1: "Manager"}, employee_by_org={1: 7})
    return rules.policy_row_scope(c, p, "org_id", "c_custkey", "mgr").select("c_custkey", "c_nationkey")


@register("nav_entitlements", """
WITH u AS (SELECT s_suppkey, s_nationkey // 5 AS level FROM supplier),
m AS (SELECT n_name AS module, n_regionkey AS required FROM nation),
g AS (SELECT DISTINCT l_suppkey AS s_suppkey, 'NATION_' || CAST(l_partkey % 25 AS VARCHAR) AS module FROM lineitem)
SELECT DISTINCT u.s_suppkey, m.module FROM u JOIN m ON u.level >= m.required
WHERE EXISTS (SELECT 1 FROM g WHERE g.s_suppkey = u.s_suppkey AND g.module = m.module)""")
def q_nav_entitlements(spark, d):
    t = Tables(spark, d)
    users = t.supplier.select("s_suppkey", (F.col("s_nationkey") / 5).cast("int").alias("level"))
    modules = t.nation.select(F.col("n_name").alias("module"), F.col("n_regionkey").alias("required"), F.lit(True).alias("enabled"))
    grants = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.concat(F.lit("NATION_"), (F.col("l_partkey") % 25).cast("string")).alias("module"))
    return rules.nav_entitlements(users, modules, grants, "s_suppkey", "level", "module", "required", "enabled").select("s_suppkey", "module").distinct()


@register("auth_employee_id", """
SELECT c_mktsegment AS org_id, min(c_custkey) AS employee_id FROM customer WHERE c_nationkey = 7 AND c_acctbal >= 0 GROUP BY 1""")
def q_auth_employee_id(spark, d):
    """Per org the employee of one signed-in user; negative balances stand for deleted records."""
    return _principal(spark, d).select("org_id", "employee_id")


@register("auth_access_level", """
SELECT c_mktsegment AS org_id, CASE arg_min(c_custkey, c_custkey) % 5 WHEN 0 THEN 'Owner' WHEN 1 THEN 'Admin' WHEN 2 THEN 'Manager'
  WHEN 3 THEN 'Team Lead' ELSE 'Employee' END AS access_level FROM customer WHERE c_nationkey = 7 AND c_acctbal >= 0 GROUP BY 1""")
def q_auth_access_level(spark, d):
    """Per org the access level of that user's employee."""
    return _principal(spark, d).select("org_id", "access_level")


def _principal(spark, d):
    level = F.element_at(F.array(*[F.lit(x) for x in ("Owner", "Admin", "Manager", "Team Lead", "Employee")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    c = Tables(spark, d).customer.where("c_acctbal >= 0").withColumn("level", level).withColumn("org_id", F.col("c_mktsegment"))
    return rules.resolve_principal(c, "c_nationkey", 7, "org_id", "c_custkey", "level")


@register("pack_session_set_defaults", """
SELECT l.l_orderkey, l.l_linenumber,
  COALESCE(CASE WHEN l.l_linenumber = 1 THEN 'LOT-' || CAST(l.l_orderkey AS VARCHAR) END,
           strftime(l.l_shipdate, '%Y%m%d') || '-' || strftime(o.o_orderdate, '%Y%m%d')) AS lot_code,
  CAST(o.o_orderdate AS DATE) + CAST(COALESCE(p.p_size, 0) AS INTEGER) AS best_by
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey""")
def q_pack_session_set_defaults(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("harvest"))
    li = t.lineitem
    s = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "harvest",
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("LOT-"), F.col("l_orderkey").cast("string"))).alias("given_lot"))
    s = s.withColumn("lot_code", lot_code("l_shipdate", "harvest", "given_lot"))
    s = rules.default_best_by(s, t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey", "harvest", "p_size")
    return s.select("l_orderkey", "l_linenumber", "lot_code", "best_by")


@register("generate_series", """
SELECT user_id, CAST(d AS DATE) AS day FROM (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1),
  LATERAL (SELECT unnest(generate_series(CAST(a AS DATE), CAST(b AS DATE), INTERVAL 1 DAY)) AS d)""")
def q_generate_series(spark, d):
    ev = Tables(spark, d).events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return rs.series_days(ev, "a", "b", clip=False).select("user_id", "day")


# Fixed binding values: tare formulas by part brand suffix (input n = containers).
BRAND_TARE = {"Brand#1": "n*0.5", "Brand#2": "ROUND(n/3)+1"}


@register("tare_resolution", """
SELECT l.l_orderkey, l.l_linenumber, COALESCE(CASE p.p_brand WHEN 'Brand#1' THEN CAST(l.l_quantity AS INTEGER)*0.5
                                                       WHEN 'Brand#2' THEN ROUND(CAST(l.l_quantity AS INTEGER)/3)+1 END, 0.25 * CAST(l.l_quantity AS INTEGER)) AS tare
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def q_tare_resolution(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").withColumn("n", F.col("l_quantity").cast("int"))
    cfg = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in BRAND_TARE.items()) + " AS t(p_brand, formula)")
    j = formula_join(j, cfg, "p_brand", "formula", {"n": "n"}, "tare")
    return j.select("l_orderkey", "l_linenumber", F.coalesce(F.col("tare").cast("double"), F.lit(0.25) * F.col("n")).alias("tare"))
