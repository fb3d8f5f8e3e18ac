"""Remaining named views (§2.12): harvest weigh-ins, housing tenants,
expense flattening and dating, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.arith import age_days, date_parts, safe_ratio
from furrow.functions.text import display_name_case
from furrow.operators import joins as jn
from furrow.operators import rows
from furrow.plans import bind
from furrow.plans.registry import register
from furrow.sources.tables import Tables

# Greenhouse display names for site codes.
GREENHOUSE_NAMES = {"01": "GH1", "02": "GH2", "03": "GH3", "04": "GH4", "05": "GH5", "06": "GH6", "07": "GH7", "08": "GH8",
                    "ko": "Kona", "hk": "HK", "hi": "Hilo", "wa": "Waimea"}


def harvest_weights(t: Tables) -> DataFrame:
    """lineitem as harvest weigh-ins: site = line number (two digits),
    farm from the return flag, batch = the order."""
    li = t.lineitem
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("id"),
        F.col("l_shipdate").cast("date").alias("harvest_date"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("site_id"),
        F.when(F.col("l_returnflag") == "N", "Cuke").when(F.col("l_returnflag") == "A", "Lettuce").otherwise("Other").alias("farm_id"),
        F.col("l_linestatus").alias("grow_grade_id"),
        (F.col("l_quantity") * 2.5).alias("net_weight"), (F.col("l_quantity") * 2.5 + 1).alias("gross_weight"),
        F.col("l_quantity").cast("int").alias("number_of_containers"), F.lit("lb").alias("weight_uom"),
        F.col("l_orderkey").alias("seed_batch_id"), F.lit(bind.ORG).alias("org_id"), F.lit(False).alias("is_deleted"))


def cuke_harvest(h: DataFrame, batches: DataFrame, items: DataFrame) -> DataFrame:
    """Weigh-ins of one farm with house name, variety and age of the batch; the variety is that of the item sown."""
    j = jn.star_left_join(rows.filter_soft_delete(h.where(F.col("farm_id") == "Cuke")), [(batches, "seed_batch_id"), (items, "invnt_item_id")])
    return j.select("id", "harvest_date", "site_id", display_name_case("site_id", GREENHOUSE_NAMES).alias("greenhouse"),
                    F.upper(F.coalesce(F.col("grow_variety_id"), F.lit(""))).alias("variety"), F.col("grow_grade_id").alias("grade"),
                    F.col("net_weight").alias("greenhouse_net_weight"), "gross_weight", "number_of_containers", "weight_uom",
                    "seed_batch_id", "seeding_date", age_days("harvest_date", "seeding_date").alias("days_since_seed"), "org_id", "farm_id")


def lettuce_harvest(h: DataFrame, batches: DataFrame, items: DataFrame) -> DataFrame:
    """Weigh-ins of ponds, with the name of the item sown and pounds per board."""
    j = jn.star_left_join(rows.filter_soft_delete(h.where(F.col("farm_id") == "Lettuce")), [(batches, "seed_batch_id"), (items, "invnt_item_id")])
    return j.select("id", "harvest_date", F.upper("site_id").alias("pond"), F.coalesce(F.col("item_name"), F.lit("")).alias("seed_name"),
                    F.col("number_of_containers").alias("boards_per_pond"),
                    safe_ratio(F.col("net_weight"), F.col("number_of_containers"), 0.0).alias("pounds_per_board"),
                    F.col("net_weight").alias("greenhouse_net_weight"), "gross_weight", "seed_batch_id", "org_id", "farm_id")


def _batches_items(t: Tables):
    # a batch of every ninth customer has no item
    item = F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey") % 200)
    b = t.orders.select(F.col("o_orderkey").alias("seed_batch_id"), F.col("o_orderdate").cast("date").alias("seeding_date"), item.alias("invnt_item_id"))
    i = t.part.select(F.col("p_partkey").alias("invnt_item_id"), F.substr(F.lower("p_type"), F.lit(1), F.lit(1)).alias("grow_variety_id"),
                      F.col("p_name").alias("item_name"))
    return b, i


def _weighed_sql(flag: str) -> str:
    """The weigh-ins of a farm beside their batch and the item sown."""
    return f"""
WITH sown AS (SELECT o_orderkey AS batch, o_orderdate::DATE AS day, p_type, p_name
  FROM orders LEFT JOIN part ON p_partkey = o_custkey % 200 AND o_custkey % 9 <> 0),
weighed AS (SELECT *, printf('%d-%d-%d-%d', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, 2.5 * l_quantity AS net, l_shipdate::DATE AS picked
  FROM lineitem LEFT JOIN sown ON batch = l_orderkey WHERE l_returnflag = '{flag}')"""


@register("cuke_harvest", _weighed_sql("N") + f"""
SELECT {bind.ORG} AS org_id, 'Cuke' AS farm_id, id, l_orderkey AS seed_batch_id, day AS seeding_date, picked AS harvest_date, picked - day AS days_since_seed,
  'GH' || l_linenumber AS greenhouse, printf('%02d', l_linenumber) AS site_id, coalesce(upper(left(p_type, 1)), '') AS variety, l_linestatus AS grade,
  l_quantity::INTEGER AS number_of_containers, net AS greenhouse_net_weight, net + 1 AS gross_weight, 'lb' AS weight_uom FROM weighed""")
def q_cuke_harvest(spark, d):
    t = Tables(spark, d)
    return cuke_harvest(harvest_weights(t), *_batches_items(t))


@register("lettuce_harvest", _weighed_sql("A") + f"""
SELECT {bind.ORG} AS org_id, 'Lettuce' AS farm_id, id, l_orderkey AS seed_batch_id, picked AS harvest_date, printf('%02d', l_linenumber) AS pond,
  coalesce(p_name, '') AS seed_name, l_quantity::INTEGER AS boards_per_pond, if(l_quantity >= 1, net / l_quantity::INTEGER, 0) AS pounds_per_board,
  net AS greenhouse_net_weight, net + 1 AS gross_weight FROM weighed""")
def q_lettuce_harvest(spark, d):
    t = Tables(spark, d)
    return lettuce_harvest(harvest_weights(t), *_batches_items(t))


@register("housing_tenants", """
SELECT CASE WHEN c_acctbal > 0 THEN c_nationkey END AS housing_id, 1 AS org_id, c_custkey AS hr_employee_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name, c_mktsegment AS hr_department_id,
  CASE WHEN c_custkey % 4 = 0 THEN DATE '2001-06-01' END AS end_date
FROM customer WHERE (CASE WHEN c_acctbal > 0 THEN c_nationkey END) IS NOT NULL
  AND ((CASE WHEN c_custkey % 4 = 0 THEN DATE '2001-06-01' END) IS NULL OR (CASE WHEN c_custkey % 4 = 0 THEN DATE '2001-06-01' END) > DATE '2000-01-01')""")
def q_housing_tenants(spark, d):
    c = Tables(spark, d).customer
    e = c.select(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("housing_id"), F.lit(bind.ORG).alias("org_id"),
                 F.col("c_custkey").alias("hr_employee_id"), F.substring_index("c_name", "#", 1).alias("first_name"),
                 F.substring_index("c_name", "#", -1).alias("last_name"), F.col("c_mktsegment").alias("hr_department_id"),
                 F.when(F.col("c_custkey") % 4 == 0, F.lit("2001-06-01").cast("date")).alias("end_date"))
    return rows.filter_active_asof(e.where(F.col("housing_id").isNotNull()), "end_date", "2000-01-01")


@register("expense_summary", """
SELECT 1 AS org_id, c.c_name AS payee_name, o.o_orderpriority AS funding_account, o.o_orderstatus = 'F' AS is_credit,
  CAST(o.o_orderdate AS DATE) AS transaction_date, l.l_linenumber AS line_num, l.l_returnflag AS expense_account, l.l_linestatus AS class_name,
  CAST(l.l_extendedprice AS DECIMAL(14,2)) AS amount
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""")
def q_expense_summary(spark, d):
    t = Tables(spark, d)
    h = t.orders.where(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")).select(
        F.lit(bind.ORG).alias("org_id"), F.col("o_orderkey").alias("expense_id"), "o_custkey", F.col("o_orderpriority").alias("funding_account"),
        (F.col("o_orderstatus") == "F").alias("is_credit"), F.col("o_orderdate").cast("date").alias("transaction_date"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("expense_id"), F.col("l_linenumber").alias("line_num"),
                              F.col("l_returnflag").alias("expense_account"), F.col("l_linestatus").alias("class_name"),
                              F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"))
    payee = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("payee_name"))
    j = jn.star_left_join(h, [(payee, "o_custkey"), (lines, "expense_id")])
    return j.select("org_id", "payee_name", "funding_account", "is_credit", "transaction_date", "line_num", "expense_account", "class_name", "amount")


@register("expense_dated", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS txn_date, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE l_returnflag <> 'R'""")
def q_expense_dated(spark, d):
    li = rows.filter_soft_delete(Tables(spark, d).lineitem.withColumn("is_deleted", F.col("l_returnflag") == "R"))
    x = date_parts(li.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("txn_date")), "txn_date")
    return x.select("l_orderkey", "l_linenumber", "txn_date", "year", "month")
