"""Pack hours and expenses (§2.13 ``etl_pack_hourly`` and ``etl_expenses``, the
tables beyond their main one). The hour sheet is rendered from events: a row
per site, day and clock hour with case counts that run on over the day, crew,
failures and what was left over; the expense documents from orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions import codes, parse
from furrow.operators import aggregates as agg
from furrow.operators import reshape as rs
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.session import spread
from furrow.sources import sinks
from furrow.sources.tables import Tables

SYSTEM = "system@farm"
# Fixed binding values: products and the event type that counts their cases; failure and leftover columns.
PRODUCTS = {"p_view": "view", "p_click": "click", "p_buy": "purchase"}
FAILS = {"film": 3, "tray": 5, "label": 7}
LEFTOVERS = {"lettuce_lb": 4, "cress_lb": 6}
HOUR = ["site_id", "pack_date", "hr"]


def raw_hours(t: Tables) -> DataFrame:
    """The sheet: text cells, blank where a product has not started or nothing is left."""
    e = t.events.select((F.col("user_id") % 10).alias("site_id"), F.col("ts").cast("date").alias("pack_date"), F.hour("ts").alias("hr"), "event_type", "user_id", "event_id")
    counts = [F.count(F.when(F.col("event_type") == kind, 1)).alias(p) for p, kind in PRODUCTS.items()]
    h = e.groupBy(*HOUR).agg(*counts, F.count("*").alias("n"), F.max((F.col("event_type") == "error").cast("int")).alias("errors"), F.sum("user_id").alias("u"))
    day = Window.partitionBy("site_id", "pack_date").orderBy("hr")  # at most 24 rows
    run = lambda p: F.sum(p).over(day)
    return h.select(
        "site_id", F.date_format("pack_date", "M/d/yyyy").alias("pack_date"), F.concat("hr", F.lit(":00")).alias("pack_hour"),
        *[F.when(run(p) == 0, "").when(F.col("hr") == 13, "0").otherwise(run(p).cast("string")).alias(p) for p in PRODUCTS],
        (F.col("n") % 5).cast("string").alias("catchers"), F.col("n").cast("string").alias("packers"), F.when(F.col("n") % 2 == 0, "").otherwise("2").alias("mixers"),
        F.when(F.col("errors") == 1, "yes").otherwise("").alias("metal"), F.when(F.col("u") % 3 == 0, "").otherwise(F.concat(F.lit(" Ann"), F.col("u") % 4, F.lit("@Farm"))).alias("reported_by"),
        *[F.when(F.col("u") % m == 1, (F.col("u") % 9).cast("string")).otherwise("").alias(c) for c, m in FAILS.items()],
        *[F.when(F.col("u") % m == 0, (F.col("n") / 2).cast("string")).otherwise("x").alias(c) for c, m in LEFTOVERS.items()])


def pack_hours(raw: DataFrame) -> DataFrame:
    """Cells to values; rows without a date or hour are left out."""
    x = raw.withColumn("pack_date", parse.parse_date_multi("pack_date")).withColumn("hr", F.regexp_extract("pack_hour", r"^(\d{1,2}):", 1).try_cast("int"))
    for c in (*PRODUCTS, "catchers", "packers", "mixers", *FAILS):
        x = x.withColumn(c, parse.parse_int_trunc(c))
    for c in LEFTOVERS:
        x = x.withColumn(c, parse.parse_number(c, default=0.0))
    x = x.withColumn("reporter", F.nullif(F.lower(F.trim("reported_by")), F.lit("")))
    return x.where(F.col("pack_date").isNotNull() & F.col("hr").isNotNull()).withColumn("pack_end_hour", _at("hr"))


def _at(hr: str):
    return (F.col("pack_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col(hr).cast("int"))).cast("timestamp_ntz")


def pack_cases(hours: DataFrame) -> DataFrame:
    """Cases of each product and hour: what the running count of the day has grown by, never below zero."""
    long = rs.unpivot_measures(hours.select(*HOUR, "pack_end_hour", *PRODUCTS), [*HOUR, "pack_end_hour"], list(PRODUCTS), "product_id", "cum")
    return win.cumulative_to_delta(long, ["site_id", "pack_date", "product_id"], "hr", "cum", "cases_packed").where("cases_packed > 0")


def pack_sessions(hours: DataFrame, cases: DataFrame) -> DataFrame:
    """A session per day and product that was packed, from its first to its last hour; by the day's first reporter."""
    spans = cases.groupBy("site_id", "pack_date", "product_id").agg(F.min("pack_end_hour").alias("started_at"), F.max("pack_end_hour").alias("stopped_at"))
    first = win.keep_first(hours.where(F.col("reporter").isNotNull()).select("site_id", "pack_date", "hr", "reporter"), ["site_id", "pack_date"], ["hr"])
    return spans.join(first.select("site_id", "pack_date", "reporter"), ["site_id", "pack_date"], "left") \
        .withColumn("created_by", F.coalesce("reporter", F.lit(SYSTEM))).drop("reporter")


_HOURS_SQL = """
WITH h AS (SELECT user_id % 10 AS site_id, ts::DATE AS pack_date, hour(ts)::INTEGER AS hr, count(*) AS n, bool_or(event_type = 'error') AS metal, sum(user_id) AS u,
""" + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {p}" for p, k in PRODUCTS.items()) + """
  FROM events GROUP BY ALL),
hours AS (SELECT *, pack_date + to_hours(hr) AS pack_end_hour, CASE WHEN u % 3 <> 0 THEN 'ann' || (u % 4)::BIGINT || '@farm' END AS reporter FROM h),
run AS (SELECT site_id, pack_date, hr, pack_end_hour, unnest(['""" + "', '".join(PRODUCTS) + "']) AS product_id, unnest([" + ", ".join(
    f"CASE WHEN sum({p}) OVER w = 0 THEN NULL WHEN hr = 13 THEN 0 ELSE sum({p}) OVER w END" for p in PRODUCTS) + """]) AS cum
  FROM hours WINDOW w AS (PARTITION BY site_id, pack_date ORDER BY hr)),
cases AS (SELECT site_id, pack_date, hr, pack_end_hour, product_id, greatest(cum - coalesce(lag(cum) OVER (PARTITION BY site_id, pack_date, product_id ORDER BY hr), 0), 0)
  AS cases_packed FROM run WHERE cum IS NOT NULL)"""


def _hours(spark, d):
    return pack_hours(raw_hours(Tables(spark, d)))


@register("etl_pack_cases", _HOURS_SQL + " SELECT site_id, pack_date, pack_end_hour, product_id, cases_packed::BIGINT AS cases_packed FROM cases WHERE cases_packed > 0")
def q_etl_pack_cases(spark, d):
    return pack_cases(_hours(spark, d)).select("site_id", "pack_date", "pack_end_hour", "product_id", F.col("cases_packed").cast("bigint").alias("cases_packed"))


@register("etl_pack_sessions", _HOURS_SQL + f""",
firsts AS (SELECT site_id, pack_date, arg_min(reporter, hr) FILTER (reporter IS NOT NULL) AS who FROM hours GROUP BY ALL)
SELECT site_id, pack_date, product_id, min(pack_end_hour) AS started_at, max(pack_end_hour) AS stopped_at, coalesce(any_value(who), '{SYSTEM}') AS created_by
FROM cases JOIN firsts USING (site_id, pack_date) WHERE cases_packed > 0 GROUP BY ALL""")
def q_etl_pack_sessions(spark, d):
    hours = _hours(spark, d)
    return pack_sessions(hours, pack_cases(hours))


@register("etl_pack_labor", _HOURS_SQL + f"""
SELECT site_id, pack_date, pack_end_hour, (n % 5)::INTEGER AS catchers, n::INTEGER AS packers, CASE WHEN n % 2 = 0 THEN 0 ELSE 2 END AS mixers,
  metal AS metal_detected, CASE WHEN metal THEN pack_end_hour END AS metal_detected_at, coalesce(reporter, '{SYSTEM}') AS created_by FROM hours""")
def q_etl_pack_labor(spark, d):
    """Crew of each hour, and whether metal was found."""
    metal = parse.parse_bool("metal")
    return _hours(spark, d).select(
        "site_id", "pack_date", "pack_end_hour", *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("catchers", "packers", "mixers")],
        metal.alias("metal_detected"), F.when(metal, F.col("pack_end_hour")).alias("metal_detected_at"), F.coalesce("reporter", F.lit(SYSTEM)).alias("created_by"))


@register("etl_pack_fails", _HOURS_SQL + """,
f AS (SELECT site_id, pack_date, pack_end_hour, unnest(['""" + "', '".join(FAILS) + "']) AS category, unnest([" + ", ".join(
    f"CASE WHEN u % {m} = 1 THEN u % 9 END" for m in FAILS.values()) + """]) AS fail_count FROM hours)
SELECT site_id, pack_date, pack_end_hour, category, fail_count::INTEGER AS fail_count FROM f WHERE fail_count > 0""")
def q_etl_pack_fails(spark, d):
    hours = _hours(spark, d).select("site_id", "pack_date", "pack_end_hour", *FAILS)
    return rs.unpivot_measures(hours, ["site_id", "pack_date", "pack_end_hour"], list(FAILS), "category", "fail_count").where("fail_count > 0") \
        .withColumn("fail_count", F.col("fail_count").cast("int"))


@register("etl_pack_leftovers", _HOURS_SQL + """
SELECT site_id, pack_date, """ + ", ".join(f"sum(CASE WHEN u % {m} = 0 THEN n / 2 ELSE 0.0 END) AS {c}" for c, m in LEFTOVERS.items()) + """
FROM hours GROUP BY ALL HAVING """ + " OR ".join(LEFTOVERS) .replace("lettuce_lb", "lettuce_lb > 0").replace("cress_lb", "cress_lb > 0"))
def q_etl_pack_leftovers(spark, d):
    """Pounds left over on each day that left any."""
    return agg.day_leftover_rollup(_hours(spark, d), ["site_id", "pack_date"], list(LEFTOVERS))


# ---------------------------------------------------------------- etl_expenses


def purchase_docs(t: Tables) -> DataFrame:
    """Orders as purchase documents: payee, account, credit flag, and lines of which some lack a number, some any detail."""
    line = F.struct(
        F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_extendedprice").cast("decimal(14,2)").alias("Amount"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber")).alias("LineNum"),
        F.when(F.col("l_linenumber") < 5, F.struct(F.concat(F.lit("acct "), F.col("l_suppkey")).alias("AccountRef"), F.col("l_returnflag").alias("ClassRef"))).alias("AccountDetail"),
        F.when(F.col("l_linenumber").between(5, 6), F.struct(F.concat(F.lit("item "), F.col("l_partkey")).alias("AccountRef"), F.lit(None).cast("string").alias("ClassRef"))).alias("ItemDetail"))
    lines = spread(t.lineitem, "l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("Line"))  # the lines of one document
    o = t.orders.select(F.col("o_orderkey").alias("Id"), F.concat(F.lit("payee "), F.col("o_custkey")).alias("EntityRef"), F.col("o_orderpriority").alias("AccountRef"),
                        (F.col("o_orderstatus") == "F").alias("Credit"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("TxnDate"))
    return o.join(lines, o.Id == lines.l_orderkey, "left").drop("l_orderkey")


def purchase_headers(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("Id").alias("expense_id"), F.col("EntityRef").alias("payee_name"), F.col("AccountRef").alias("account_name"),
                       F.coalesce("Credit", F.lit(False)).alias("is_credit"), parse.parse_date_multi("TxnDate").alias("transaction_date"))


def purchase_lines(docs: DataFrame) -> DataFrame:
    """Lines with a detail of either kind; without a number, the place in the document."""
    x = docs.select(F.col("Id").alias("expense_id"), F.posexplode("Line").alias("pos", "l"))
    detail = F.coalesce("l.AccountDetail", "l.ItemDetail")
    return x.where(detail.isNotNull()).select(
        "expense_id", F.coalesce("l.LineNum", F.col("pos") + 1).alias("line_num"), detail["AccountRef"].alias("account_name"), detail["ClassRef"].alias("class_name"),
        F.col("l.Amount").alias("amount"))


_EXPENSE_SQL = """
WITH placed AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice::DECIMAL(14,2), l_returnflag) AS pos
  FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey),
lines AS (SELECT l_orderkey AS expense_id, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber ELSE pos END::INTEGER AS line_num,
    CASE WHEN l_linenumber < 5 THEN 'acct ' || l_suppkey ELSE 'item ' || l_partkey END AS account_name, CASE WHEN l_linenumber < 5 THEN l_returnflag END AS class_name,
    l_extendedprice::DECIMAL(14,2) AS amount FROM placed WHERE l_linenumber < 7)"""


@register("etl_expense_headers", """
SELECT o_orderkey AS expense_id, 'payee ' || o_custkey AS payee_name, o_orderpriority AS account_name, o_orderstatus = 'F' AS is_credit, o_orderdate::DATE AS transaction_date
FROM orders""")
def q_etl_expense_headers(spark, d):
    return purchase_headers(purchase_docs(Tables(spark, d)))


@register("etl_expense_lines", _EXPENSE_SQL + " SELECT * FROM lines")
def q_etl_expense_lines(spark, d):
    return purchase_lines(purchase_docs(Tables(spark, d)))


@register("etl_expense_reload", _EXPENSE_SQL + """
SELECT lines.* REPLACE (CASE WHEN o_orderstatus = 'P' THEN account_name || ' moved' ELSE account_name END AS account_name)
FROM lines JOIN orders ON o_orderkey = expense_id WHERE o_orderstatus <> 'P' OR line_num <= 2""")
def q_etl_expense_reload(spark, d):
    """The pending documents come again with their first two lines moved to other accounts: all their old lines go."""
    docs = purchase_docs(Tables(spark, d))
    again = docs.join(Tables(spark, d).orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("Id")), "Id", "left_semi")
    moved = purchase_lines(again).where("line_num <= 2").withColumn("account_name", F.concat("account_name", F.lit(" moved")))
    _, children = sinks.upsert_parent_replace_children(purchase_headers(docs), purchase_lines(docs), purchase_headers(again), moved, ["expense_id"], ["expense_id"])
    return children
