"""Role bindings: the given tables presented in the shapes the operators
and views expect (FIXTURES §4). Each binding exists twice: as a Spark
function and as the equivalent SQL CTE text used by the oracles, so both
sides start from identical inputs.

Money is DECIMAL(18,2) from the start and hours are exact multiples of
1/2 or 1/100, so sums are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.sources.tables import Tables

# Fixed binding parameters.
AS_OF = "2002-01-01"          # "today" for age / forecast columns (after all data)
PAYROLL_SINCE = "1995-01-01"  # the view's check-date lower bound, bound to the data start
ORG = 1


def payroll(t: Tables) -> DataFrame:
    """orders as payroll lines: employee = o_custkey, check date = month of
    o_orderdate, cost = o_totalprice, standard = o_orderstatus <> 'P'."""
    o = t.orders
    cost = F.col("o_totalprice").cast("decimal(18,2)")
    hours = F.round(cost * F.lit(0.0004).cast("decimal(5,4)"), 2)
    reg_h = F.least(hours, F.lit(80).cast("decimal(18,2)"))
    reg_pay = F.round(cost * F.lit(0.8).cast("decimal(2,1)"), 2)
    chk = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return o.select(
        F.col("o_orderkey").alias("payroll_id"),
        F.lit(ORG).alias("org_id"),
        F.col("o_custkey").alias("hr_employee_id"),
        chk.alias("check_date"),
        chk.alias("pay_period_start"),
        F.last_day(chk).alias("pay_period_end"),
        F.col("o_orderpriority").alias("hr_department_id"),
        F.col("o_orderstatus").alias("hr_work_authorization_id"),
        F.substr(F.col("o_orderpriority"), F.lit(1), F.lit(1)).alias("wc"),
        (F.col("o_orderstatus") != "P").alias("is_standard"),
        F.lit("HRB").alias("payroll_processor"),
        F.lit(False).alias("is_deleted"),
        hours.alias("total_hours"),
        reg_h.alias("regular_hours"),
        F.when(F.col("o_orderstatus") == "P", F.lit(8).cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)")).alias("pto_hours"),
        (hours - reg_h).alias("discretionary_overtime_hours"),
        cost.alias("total_cost"),
        reg_pay.alias("regular_pay"),
        (cost - reg_pay).alias("discretionary_overtime_pay"),
        cost.alias("gross_wage"),
    )


PAYROLL_SQL = f"""
payroll AS (
  SELECT o_orderkey AS payroll_id, {ORG} AS org_id, o_custkey AS hr_employee_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS check_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS pay_period_start,
         last_day(CAST(date_trunc('month', o_orderdate) AS DATE)) AS pay_period_end,
         o_orderpriority AS hr_department_id, o_orderstatus AS hr_work_authorization_id,
         substr(o_orderpriority, 1, 1) AS wc, o_orderstatus <> 'P' AS is_standard,
         'HRB' AS payroll_processor, false AS is_deleted,
         ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0004 AS DECIMAL(5,4)), 2) AS total_hours,
         LEAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0004 AS DECIMAL(5,4)), 2), CAST(80 AS DECIMAL(18,2))) AS regular_hours,
         CASE WHEN o_orderstatus = 'P' THEN CAST(8 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS pto_hours,
         ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0004 AS DECIMAL(5,4)), 2)
           - LEAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0004 AS DECIMAL(5,4)), 2), CAST(80 AS DECIMAL(18,2))) AS discretionary_overtime_hours,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost,
         ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.8 AS DECIMAL(2,1)), 2) AS regular_pay,
         CAST(o_totalprice AS DECIMAL(18,2)) - ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.8 AS DECIMAL(2,1)), 2) AS discretionary_overtime_pay,
         CAST(o_totalprice AS DECIMAL(18,2)) AS gross_wage
  FROM orders
)"""


def schedule(t: Tables) -> DataFrame:
    """lineitem x orders as scheduled shifts: employee = o_custkey, task =
    l_returnflag, hours = l_quantity (captured hours missing on line 1, so
    the stop - start fallback is exercised), day = l_shipdate."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    start = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(7))
    stop = start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int") * 30)
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.lit(ORG).alias("org_id"),
        F.col("o_custkey").alias("hr_employee_id"),
        F.col("l_returnflag").alias("ops_task_id"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        start.cast("timestamp_ntz").alias("start_time"),
        stop.cast("timestamp_ntz").alias("stop_time"),
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("total_hours"),
        F.lit(False).alias("is_deleted"),
    )


SCHEDULE_SQL = f"""
schedule AS (
  SELECT {ORG} AS org_id, o.o_custkey AS hr_employee_id, l.l_returnflag AS ops_task_id,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         l.l_shipdate + INTERVAL 7 HOUR AS start_time,
         l.l_shipdate + INTERVAL 7 HOUR + to_minutes(CAST(l.l_quantity AS INTEGER) * 30) AS stop_time,
         CASE WHEN l.l_linenumber <> 1 THEN l.l_quantity END AS total_hours,
         false AS is_deleted
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def shifts(t: Tables) -> DataFrame:
    """The schedule with shifts of 5 to 250 minutes in steps of five:
    captured hours only on every third line (to two decimals), the rest
    from stop - start."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    start = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(7))
    stop = start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int") * 5)
    hours = (F.col("l_quantity") / 4).cast("decimal(18,2)")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.lit(ORG).alias("org_id"),
        F.col("o_custkey").alias("hr_employee_id"),
        F.col("l_returnflag").alias("ops_task_id"),
        start.cast("timestamp_ntz").alias("start_time"),
        stop.cast("timestamp_ntz").alias("stop_time"),
        F.when(F.col("l_linenumber") % 3 == 0, hours).alias("total_hours"),
        F.lit(False).alias("is_deleted"),
    )


SHIFTS_SQL = f"""
shifts AS (
  SELECT {ORG} AS org_id, o.o_custkey AS hr_employee_id, l.l_returnflag AS ops_task_id,
         l.l_shipdate + INTERVAL 7 HOUR AS start_time,
         l.l_shipdate + INTERVAL 7 HOUR + to_minutes(CAST(l.l_quantity AS INTEGER) * 5) AS stop_time,
         CASE WHEN l.l_linenumber % 3 = 0 THEN CAST(l.l_quantity / 4 AS DECIMAL(18,2)) END AS total_hours,
         false AS is_deleted
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def tasks(spark) -> DataFrame:
    """Task dimension: a fixed three-row literal table (a JVM-local relation,
    so broadcasting it is safe and no Python worker is involved)."""
    return F.broadcast(spark.sql("SELECT * FROM VALUES ('A', 'Accepted'), ('R', 'Returns'), ('N', CAST(NULL AS STRING)) AS t(id, qb_account)"))


TASKS_SQL = """
tasks AS (SELECT * FROM (VALUES ('A', 'Accepted'), ('R', 'Returns'), ('N', NULL)) v(id, qb_account))"""


def employees(t: Tables) -> DataFrame:
    """customer as employees: id = c_custkey, manager = c_nationkey,
    authorization = c_mktsegment; names from c_name."""
    c = t.customer
    return c.select(
        F.lit(ORG).alias("org_id"),
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("bigint")).alias("compensation_manager_id"),
        F.col("c_mktsegment").alias("hr_work_authorization_id"),
        F.substring_index(F.col("c_name"), "#", 1).alias("first_name"),
        F.substring_index(F.col("c_name"), "#", -1).alias("last_name"),
        F.concat(F.lit("mgr-"), F.col("c_custkey").cast("string")).alias("preferred_name"),
        F.col("c_acctbal"),
    )


EMPLOYEES_SQL = f"""
employees AS (
  SELECT {ORG} AS org_id, c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS BIGINT) END AS compensation_manager_id,
         c_mktsegment AS hr_work_authorization_id,
         split_part(c_name, '#', 1) AS first_name,
         CASE WHEN strpos(c_name, '#') > 0 THEN split_part(c_name, '#', 2) ELSE c_name END AS last_name,
         'mgr-' || CAST(c_custkey AS VARCHAR) AS preferred_name, c_acctbal
  FROM customer
)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
