"""Nightly load jobs (§2.13) as compositions of the library operators.

Each job starts from a raw, sheet-like rendering of a given table (text
cells, drifting values, duplicates) and produces the typed, resolved,
de-duplicated table the source system loads; the registered query is
the job's main output table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import arith, codes, parse, text
from furrow.operators import aggregates as agg
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import rows
from furrow.operators import windows as win
from furrow.operators.rules import flag_out_of_range
from furrow.plans.cleaning import proper_case_sql
from furrow.plans.registry import register
from furrow.session import parts_for, spread
from furrow.sources import sinks
from furrow.sources.tables import Tables

# ---------------------------------------------------------------- etl_payroll


# Number columns of the sheet (sheet name where it differs) in the order of the loaded table.
PAYROLL_NUMBERS = {
    "regular_hours": None, "overtime_hours": None, "discretionary_overtime_hours": None, "pto_hours": "pto_hours_taken", "total_hours": None,
    "pto_hours_accrued": None, "regular_pay": None, "overtime_pay": None, "discretionary_overtime_pay": None, "pto_pay": None,
    "other_pay": None, "bonus_pay": None, "auto_allowance": "allowance_auto", "per_diem": "allowance_per_diem", "gross_wage": None,
    "fit": None, "sit": None, "social_security": None, "medicare": None, "comp_plus": None, "hds_dental": None, "pre_tax_401k": None,
    "auto_deduction": None, "child_support": None, "program_fees": None, "net_pay": None, "labor_tax": None, "other_tax": None,
    "workers_compensation": None, "health_benefits": None, "other_health_charges": None, "admin_fees": None, "hawaii_get": None,
    "other_charges": None, "tdi": "ex_invoice_tdi", "total_cost": None}
# Fixed binding values: department cells and the departments they stand for.
DEPARTMENTS = {"1-urgent": "pack", "2-high": "grow", "3-medium": "maintenance"}
PAY_STRUCTURES = ("Hourly", "Salary")


def _number_cell(i: int, k: str, cost: str, engine: str) -> str:
    """Cell text of the i-th number column: blank on every 7th row, else a multiple of the cost with separators."""
    value = f"CAST({cost} * {i + 1} AS DECIMAL(18,2))"
    shown = f"format('{{:,.2f}}', CAST({value} AS DOUBLE))" if engine == "duckdb" else f"format_number({value}, 2)"
    return f"CASE WHEN ({k} + {i}) % 7 = 0 THEN '' ELSE {shown} END"


def raw_payroll(t: Tables) -> DataFrame:
    """orders x customer rendered as the payroll sheet: id cell sometimes
    blank, name cell with case / spacing drift or of a line without an
    employee, 'd1 - d2' pay period, blank check date, departments and
    structures in free spelling, amounts with thousands separators or blank."""
    o, c = t.orders, t.customer
    j = o.join(c.select("c_custkey", "c_name"), o.o_custkey == c.c_custkey).withColumn("cost", F.col("o_totalprice").cast("decimal(18,2)"))
    k = F.col("o_orderkey")
    name = F.when(k % 97 == 0, "Adjustment").when(k % 89 == 0, " ").when(k % 2 == 0, F.upper(F.col("c_name"))).otherwise(F.concat(F.lit("  "), F.col("c_name")))
    cells = [F.expr(_number_cell(i, "o_orderkey", "cost", "spark")).alias(sheet or out) for i, (out, sheet) in enumerate(PAYROLL_NUMBERS.items())]
    return j.select(
        k.alias("row_no"), F.when(k % 3 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("employee_id"), name.alias("full_name"),
        F.when(k % 13 != 0, F.concat(F.date_format("o_orderdate", "M/d/yyyy"), F.lit(" - "),
                                     F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 13), "M/d/yyyy"))).otherwise("").alias("pay_period"),
        F.when(k % 13 == 0, F.when(k % 26 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))).otherwise("").alias("check_date"),
        F.concat(F.lit(" "), F.upper("o_orderpriority")).alias("department"), F.lower("o_orderstatus").alias("status"),
        F.when(k % 4 == 0, F.lit(" ")).otherwise(F.substr("o_orderpriority", F.lit(1), F.lit(1))).alias("workers_compensation_code"),
        F.element_at(F.array(*[F.lit(x) for x in ("HOURLY", "salary ", "weekly", "")]), (k % 4 + 1).cast("int")).alias("pay_structure"),
        F.when(k % 5 == 0, "ADP ").otherwise(" ").alias("source"), F.when(F.col("o_orderstatus") != "P", " True").otherwise("no").alias("is_standard"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("INV"), k.cast("string"))).alias("invoice_number"), *cells)


def payroll_employees(t: Tables) -> DataFrame:
    """customers as employees; every eleventh has left and is unknown."""
    c = t.customer.where("c_custkey % 11 <> 0")
    return c.select(text.slug("c_name").alias("id"), F.col("c_custkey").cast("string").alias("payroll_id"), F.upper("c_name").alias("full_name"),
                    F.lower("c_mktsegment").alias("hr_department_id"), F.lit("1099").alias("hr_work_authorization_id"),
                    F.substr("c_mktsegment", F.lit(1), F.lit(2)).alias("wc"),
                    F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("overtime_threshold"))


def _named_rows(raw: DataFrame) -> DataFrame:
    """Rows of a person: blank names and adjustment lines are no payroll lines."""
    x = raw.withColumn("_name", F.upper(text.strip_all("full_name"))).withColumn("_eid", F.coalesce(text.strip_all("employee_id"), F.lit("")))
    return x.where((F.col("_name") != "") & (F.col("_name") != "ADJUSTMENT"))


def _employees_of(x: DataFrame, employees: DataFrame) -> DataFrame:
    """Each different (_name, _eid) of the sheet with its employee _e: by payroll id, else by name; ids and names are unique
    among employees (the least id otherwise). The many rows without an id are looked up by name only."""
    cols = ["id", "payroll_id", "hr_department_id", "hr_work_authorization_id", "wc", "overtime_threshold"]
    packed = F.struct(*cols)
    by_id = employees.where("payroll_id <> ''").groupBy(F.col("payroll_id").alias("_eid")).agg(F.min(packed).alias("_by_id"))
    by_name = employees.groupBy(F.col("full_name").alias("_name")).agg(F.min(packed).alias("_by_name"))
    people = x.select("_name", "_eid").distinct()
    with_id = people.where("_eid <> ''").join(by_id, "_eid", "left").select("_name", "_eid", "_by_id")
    without = people.where("_eid = ''").select("_name", "_eid", F.lit(None).cast(with_id.schema["_by_id"].dataType).alias("_by_id"))
    found = with_id.unionByName(without).join(by_name, "_name", "left")
    return found.select("_name", "_eid", F.coalesce("_by_id", "_by_name").alias("_e"))


def etl_payroll(raw: DataFrame, employees: DataFrame, departments=None, authorizations=("H2A", "F", "O")) -> DataFrame:
    """Payroll lines with employee, period, snapshots and every number column; undated lines are left out."""
    named = _named_rows(raw)
    # the wide rows are shuffled once, by name and id: the rows without an id are not one key
    people = text.map_distinct(_employees_of(named, employees), "_name", text.proper_case, "employee_name")
    x = parse.with_split_period(named, "pay_period", "check_date", out="_p").where(F.col("_p.check_date").isNotNull())
    x = x.join(people, ["_name", "_eid"], "left")
    blank = lambda c: F.when(text.strip_all(c) != "", text.strip_all(c))
    pairs = [F.lit(v) for kv in (departments or DEPARTMENTS).items() for v in kv]
    department = F.try_element_at(F.create_map(*pairs), F.lower(text.strip_all("department")))
    status = F.try_element_at(F.create_map(*[F.lit(v) for a in authorizations for v in (a.lower(), a)]), F.lower(text.strip_all("status")))
    structure = F.initcap(text.strip_all("pay_structure"))
    own = F.coalesce(F.col("_e.id"), text.slug("_name"))
    # one parse over the array of cells: 36 inlined ones would not fit a generated method
    parsed = F.transform(F.array(*[sheet or out for out, sheet in PAYROLL_NUMBERS.items()]), lambda c: parse.parse_number(c, default=0, dtype="decimal(18,2)"))
    x = x.withColumn("_numbers", parsed)
    numbers = [F.get("_numbers", F.lit(i)).alias(out) for i, out in enumerate(PAYROLL_NUMBERS)]
    return x.select(
        "row_no", own.alias("hr_employee_id"), F.coalesce(blank("_eid"), F.col("_e.payroll_id"), own).alias("payroll_id"),
        F.col("_p.start").alias("pay_period_start"), F.col("_p.end").alias("pay_period_end"), F.col("_p.check_date").alias("check_date"),
        blank("invoice_number").alias("invoice_number"), F.coalesce(blank("source"), F.lit("HRB")).alias("payroll_processor"),
        (F.lower(text.strip_all("is_standard")) == "true").alias("is_standard"), "employee_name",
        F.coalesce(department, F.col("_e.hr_department_id")).alias("hr_department_id"),
        F.coalesce(status, F.col("_e.hr_work_authorization_id")).alias("hr_work_authorization_id"),
        F.coalesce(blank("workers_compensation_code"), F.col("_e.wc")).alias("wc"),
        F.when(structure.isin(*PAY_STRUCTURES), structure).alias("pay_structure"),
        F.col("_e.overtime_threshold").alias("overtime_threshold"), *numbers)


def former_employees(raw: DataFrame, employees: DataFrame, departments=None) -> DataFrame:
    """Inactive employee records for the names that no employee answers to: one per name, from its first row; an id that
    exists already is never overwritten."""
    named = _named_rows(raw)
    x = named.join(_employees_of(named, employees), ["_name", "_eid"], "left").where("_e IS NULL")
    pairs = [F.lit(v) for kv in (departments or DEPARTMENTS).items() for v in kv]
    first = win.keep_first(x.select("_name", "_eid", "department", "workers_compensation_code", "source", "row_no"), ["_name"], ["row_no"])
    tail = F.regexp_replace("_name", r"^\S+\s*", "")
    out = first.select(
        text.slug("_name").alias("id"), F.when(tail != "", text.proper_case(tail)).otherwise("Unknown").alias("first_name"),
        text.proper_case(F.regexp_extract("_name", r"^\S+", 0)).alias("last_name"),
        F.try_element_at(F.create_map(*pairs), F.lower(text.strip_all("department"))).alias("hr_department_id"),
        F.when(F.col("_eid") != "", F.col("_eid")).alias("payroll_id"), text.clean_text("workers_compensation_code").alias("wc"),
        text.clean_text("source").alias("payroll_processor"), F.lit(True).alias("is_deleted"))
    return out.join(employees.select("id"), "id", "left_anti")


def _raw_payroll_sql() -> str:
    cells = ", ".join(f"{_number_cell(i, 'o_orderkey', 'cost', 'duckdb')} AS n_{out}" for i, out in enumerate(PAYROLL_NUMBERS))
    return f"""
WITH sheet AS (
  SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_custkey::VARCHAR END AS eid,
    CASE WHEN o_orderkey % 97 = 0 THEN 'ADJUSTMENT' WHEN o_orderkey % 89 = 0 THEN '' ELSE upper(c_name) END AS name, o_orderdate::DATE AS d,
    lower(o_orderpriority) AS dep, o_orderstatus AS st, CASE WHEN o_orderkey % 4 <> 0 THEN substr(o_orderpriority, 1, 1) END AS wc,
    CASE o_orderkey % 4 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Salary' END AS structure, CASE WHEN o_orderkey % 5 = 0 THEN 'ADP' END AS source,
    o_orderstatus <> 'P' AS is_standard, CASE WHEN o_orderkey % 6 <> 0 THEN 'INV' || o_orderkey END AS invoice_number, {cells}
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS cost FROM orders) JOIN customer ON c_custkey = o_custkey),
people AS (SELECT trim(regexp_replace(lower(c_name), '[^a-z0-9_]+', '_', 'g'), '_') AS id, c_custkey::VARCHAR AS pid, upper(c_name) AS name,
    lower(c_mktsegment) AS dep, substr(c_mktsegment, 1, 2) AS wc, CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS threshold
  FROM customer WHERE c_custkey % 11 <> 0),
named AS (SELECT * FROM sheet WHERE name NOT IN ('', 'ADJUSTMENT')),
found AS (SELECT s.*, coalesce(a.id, b.id) AS emp, coalesce(a.pid, b.pid) AS emp_pid, CASE WHEN a.id IS NULL THEN b.dep ELSE a.dep END AS emp_dep,
    CASE WHEN a.id IS NULL THEN b.wc ELSE a.wc END AS emp_wc, CASE WHEN a.id IS NULL THEN b.threshold ELSE a.threshold END AS emp_threshold,
    trim(regexp_replace(lower(s.name), '[^a-z0-9_]+', '_', 'g'), '_') AS slug
  FROM named s LEFT JOIN people a ON a.pid = s.eid LEFT JOIN people b ON b.name = s.name)"""


_DEPARTMENT_SQL = "CASE dep " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEPARTMENTS.items()) + " END"


def _payroll_sql() -> str:
    numbers = ", ".join(f"coalesce(TRY_CAST(replace(n_{c}, ',', '') AS DECIMAL(18,2)), 0)::DECIMAL(18,2) AS {c}" for c in PAYROLL_NUMBERS)
    dated = "row_no % 13 <> 0"
    return _raw_payroll_sql() + f"""
SELECT row_no, coalesce(emp, slug) AS hr_employee_id, coalesce(nullif(eid, ''), emp_pid, slug) AS payroll_id, d AS pay_period_start,
  CASE WHEN {dated} THEN d + 13 ELSE d END AS pay_period_end, CASE WHEN {dated} THEN d + 13 ELSE d END AS check_date,
  invoice_number, coalesce(source, 'HRB') AS payroll_processor, is_standard, {proper_case_sql("name")} AS employee_name,
  coalesce({_DEPARTMENT_SQL}, emp_dep) AS hr_department_id, coalesce(CASE WHEN st IN ('F', 'O') THEN st END, CASE WHEN emp IS NOT NULL THEN '1099' END)
    AS hr_work_authorization_id, coalesce(wc, emp_wc) AS wc, structure AS pay_structure, emp_threshold AS overtime_threshold, {numbers}
FROM found WHERE row_no % 26 <> 0"""


@register("etl_payroll", _payroll_sql())
def q_etl_payroll(spark, d):
    t = Tables(spark, d)
    return etl_payroll(raw_payroll(t), payroll_employees(t))


@register("etl_payroll_former_employees", _raw_payroll_sql() + f"""
SELECT slug AS id, CASE WHEN strpos(name, ' ') > 0 THEN {proper_case_sql("regexp_replace(name, '^[^ ]+ *', '')")} ELSE 'Unknown' END AS first_name,
  {proper_case_sql("split_part(name, ' ', 1)")} AS last_name, {_DEPARTMENT_SQL} AS hr_department_id, nullif(eid, '') AS payroll_id, wc,
  source AS payroll_processor, true AS is_deleted
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY row_no) AS rn FROM found WHERE emp IS NULL)
WHERE rn = 1 AND slug NOT IN (SELECT id FROM people)""")
def q_etl_payroll_former_employees(spark, d):
    t = Tables(spark, d)
    return former_employees(raw_payroll(t), payroll_employees(t))


# ---------------------------------------------------------------- etl_schedule


def raw_schedule(t: Tables) -> DataFrame:
    li, o = spread(t.lineitem, "l_orderkey"), t.orders
    j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    task = F.when(F.col("l_returnflag") == "R", "Leave").when(F.col("l_returnflag") == "A", " harvest ").otherwise("PACK")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("employee"), task.alias("task"),
                    F.col("l_shipdate").cast("date").alias("work_date"), F.col("l_quantity").alias("hours"))


def etl_schedule(raw: DataFrame, parts: int | None = None) -> DataFrame:
    """Task names normalised to proper case, leave rows skipped, last row
    wins per (employee, date, task) in sheet order. ``parts``: partitions
    for a large sheet, whose rows the aggregate sorts."""
    # skip leave on the raw cell (cheap); a filter on the cased name would be
    # pushed below the distinct and case every row
    x = raw.where(text.slug("task") != "leave")
    x = text.map_distinct(x, "task", lambda c: text.slug_to_proper(text.slug(c)), "_task", salts=parts or 1)
    x = x.drop("task").withColumnRenamed("_task", "task")
    x = x.repartition(parts, "employee", "work_date", "task") if parts else x
    return win.keep_last(x.select("employee", "work_date", "task", "hours", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                         ["employee", "work_date", "task"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]) \
        .select("employee", "work_date", "task", "hours")


@register("etl_schedule", """
WITH r AS (SELECT o.o_custkey AS employee, CASE l.l_returnflag WHEN 'R' THEN 'Leave' WHEN 'A' THEN 'Harvest' ELSE 'Pack' END AS task,
                  CAST(l.l_shipdate AS DATE) AS work_date, l.l_quantity AS hours, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT employee, work_date, task, arg_max(hours, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS hours
FROM r WHERE task <> 'Leave' GROUP BY 1, 2, 3""")
def q_etl_schedule(spark, d):
    t = Tables(spark, d)
    return etl_schedule(raw_schedule(t), parts_for(t.lineitem))


@register("etl_tasks_seed", """
SELECT DISTINCT CASE l_returnflag WHEN 'R' THEN 'Leave' WHEN 'A' THEN 'Harvest' ELSE 'Pack' END AS name FROM lineitem""")
def q_etl_tasks_seed(spark, d):
    raw = raw_schedule(Tables(spark, d))
    return rs_distinct_proper(raw, "task")


def rs_distinct_proper(df: DataFrame, c: str, out: str = "name") -> DataFrame:
    """Distinct non-blank values of ``c`` in display-name casing. The casing
    runs on the distinct raw values only; the cased names are then
    de-duplicated with a window over that small mapping (a second
    aggregate would let the optimizer drop the first one and case every
    row)."""
    from pyspark.sql import Window

    m = df.select(c).where(text.slug(c) != "").distinct().withColumn(out, text.slug_to_proper(text.slug(c)))
    w = Window.partitionBy(out).orderBy(c)
    return m.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(out)


# ---------------------------------------------------------------- etl_sales_orders


def sales_lines(t: Tables) -> DataFrame:
    li, o = t.lineitem, t.orders
    return li.join(o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderdate").cast("date").alias("po_date"), F.col("o_custkey").alias("customer"), F.col("l_orderkey").alias("po_number"),
        F.col("l_partkey").alias("product"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("o_orderpriority").alias("recorded_by"),
        F.col("l_linenumber").alias("row_no"), "l_suppkey")


@register("etl_sales_order_headers", """
SELECT o.o_orderdate::DATE AS po_date, o.o_custkey AS customer, l.l_orderkey AS po_number,
       arg_min(o.o_orderpriority, (l.l_linenumber, l.l_suppkey, l.l_partkey)) AS recorded_by, COUNT(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3""")
def q_etl_sales_order_headers(spark, d):
    s = sales_lines(Tables(spark, d))
    h = agg.group_header_first(s, ["po_date", "customer", "po_number"], ["row_no", "l_suppkey", "product"], ["recorded_by"])
    n = s.groupBy("po_date", "customer", "po_number").agg(F.count(F.lit(1)).alias("n_lines"))
    return h.join(n, ["po_date", "customer", "po_number"])


@register("etl_sales_order_lines", """
SELECT l.l_orderkey AS po_number, l.l_partkey AS product, SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS quantity,
       arg_min(CAST(l.l_extendedprice AS DECIMAL(18,2)), (l.l_linenumber, l.l_suppkey)) AS price
FROM lineitem l GROUP BY 1, 2 HAVING SUM(CAST(l.l_quantity AS DECIMAL(18,2))) > 0""")
def q_etl_sales_order_lines(spark, d):
    s = sales_lines(Tables(spark, d))
    merged = agg.merge_lines_sum(s, ["po_number", "product"], ["quantity"], ["price"], ["row_no", "l_suppkey"])
    return rows.keep_nonzero(merged, "quantity")


@register("etl_recurring_orders", """
WITH g AS (SELECT o_custkey, l_partkey, COUNT(*) AS n, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) > DATE '1995-06-30' GROUP BY 1, 2)
SELECT o_custkey AS customer, l_partkey AS product, n AS n_orders, f AS first_date, l AS last_date,
       ROUND(datediff('day', f, l) / (n - 1), 4) AS mean_gap_days,
       CASE WHEN datediff('day', f, l) / (n - 1) BETWEEN 5 AND 9 THEN 'Weekly' WHEN datediff('day', f, l) / (n - 1) BETWEEN 12 AND 16 THEN 'Biweekly'
            WHEN datediff('day', f, l) / (n - 1) BETWEEN 25 AND 35 THEN 'Monthly' END AS cadence
FROM g WHERE n >= 3""")
def q_etl_recurring_orders(spark, d):
    s = sales_lines(Tables(spark, d))
    return agg.interval_regularity(s, ["customer", "product"], "po_date", after="1995-06-30")


# ---------------------------------------------------------------- etl_weather


@register("etl_weather", """
WITH w AS (SELECT user_id AS org_id, date_trunc('second', ts) AS reading_at,
                  max(CASE WHEN event_type = 'view' THEN ROUND((value / 10 / 100) * 9 / 5 + 32, 2) END) AS temperature_f,
                  max(CASE WHEN event_type = 'click' THEN ROUND(value / 100, 2) END) AS humidity
           FROM events GROUP BY 1, 2),
existing AS (SELECT * FROM w WHERE reading_at < TIMESTAMP '2024-01-15 00:00:00')
SELECT * FROM existing UNION ALL SELECT * FROM w WHERE (org_id, reading_at) NOT IN (SELECT (org_id, reading_at) FROM existing)""")
def q_etl_weather(spark, d):
    ev = Tables(spark, d).events
    kind = F.when(F.col("event_type") == "view", "TEMPERATURE").when(F.col("event_type") == "click", "HUMIDITY")
    ex = F.when(F.col("event_type") == "view", 1).otherwise(0)
    x = ev.select(F.col("user_id").alias("org_id"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("reading_at"), "event_type",
                  arith.unit_convert(kind, F.col("value"), ex)["value"].alias("v"), "ts")
    full = agg.pivot_channels(x, ["org_id", "reading_at"], "event_type", "v", ["view", "click"], "ts") \
        .withColumnRenamed("view", "temperature_f").withColumnRenamed("click", "humidity")
    existing = full.where(F.col("reading_at") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return sinks.insert_ignore(existing, full, ["org_id", "reading_at"])


# ---------------------------------------------------------------- etl_employees


@register("etl_employees", """
WITH e AS (SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, c_nationkey AS manager_code FROM customer),
act AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) >= 2000)
SELECT e.id, e.first_name, m.id AS manager_id, e.id NOT IN (SELECT o_custkey FROM act) AS is_deleted
FROM e LEFT JOIN (SELECT c_custkey AS id FROM customer) m ON m.id = CAST(e.manager_code AS BIGINT)""")
def q_etl_employees(spark, d):
    t = Tables(spark, d)
    e = t.customer.select(F.col("c_custkey").alias("id"), F.substring_index("c_name", "#", 1).alias("first_name"),
                          F.col("c_nationkey").cast("bigint").alias("manager_code"))
    linked = jn.self_link(e, "id", "manager_code", "id", "manager_id")
    extract = t.orders.where(F.year("o_orderdate") >= 2000).select(F.col("o_custkey").alias("id"))
    return sinks.soft_delete_missing(linked, extract, ["id"]).select("id", "first_name", "manager_id", "is_deleted")


# ---------------------------------------------------------------- etl_org_dims


@register("etl_org_dims", """
SELECT n.n_nationkey AS site_id, n.n_name AS name, r.r_name AS farm_id, (n.n_nationkey + 1) * 43560.0 * 3 AS square_feet,
       ROUND((n.n_nationkey + 1) * 43560.0 * 3 / 43560, 4) AS acres
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_etl_org_dims(spark, d):
    t = Tables(spark, d)
    s = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("site_id"), F.col("n_name").alias("name"), F.col("r_name").alias("farm_id"),
        ((F.col("n_nationkey") + 1) * 43560.0 * 3).alias("square_feet"))
    return s.withColumn("acres", F.round(F.col("square_feet") / 43560, 4))


# ---------------------------------------------------------------- etl_pest_log


@register("etl_pest_log", """
WITH r AS (SELECT o_orderkey, o_orderpriority || '+' || o_orderstatus AS stations FROM orders),
x AS (SELECT DISTINCT o_orderkey, trim(s) AS station FROM r, LATERAL (SELECT unnest(regexp_split_to_array(stations, '[+;&,]')) AS s) WHERE trim(s) <> '')
SELECT o_orderkey, station, COALESCE(CASE WHEN station LIKE '%-%' THEN split_part(station, '-', 1) END, 'other') AS trap_id FROM x""")
def q_etl_pest_log(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.concat_ws("+", "o_orderpriority", "o_orderstatus").alias("stations"))
    x = rs.explode_list_cell(o, "stations", "station").select("o_orderkey", "station").distinct()
    trap = F.when(F.col("station").contains("-"), F.substring_index("station", "-", 1))
    return x.withColumn("trap_id", rows.catch_all_member(trap))


# ---------------------------------------------------------------- etl_training


@register("etl_training", """
WITH s AS (SELECT c_custkey AS session_id, c_mktsegment || ', https://docs.example/' || CAST(c_nationkey AS VARCHAR) || ', ' || c_name AS trainers FROM customer),
x AS (SELECT session_id, trim(t) AS trainer FROM s, LATERAL (SELECT unnest(string_split(trainers, ',')) AS t) WHERE trim(t) <> '')
SELECT session_id, trainer, starts_with(trainer, 'http') AS is_url FROM x""")
def q_etl_training(spark, d):
    c = Tables(spark, d).customer.select(F.col("c_custkey").alias("session_id"), F.concat(
        F.col("c_mktsegment"), F.lit(", https://docs.example/"), F.col("c_nationkey").cast("string"), F.lit(", "), F.col("c_name")).alias("trainers"))
    x = rs.explode_list_cell(c, "trainers", "trainer", sep=",", dedupe=False).select("session_id", "trainer")
    return x.withColumn("is_url", F.col("trainer").startswith("http"))


# ---------------------------------------------------------------- etl_finance


@register("etl_finance", """
SELECT o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS txn_date, o_orderpriority AS payee,
       CASE WHEN o_orderstatus = 'F' THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
FROM orders WHERE NULLIF(trim(o_orderpriority), '') IS NOT NULL AND o_orderdate IS NOT NULL""")
def q_etl_finance(spark, d):
    o = Tables(spark, d).orders
    x = o.select(F.col("o_orderkey").alias("txn_id"), F.col("o_orderdate").cast("date").alias("txn_date"),
                 text.clean_text("o_orderpriority").alias("payee"),
                 codes.signed_amount(F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderstatus") == "F").alias("amount"))
    kept, _ = rows.quarantine(x, [("missing_payee", F.col("payee").isNull(), None), ("missing_date", F.col("txn_date").isNull(), None)])
    return kept


# ---------------------------------------------------------------- etl_pack_hourly


@register("etl_pack_hourly", """
WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS hr, SUM(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2, 3),
cum AS (SELECT *, SUM(v) OVER (PARTITION BY user_id, day ORDER BY hr) AS cum FROM c)
SELECT user_id, day, hr, greatest(cum - COALESCE(lag(cum) OVER (PARTITION BY user_id, day ORDER BY hr), 0), 0) AS delta FROM cum""")
def q_etl_pack_hourly(spark, d):
    from pyspark.sql import Window

    ev = Tables(spark, d).events
    c = ev.groupBy("user_id", F.col("ts").cast("date").alias("day"), F.hour("ts").alias("hr")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
    cum = c.withColumn("cum", F.sum("v").over(Window.partitionBy("user_id", "day").orderBy("hr")))
    return win.cumulative_to_delta(cum, ["user_id", "day"], "hr", "cum").select("user_id", "day", "hr", "delta")


# ---------------------------------------------------------------- etl_monitoring


# Fixed binding values: metric bounds for the monitoring unpivot.
METRIC_BOUNDS = {"l_quantity": (5.0, 45.0), "l_discount": (None, 0.08), "l_tax": (0.01, None)}


@register("etl_monitoring", """
WITH u AS (SELECT l_orderkey, l_linenumber, 'l_quantity' AS metric, l_quantity AS value FROM lineitem
           UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
           UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem),
b AS (SELECT * FROM (VALUES ('l_quantity', 5.0, 45.0), ('l_discount', NULL, 0.08), ('l_tax', 0.01, NULL)) v(metric, lo, hi))
SELECT u.l_orderkey, u.l_linenumber, u.metric, u.value,
       COALESCE(u.value < b.lo, false) OR COALESCE(u.value > b.hi, false) AS out_of_range
FROM u JOIN b USING (metric) WHERE u.value IS NOT NULL""")
def q_etl_monitoring(spark, d):
    li = Tables(spark, d).lineitem
    cfg = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('{m}', {('CAST(NULL AS DOUBLE)' if lo is None else lo)}, {('CAST(NULL AS DOUBLE)' if hi is None else hi)})"
        for m, (lo, hi) in METRIC_BOUNDS.items()) + " AS t(metric, lo, hi)")
    long = rs.unpivot_measures(li, ["l_orderkey", "l_linenumber"], list(METRIC_BOUNDS), config=cfg, config_key="metric")
    return long.select("l_orderkey", "l_linenumber", "metric", "value",
                       flag_out_of_range("value", "lo", "hi").alias("out_of_range"))


# ---------------------------------------------------------------- etl_inventory


@register("etl_inventory", """
WITH cats AS (SELECT DISTINCT p_type AS name FROM part)
SELECT p.p_partkey AS item_id, proper AS category, ROUND(CAST(p.p_size AS DOUBLE) * (2 + 3) * 1.0, 2) AS reorder_point,
       CASE WHEN p.p_size <> 0 AND p.p_retailprice <> 0 THEN ROUND(p.p_size * p.p_retailprice * 1.0, 2) END AS bulk_weight
FROM part p JOIN (SELECT name, upper(substr(lower(name), 1, 1)) || substr(lower(name), 2) AS proper FROM cats) c ON c.name = p.p_type""")
def q_etl_inventory(spark, d):
    p = Tables(spark, d).part
    cats = rs_distinct_proper(p, "p_type", out="category")
    x = text.map_distinct(p, "p_type", lambda c: text.proper_case(F.lower(c)), "category")
    x = x.join(cats, "category", "left_semi")
    return x.select(F.col("p_partkey").alias("item_id"), "category",
                    arith.reorder_point(F.col("p_size").cast("double"), F.lit(2), F.lit(3)).alias("reorder_point"),
                    arith.bulk_weight(F.col("p_size"), F.col("p_retailprice"), F.lit(1.0)).alias("bulk_weight"))


# ---------------------------------------------------------------- etl_rules


# Business-rule catalogue rows (id, type, module, title).
RULES = [("rei-window", "restriction", "grow", "No entry until REI expires"),
         ("phi-window", "restriction", "grow", "No harvest until PHI expires"),
         ("pallet-max", "capacity", "sales", "Fill pallets to maximum cases"),
         ("payroll-share", "allocation", "hr", "Allocate payroll by scheduled hours")]


@register("etl_rules", """
SELECT r.rule_id, r.rule_type, r.module, r.title, COUNT(o.o_orderkey) AS applies_to_rows
FROM (VALUES ('rei-window', 'restriction', 'grow', 'No entry until REI expires'), ('phi-window', 'restriction', 'grow', 'No harvest until PHI expires'),
             ('pallet-max', 'capacity', 'sales', 'Fill pallets to maximum cases'), ('payroll-share', 'allocation', 'hr', 'Allocate payroll by scheduled hours'))
     r(rule_id, rule_type, module, title)
LEFT JOIN orders o ON (r.module = 'sales' AND o.o_orderstatus = 'F') OR (r.module = 'hr' AND o.o_orderstatus = 'O')
GROUP BY 1, 2, 3, 4""")
def q_etl_rules(spark, d):
    from furrow.sources.readers import static_dim

    rules_df = static_dim(spark, RULES, "rule_id string, rule_type string, module string, title string")
    o = Tables(spark, d).orders
    per_module = o.select(F.when(F.col("o_orderstatus") == "F", "sales").when(F.col("o_orderstatus") == "O", "hr").alias("module")) \
        .where(F.col("module").isNotNull()).groupBy("module").agg(F.count(F.lit(1)).alias("applies_to_rows"))
    return rules_df.join(per_module, "module", "left").select("rule_id", "rule_type", "module", "title",
                                                               F.coalesce("applies_to_rows", F.lit(0)).alias("applies_to_rows"))
