"""People (§2.13 ``etl_employees``): the register with its two passes, access
grants, time off and travel, over sheets rendered from customers (register and
app users) and orders (requests)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import codes, lists, parse, text
from furrow.operators import setops
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.sources.tables import Tables

# View names of the app and the modules they stand for; access levels; request states.
MODULES = {"grow": "Grow", "pack": "Pack", "food safety": "Food Safety", "maintenance": "Maintenance", "inventory": "Inventory",
           "human resources": "Human Resources", "sales": "Sales", "execute": "Operations", "global": "Operations"}
LEVELS = {"1": "Employee", "2": "Manager", "3": "Admin"}
REQUEST_STATES = {"approved": "Approved", "denied": "Denied", "not approved": "Denied", "pending": "Pending"}
TRAVEL_STATES = {"requested": "Pending", "ordered": "Approved"}
# Binding: first names of the register.
FIRST_NAMES = ("ana", "ben", "cleo", "dan", "eva", "finn", "gus")


def _first(k):
    return F.element_at(F.array(*[F.lit(n) for n in FIRST_NAMES]), (k % len(FIRST_NAMES) + 1).cast("int"))


def _last(k):
    return F.concat(F.lit("x"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))


def _email(k):
    return F.when(k % 9 == 0, "").otherwise(F.concat(F.lit(" E"), k, F.lit("@Farm")))


def raw_register(t: Tables) -> DataFrame:
    """The register sheet: a row per customer."""
    k, m = F.col("c_custkey"), F.col("c_nationkey")
    return t.customer.select(
        k.alias("sheet_row"), F.concat(F.initcap(_first(k)), F.lit("  "), _last(k)).alias("full_name"), _first(k).alias("first"),
        F.when(k % 97 == 5, " ").otherwise(F.upper(_last(k))).alias("last"),
        F.when(k % 6 == 0, "AB").when(k % 6 == 1, F.concat(F.lit("nick z"), F.translate((k % 50).cast("string"), "0123456789", "abcdefghij"))).otherwise("").alias("short"),
        _email(k).alias("email"), F.when(F.col("c_acctbal") >= 0, "TRUE").otherwise("no").alias("is_active"),
        F.when(k % 3 == 0, "male").when(k % 3 == 1, " FEMALE").otherwise("x").alias("gender"),
        F.when(k % 4 == 0, "hourly").when(k % 4 == 1, "SALARY").otherwise("").alias("pay"),
        F.when(k % 5 == 0, "a1").when(k % 5 == 1, "").otherwise((k % 100).cast("string")).alias("wc"),
        F.when(k % 2 == 0, "40").otherwise("").alias("overtime"), F.initcap(_first(m.cast("bigint"))).alias("team_lead"),
        F.when(m % 2 == 0, "AB").when(m % 3 == 0, "Nobody").otherwise("Nick Zbc").alias("manager"))


def raw_app_users(t: Tables) -> DataFrame:
    """The list of app users: two in three people, some of them twice."""
    k = F.col("c_custkey")
    views = F.when(k % 4 == 0, "Grow & Pack & grow & Food Safety").when(k % 4 == 1, "execute&GLOBAL & Unknown").when(k % 4 == 2, "").otherwise("Sales & human resources")
    one = t.customer.where("c_custkey % 3 <> 0").select(k.alias("sheet_row"), F.upper(_email(k)).alias("email"), (k % 4).cast("string").alias("level"), views.alias("views"),
                                                        F.when(k % 8 == 0, "yes").otherwise("").alias("is_verifier"))
    return one.unionByName(one.where("sheet_row % 10 = 1").withColumn("sheet_row", F.col("sheet_row") + 10**9).withColumn("level", F.lit("3")))


def app_users(raw: DataFrame) -> DataFrame:
    """One per address, the last row."""
    x = raw.withColumn("email", F.lower(F.trim("email"))).where("email <> ''")
    return win.keep_last(x, ["email"], ["sheet_row"]).drop("sheet_row")


def register_rows(raw: DataFrame, users: DataFrame) -> DataFrame:
    """First pass: a row per person with both names, access level by address."""
    short = F.trim("short")
    x = raw.select(
        "sheet_row", text.slug(F.regexp_replace("full_name", r"\s+", " ")).alias("id"), text.proper_case("first").alias("first_name"), text.proper_case("last").alias("last_name"),
        F.nullif(F.when(short.rlike("^[A-Z]+$"), short).otherwise(text.proper_case(short)), F.lit("")).alias("preferred_name"),
        codes.whitelist_or_null(text.proper_case("gender"), ("Male", "Female")).alias("gender"),
        codes.whitelist_or_null(text.proper_case("pay"), ("Hourly", "Salary")).alias("pay_structure"),
        codes.zero_pad(text.clean_text("wc"), 4).alias("wc"), parse.parse_number("overtime").alias("overtime_threshold"),
        F.nullif(F.lower(F.trim("email")), F.lit("")).alias("company_email"), (~parse.parse_bool("is_active")).alias("is_deleted"),
        F.trim("team_lead").alias("team_lead"), F.trim("manager").alias("manager")).where("first_name <> '' AND last_name <> ''")
    level = users.select(F.col("email").alias("company_email"), F.coalesce(codes.map_values("level", LEVELS), F.lit("Employee")).alias("_level"))
    return x.join(level, "company_email", "left").withColumn("access_level", F.coalesce("_level", F.lit("Employee"))).drop("_level")


def linked_register(people: DataFrame) -> DataFrame:
    """Second pass: lead and manager by the name they are called. Only active people can be meant; of several with a name
    the last one in the sheet."""
    called = people.where(~F.col("is_deleted")).select(
        "sheet_row", "id", F.explode(F.filter(F.array("preferred_name", "first_name"), lambda n: n.isNotNull())).alias("name"))
    named = win.keep_last(called.select("name", "sheet_row", "id"), ["name"], ["sheet_row"])
    for name, out in (("team_lead", "team_lead_id"), ("manager", "compensation_manager_id")):
        people = people.join(named.select(F.col("name").alias(name), F.col("id").alias(out)), name, "left")
    return people


def module_access(people: DataFrame, users: DataFrame) -> DataFrame:
    """A grant per person and module that the views of the person's app user name."""
    x = people.select("id", F.col("company_email").alias("email"), "is_deleted").join(users, "email")
    module = codes.map_values(F.lower("view"), MODULES)
    x = x.withColumn("view", F.explode(lists.split_list("views", "&"))).withColumn("module_id", module).where(F.col("module_id").isNotNull())
    return x.groupBy(F.col("id").alias("employee_id"), "module_id").agg(
        F.first(parse.parse_bool("is_verifier")).alias("can_verify"), F.first("is_deleted").alias("is_deleted"))


_FIRST_SQL = "[" + ", ".join(f"'{n.title()}'" for n in FIRST_NAMES) + "]"


def _sql_first(k):
    return f"{_FIRST_SQL}[{k} % {len(FIRST_NAMES)} + 1]"


def _sql_id(k):
    return f"lower({_sql_first(k)}) || '_x' || translate(({k})::VARCHAR, '0123456789', 'abcdefghij')"


_PEOPLE_SQL = f"""
k AS (SELECT c_custkey AS k, c_nationkey AS m, c_acctbal < 0 AS is_deleted FROM customer),
users AS (SELECT 'e' || k || '@farm' AS email, CASE WHEN k % 10 = 1 THEN 3 ELSE k % 4 END AS level, k % 8 = 0 AS can_verify,
    CASE k % 4 WHEN 0 THEN ['Grow', 'Pack', 'Food Safety'] WHEN 1 THEN ['Operations'] WHEN 2 THEN [] ELSE ['Sales', 'Human Resources'] END AS modules
  FROM k WHERE k % 3 <> 0 AND k % 9 <> 0),
people AS (SELECT k, m, is_deleted, {_sql_id("k")} AS id, {_sql_first("k")} AS first_name, 'X' || translate(k::VARCHAR, '0123456789', 'abcdefghij') AS last_name,
    CASE WHEN k % 6 = 0 THEN 'AB' WHEN k % 6 = 1 THEN 'Nick Z' || translate((k % 50)::VARCHAR, '0123456789', 'abcdefghij') END AS preferred_name,
    CASE WHEN k % 9 <> 0 THEN 'e' || k || '@farm' END AS company_email, {_sql_first("m")} AS team_lead,
    CASE WHEN m % 2 = 0 THEN 'AB' WHEN m % 3 = 0 THEN 'Nobody' ELSE 'Nick Zbc' END AS manager
  FROM k WHERE k % 97 <> 5),
names AS (SELECT name, arg_max(id, k) AS id FROM (SELECT k, id, unnest([preferred_name, first_name]) AS name FROM people WHERE NOT is_deleted) WHERE name IS NOT NULL GROUP BY 1),
grants AS (SELECT p.id AS employee_id, unnest(u.modules) AS module_id, u.can_verify, p.is_deleted FROM people p JOIN users u ON u.email = p.company_email)"""


@register("etl_employee_register", "WITH " + _PEOPLE_SQL + """
SELECT p.id, first_name, last_name, preferred_name, CASE k % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS gender,
  CASE k % 4 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Salary' END AS pay_structure, CASE k % 5 WHEN 0 THEN 'a1' WHEN 1 THEN NULL ELSE lpad((k % 100)::VARCHAR, 4, '0') END AS wc,
  CASE WHEN k % 2 = 0 THEN 40.0::DOUBLE END AS overtime_threshold, company_email, is_deleted,
  CASE u.level WHEN 2 THEN 'Manager' WHEN 3 THEN 'Admin' ELSE 'Employee' END AS access_level, tl.id AS team_lead_id, cm.id AS compensation_manager_id
FROM people p LEFT JOIN users u ON u.email = p.company_email LEFT JOIN names tl ON tl.name = team_lead LEFT JOIN names cm ON cm.name = manager""")
def q_etl_employee_register(spark, d):
    t = Tables(spark, d)
    people = linked_register(register_rows(raw_register(t), app_users(raw_app_users(t))))
    return people.select("id", "first_name", "last_name", "preferred_name", "gender", "pay_structure", "wc", "overtime_threshold", "company_email",
                         "is_deleted", "access_level", "team_lead_id", "compensation_manager_id")


def _people(t: Tables):
    users = app_users(raw_app_users(t))
    return register_rows(raw_register(t), users), users


@register("etl_module_access", "WITH " + _PEOPLE_SQL + " SELECT * FROM grants")
def q_etl_module_access(spark, d):
    return module_access(*_people(Tables(spark, d)))


GRANT = ["employee_id", "module_id"]


@register("etl_module_access_changes", "WITH " + _PEOPLE_SQL + """,
old AS (SELECT employee_id, CASE WHEN module_id = 'Sales' THEN 'Maintenance' ELSE module_id END AS module_id, can_verify AND module_id <> 'Grow' AS can_verify, is_deleted FROM grants)
SELECT coalesce(o.employee_id, g.employee_id) AS employee_id, coalesce(o.module_id, g.module_id) AS module_id, g.can_verify, g.is_deleted,
  CASE WHEN o.employee_id IS NULL THEN 'insert' WHEN g.employee_id IS NULL THEN 'delete' ELSE 'update' END AS op
FROM old o FULL JOIN grants g ON g.employee_id = o.employee_id AND g.module_id = o.module_id
WHERE o.employee_id IS NULL OR g.employee_id IS NULL OR o.can_verify <> g.can_verify OR o.is_deleted <> g.is_deleted""")
def q_etl_module_access_changes(spark, d):
    """What a reload of the grants changes in those of an earlier load, in which sales was called maintenance and nobody verified growing."""
    grants = module_access(*_people(Tables(spark, d)))
    old = grants.withColumn("can_verify", F.col("can_verify") & (F.col("module_id") != "Grow")) \
        .withColumn("module_id", F.when(F.col("module_id") == "Sales", "Maintenance").otherwise(F.col("module_id")))
    return setops.set_changes(old, grants, GRANT, ["can_verify", "is_deleted"])


def raw_requests(t: Tables, priority: str) -> DataFrame:
    """Sheet of requests: a row per order of a priority, for the person of its customer; some people are unknown."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(c % 13 == 0, "Nobody Here").otherwise(F.concat(F.upper(_first(c)), F.lit(" "), _last(c)))
    day = lambda n: F.date_add(F.col("o_orderdate").cast("date"), n)
    number = lambda n: F.when(k % n == 0, "").otherwise((k % n / 2).cast("string"))
    return t.orders.where(F.col("o_orderpriority") == priority).select(
        k.alias("sheet_row"), name.alias("full_name"), F.col("o_orderstatus").alias("state"), F.date_format(day(0), "M/d/yyyy").alias("start"),
        F.when(k % 5 == 0, "").otherwise(F.date_format(day(3), "yyyy-M-d")).alias("back"), number(4).alias("pto"), number(3).alias("non_pto"), number(7).alias("sick"),
        F.when(k % 6 == 0, " ").otherwise("family").alias("reason"), F.date_format("o_orderdate", "M/d/yyyy H:mm:ss").alias("requested_at"),
        F.date_format(day(1), "M/d/yyyy").alias("updated_at"), _email(c).alias("requested_by"), _email(k % 100).alias("updated_by"))


def with_people(requests: DataFrame, people: DataFrame) -> DataFrame:
    """Requests of known people, with the ids of who asked (else the person) and who answered, by address."""
    x = requests.withColumn("employee_id", text.slug(F.regexp_replace("full_name", r"\s+", " ")))
    x = x.join(people.select(F.col("id").alias("employee_id"), "is_deleted"), "employee_id")
    by = people.where(F.col("company_email").isNotNull()).select("company_email", "sheet_row", "id")
    by = win.keep_last(by, ["company_email"], ["sheet_row"])
    for c, out in (("requested_by", "asked"), ("updated_by", "answered")):
        x = x.withColumn("_mail", F.lower(F.trim(c))).join(by.select(F.col("company_email").alias("_mail"), F.col("id").alias(out)), "_mail", "left").drop("_mail")
    return x.withColumn("asked", F.coalesce("asked", "employee_id"))


_REQUEST_SQL = "WITH " + _PEOPLE_SQL + f""",
q AS (SELECT o.*, o_orderkey AS sheet_row, p.id AS employee_id, p.is_deleted, coalesce(a.id, p.id) AS asked, b.id AS answered, o_orderdate::DATE AS d
  FROM orders o JOIN people p ON p.k = o_custkey AND o_custkey % 13 <> 0 LEFT JOIN people a ON a.company_email = 'e' || o_custkey || '@farm'
  LEFT JOIN people b ON b.company_email = 'e' || (o_orderkey % 100) || '@farm')"""


@register("etl_time_off", _REQUEST_SQL + """
SELECT sheet_row, employee_id, d AS start_date, CASE WHEN sheet_row % 5 <> 0 THEN d + 3 END AS return_date, CASE WHEN sheet_row % 4 <> 0 THEN sheet_row % 4 / 2 END AS pto_days,
  CASE WHEN sheet_row % 3 <> 0 THEN sheet_row % 3 / 2 END AS non_pto_days, CASE WHEN sheet_row % 7 <> 0 THEN sheet_row % 7 / 2 END AS sick_leave_days,
  CASE WHEN sheet_row % 6 <> 0 THEN 'family' END AS request_reason, CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Denied' ELSE 'Pending' END AS status,
  o_orderdate AS requested_at, asked AS requested_by, CASE WHEN o_orderstatus <> 'P' THEN (d + 1)::TIMESTAMP END AS reviewed_at,
  CASE WHEN o_orderstatus <> 'P' THEN answered END AS reviewed_by, is_deleted
FROM q WHERE o_orderpriority = '1-URGENT'""")
def q_etl_time_off(spark, d):
    t = Tables(spark, d)
    raw = raw_requests(t, "1-URGENT").withColumn("state", F.when(F.col("state") == "F", " Approved").when(F.col("state") == "O", "not approved").otherwise("asked"))
    x = with_people(raw, _people(t)[0])
    x = x.withColumn("status", F.coalesce(codes.map_values(F.lower(F.trim("state")), REQUEST_STATES), F.lit("Pending")))
    settled = F.col("status") != "Pending"
    return x.select(
        "sheet_row", "employee_id", parse.parse_date_multi("start").alias("start_date"), parse.parse_date_multi("back").alias("return_date"),
        *[parse.parse_number(c).alias(f"{out}_days") for c, out in (("pto", "pto"), ("non_pto", "non_pto"), ("sick", "sick_leave"))],
        text.clean_text("reason").alias("request_reason"), "status", parse.parse_ts_multi("requested_at").cast("timestamp_ntz").alias("requested_at"),
        F.col("asked").alias("requested_by"), F.when(settled, parse.parse_ts_multi("updated_at").cast("timestamp_ntz")).alias("reviewed_at"),
        F.when(settled, F.col("answered")).alias("reviewed_by"), "is_deleted")


@register("etl_travel", _REQUEST_SQL + """
SELECT sheet_row, employee_id, CASE WHEN sheet_row % 4 = 0 THEN 'Round Trip' ELSE 'One Way' END AS request_type, 'Hilo Town' AS travel_from, d AS travel_start_date,
  CASE WHEN sheet_row % 5 <> 0 THEN d + 3 END AS travel_return_date, CASE o_orderstatus WHEN 'O' THEN 'Approved' ELSE 'Pending' END AS status,
  o_orderdate AS requested_at, asked AS requested_by
FROM q WHERE o_orderpriority = '2-HIGH' AND sheet_row % 3 <> 0""")
def q_etl_travel(spark, d):
    """Purchase requests of the kind travel."""
    t = Tables(spark, d)
    k = F.col("sheet_row")
    raw = raw_requests(t, "2-HIGH").withColumn("kind", F.when(k % 3 == 0, "Goods").otherwise(" Travel")) \
        .withColumn("trip", F.when(k % 4 == 0, "round TRIP").otherwise("one way")).withColumn("from", F.lit("hilo town")) \
        .withColumn("state", F.when(F.col("state") == "F", "Requested").when(F.col("state") == "O", "ordered").otherwise(""))
    x = with_people(raw.where(F.trim("kind") == "Travel"), _people(t)[0])
    return x.select("sheet_row", "employee_id", text.proper_case("trip").alias("request_type"), text.proper_case("from").alias("travel_from"),
                    parse.parse_date_multi("start").alias("travel_start_date"), parse.parse_date_multi("back").alias("travel_return_date"),
                    F.coalesce(codes.map_values(F.lower(F.trim("state")), TRAVEL_STATES), F.lit("Pending")).alias("status"),
                    parse.parse_ts_multi("requested_at").cast("timestamp_ntz").alias("requested_at"), F.col("asked").alias("requested_by"))
