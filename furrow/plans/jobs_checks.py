"""Checklists (§2.13 ``etl_checklists``, all templates and tables): a tracker per
sheet row and site, a result per question, employees made up for unknown
verifiers. The sheets are rendered from orders, alternating between two
templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import codes, lists, parse, text
from furrow.operators import rows
from furrow.plans.registry import register
from furrow.sources import sinks
from furrow.sources.tables import Tables

SYSTEM, CATCH_ALL = "system@farm", "all sites"
# Fixed binding values: the templates and their questions.
TEMPLATES = {"House Pre-Op": ("Floors clean?", "Drains clear?", "Bins empty?", "Doors closed?"),
             "Pack Post-Op": ("Belts clean?", "Knives counted?", "Lights whole?")}
ANSWERS = ("Yes", " no", "TRUE", "", "n/a")
_MOST = max(map(len, TEMPLATES.values()))


def raw_checklists(t: Tables) -> DataFrame:
    """One sheet for both templates: the k-th answer column belongs to the template's k-th question."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    template = F.when(k % 2 == 0, list(TEMPLATES)[0]).otherwise(list(TEMPLATES)[1])
    answer = lambda i: F.element_at(F.array(*[F.lit(a) for a in ANSWERS]), ((k + 3 * i) % len(ANSWERS) + 1).cast("int"))
    return t.orders.select(
        k.alias("sheet_row"), template.alias("template"), F.when(k % 10 == 0, "").otherwise(F.concat(c % 30, F.lit(" & "), c % 7 * 5)).alias("sites"),
        F.when(k % 19 == 0, "").otherwise(F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(7)), "M/d/yyyy H:mm:ss")).alias("reported_time"),
        F.when(k % 23 == 0, "").otherwise(F.date_format("o_orderdate", "M/d/yy")).alias("checked_date"),
        F.when(k % 4 == 0, "Ann").otherwise(F.concat(F.lit(" U"), c, F.lit("@Farm"))).alias("reported_by"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("E"), c, F.lit("@farm "))).otherwise(F.concat(F.lit("ext"), F.translate((c % 9).cast("string"), "0123456789", "abcdefghij"), F.lit(".smith-b@lab"))).alias("verified_by"),
        F.when(k % 3 == 0, "").otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("verified_time"), *[answer(i).alias(f"answer_{i}") for i in range(_MOST)])


def employees(t: Tables) -> DataFrame:
    """Known people by address: three in four customers."""
    k = F.col("c_custkey")
    return t.customer.where(k % 4 != 0).select(F.concat(F.lit("e"), k, F.lit("@farm")).alias("email"), F.concat(F.lit("employee_"), k).alias("employee_id"))


def stub_employees(raw: DataFrame, known: DataFrame) -> DataFrame:
    """A deleted employee for each verifier's address that nobody has; names out of the address."""
    mail = raw.select(F.lower(F.trim("verified_by")).alias("email")).where(F.col("email").contains("@")).distinct().join(known, "email", "left_anti")
    parts = F.split(F.substring_index("email", "@", 1), r"[._-]+")
    first = F.initcap(parts[0])
    last = F.initcap(F.coalesce(F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.lit("verifier")))
    return mail.select("email", text.slug(F.concat_ws(" ", last, first)).alias("employee_id"), first.alias("first_name"), last.alias("last_name"), F.lit(True).alias("is_deleted"))


def checklist_trackers(raw: DataFrame, sites: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trackers with the answers of their row, rows left out): one for each known site that a row names, for the catch-all
    site if it names none. Without any date a row is left out."""
    x = raw.withColumn("start_time", F.coalesce(parse.parse_ts_multi("reported_time"), parse.parse_ts_multi("checked_date")).cast("timestamp_ntz")) \
        .withColumn("verified_at", parse.parse_ts_multi("verified_time").cast("timestamp_ntz"))
    kept, out = rows.quarantine(x, [("no_date", F.col("start_time").isNull(), None)])
    people = known.select("email", "employee_id").unionByName(stub_employees(raw, known).select("email", "employee_id"))
    kept = kept.withColumn("email", F.lower(F.trim("verified_by"))).join(people, "email", "left").withColumnRenamed("employee_id", "verified_by_id")
    named = kept.select("sheet_row", F.explode(lists.split_list("sites", "[&,]", dedupe=True)).alias("code")) \
        .join(sites, F.col("code") == F.col("site_code")).select("sheet_row", F.col("site_code").alias("site_id"))
    per_site = kept.join(named, "sheet_row", "left").withColumn("site_id", rows.catch_all_member(F.col("site_id"), default=CATCH_ALL))
    per_site = per_site.withColumn("created_by", codes.user_or_default(F.lower("reported_by"), SYSTEM))
    return sinks.surrogate_id(per_site, ["sheet_row", "site_id"], "tracker_id"), out


def checklist_results(trackers: DataFrame) -> DataFrame:
    """An answer per tracker and question of its template; other answers than yes and no are open."""
    asked = F.when(F.lit(False), F.array().cast("array<struct<question:string,response_boolean:boolean>>"))
    for template, questions in TEMPLATES.items():
        pairs = [F.struct(F.lit(q).alias("question"), parse.parse_bool3(f"answer_{i}").alias("response_boolean")) for i, q in enumerate(questions)]
        asked = asked.when(F.col("template") == template, F.array(*pairs))
    return trackers.select("tracker_id", "site_id", "template", F.explode(asked).alias("q")).select("tracker_id", "site_id", "template", "q.*")


_SHEET_SQL = f"""
WITH s AS (SELECT *, o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN '{list(TEMPLATES)[0]}' ELSE '{list(TEMPLATES)[1]}' END AS template,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_orderdate + INTERVAL 7 HOUR WHEN o_orderkey % 23 <> 0 THEN o_orderdate END AS start_time,
    CASE o_orderkey % 3 WHEN 1 THEN 'e' || o_custkey || '@farm' WHEN 2 THEN 'ext' || translate((o_custkey % 9)::VARCHAR, '0123456789', 'abcdefghij') || '.smith-b@lab' END AS mail
  FROM orders),
known AS (SELECT 'e' || c_custkey || '@farm' AS mail, 'employee_' || c_custkey AS id FROM customer WHERE c_custkey % 4 <> 0),
stubs AS (SELECT DISTINCT mail, split_part(split_part(mail, '@', 1), '.', 1) AS a, CASE WHEN contains(mail, '.') THEN 'smith' ELSE 'verifier' END AS b
  FROM s WHERE mail IS NOT NULL AND mail NOT IN (SELECT mail FROM known)),
people AS (SELECT * FROM known UNION ALL SELECT mail, b || '_' || a FROM stubs),
dated AS (SELECT s.*, people.id AS verified_by, CASE WHEN k % 10 = 0 THEN [] ELSE list_filter(list_distinct([o_custkey % 30, o_custkey % 7 * 5]), lambda x: x < 25) END AS named
  FROM s LEFT JOIN people USING (mail) WHERE start_time IS NOT NULL),
tr AS (SELECT *, substr(sha256(length(k::VARCHAR) || ':' || k || '|' || length(site_id) || ':' || site_id), 1, 32) AS tracker_id FROM (
  SELECT *, unnest(CASE WHEN len(named) = 0 THEN ['{CATCH_ALL}'] ELSE named::VARCHAR[] END) AS site_id FROM dated))"""


def _trackers(t: Tables):
    return checklist_trackers(raw_checklists(t), t.nation.select(F.col("n_nationkey").cast("string").alias("site_code")), employees(t))


@register("etl_checklist_trackers", _SHEET_SQL + f"""
SELECT tracker_id, k AS sheet_row, template, site_id, start_time, CASE WHEN k % 3 <> 0 THEN o_orderdate END AS verified_at, verified_by,
  CASE WHEN k % 4 = 0 THEN '{SYSTEM}' ELSE 'u' || o_custkey || '@farm' END AS created_by FROM tr""")
def q_etl_checklist_trackers(spark, d):
    return _trackers(Tables(spark, d))[0].select("tracker_id", "sheet_row", "template", "site_id", "start_time", "verified_at",
                                                 F.col("verified_by_id").alias("verified_by"), "created_by")


@register("etl_checklist_results", _SHEET_SQL + """,
q AS (SELECT * FROM (VALUES """ + ", ".join(f"('{t}', '{q}', {i})" for t, qs in TEMPLATES.items() for i, q in enumerate(qs)) + f""") v(template, question, i))
SELECT tracker_id, site_id, template, question, [true, false, true, NULL, NULL][(k + 3 * i) % {len(ANSWERS)} + 1] AS response_boolean FROM tr JOIN q USING (template)""")
def q_etl_checklist_results(spark, d):
    return checklist_results(_trackers(Tables(spark, d))[0])


@register("etl_checklist_stubs", _SHEET_SQL + """
SELECT mail AS email, b || '_' || a AS employee_id, upper(left(a, 1)) || substr(a, 2) AS first_name, upper(left(b, 1)) || substr(b, 2) AS last_name, true AS is_deleted FROM stubs""")
def q_etl_checklist_stubs(spark, d):
    t = Tables(spark, d)
    return stub_employees(raw_checklists(t), employees(t))


@register("etl_checklist_skips", _SHEET_SQL + " SELECT 'no_date' AS reason, count(*) AS n FROM s WHERE start_time IS NULL HAVING count(*) > 0")
def q_etl_checklist_skips(spark, d):
    return _trackers(Tables(spark, d))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
