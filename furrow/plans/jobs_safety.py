"""Pest traps and trainings (§2.13 ``etl_pest_log`` and ``etl_training``, the
tables beyond their main one): the trap and building of each station of a log
row, training sessions with their trainer, and who attended. The sheets are
rendered from orders, line items and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import codes, lists, parse, text
from furrow.operators import rows
from furrow.operators import windows as win
from furrow.plans import jobs_people
from furrow.plans.registry import register
from furrow.sources import sinks
from furrow.sources.tables import Tables

# Farms of the log, where a trap without a building belongs, pests that are told apart, photo folders.
FARMS = {"cuke": "Cuke", "lettuce": "Lettuce"}
FARM_SITE = {"Cuke": "bip", "Lettuce": "gh"}
PESTS = {"mouse": "Mouse", "rat": "Rat"}
PHOTO_PATHS = [("fsafe_log_pest_Images/", "images/fsafe_pest_result/")]
SITES = ("gh", "ph", "hi")


# ---------------------------------------------------------------- etl_pest_log


def traps(t: Tables) -> DataFrame:
    """Known traps: farm, house and number out of the supplier's key; one in five has no building."""
    k = F.col("s_suppkey")
    farm = F.when(k % 2 == 0, "cuke").otherwise("lettuce")
    site = F.element_at(F.array(*[F.lit(s) for s in SITES]), (k % 3 + 1).cast("int"))
    return t.supplier.select(F.concat(farm, F.lit("_"), site, F.lit("_trap_"), F.floor(k / 6)).alias("trap_id"),
                             F.when(k % 5 != 0, F.concat(F.lit("building "), "s_nationkey")).alias("parent_site"))


def raw_pest_log(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    site = F.element_at(F.array(*[F.lit(s) for s in SITES]), (k % 3 + 1).cast("int"))
    return t.orders.select(
        k.alias("sheet_row"), F.when(c % 12 == 0, "").when(k % 2 == 0, " Cuke").otherwise("LETTUCE").alias("farm"), F.upper(site).alias("site"),
        F.concat(c % 20, F.lit("+ "), (c + 1) % 4, F.when(k % 6 == 0, " + x").otherwise("")).alias("stations"),
        F.when(k % 17 == 0, "").otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm:ss")).alias("reported_time"), F.when(k % 3 == 0, "no").otherwise("YES").alias("activity"),
        F.when(k % 4 == 0, "Mouse ").when(k % 4 == 1, "rat").otherwise("bird").alias("pest_type"),
        F.when(k % 5 == 0, F.concat(F.lit("fsafe_log_pest_Images/"), k, F.lit(".jpg"))).otherwise("").alias("photo"))


def pest_results(raw: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a result per station with a known trap, what is left out with a reason): the tracker stands at the trap's building, else
    at the farm's site; a pest is named only if there was activity."""
    x = raw.withColumn("farm_id", codes.map_values(F.lower(F.trim("farm")), FARMS)).withColumn("start_time", parse.parse_ts_multi("reported_time").cast("timestamp_ntz"))
    kept, out = rows.quarantine(x, [("no_site", (F.trim("farm") == "") | F.col("farm_id").isNull(), None), ("no_date", F.col("start_time").isNull(), None)])
    each = kept.withColumn("station", F.explode(lists.split_list("stations", r"\+")))
    number = F.col("station").try_cast("int")
    each = each.withColumn("trap_id", F.concat(F.lower("farm_id"), F.lit("_"), F.lower(F.trim("site")), F.lit("_trap_"), number.cast("string")))
    found = each.join(known.withColumn("_known", F.lit(True)), "trap_id", "left")
    good, unknown = rows.quarantine(found, [("unknown_trap", F.col("_known").isNull(), F.col("station"))])
    active = parse.parse_bool("activity")
    good = good.withColumn("site_id", F.coalesce("parent_site", codes.map_values("farm_id", FARM_SITE))).withColumn("is_active", active) \
        .withColumn("pest_type", F.when(active, codes.map_values(F.lower(F.trim("pest_type")), PESTS))) \
        .withColumn("photo_url", codes.rewrite_path(F.nullif(F.trim("photo"), F.lit("")), PHOTO_PATHS))
    return sinks.surrogate_id(good, ["sheet_row", "station"], "tracker_id"), out.select("sheet_row", "reason").unionByName(unknown.select("sheet_row", "reason"))


_PEST_SQL = f"""
WITH t AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'cuke' ELSE 'lettuce' END || '_' || ['gh', 'ph', 'hi'][(s_suppkey % 3 + 1)::INTEGER] || '_trap_' || (s_suppkey // 6) AS trap_id,
    CASE WHEN s_suppkey % 5 <> 0 THEN 'building ' || s_nationkey END AS building FROM supplier),
s AS (SELECT *, o_orderkey AS k, CASE WHEN o_custkey % 12 = 0 THEN 'no_site' WHEN o_orderkey % 17 = 0 THEN 'no_date' END AS reason FROM orders),
e AS (SELECT *, unnest(list_concat([(o_custkey % 20)::VARCHAR, ((o_custkey + 1) % 4)::VARCHAR], CASE WHEN k % 6 = 0 THEN ['x'] ELSE [] END)) AS station FROM s WHERE reason IS NULL),
r AS (SELECT e.*, t.trap_id, t.building FROM e LEFT JOIN t
  ON t.trap_id = CASE WHEN k % 2 = 0 THEN 'cuke' ELSE 'lettuce' END || '_' || ['gh', 'ph', 'hi'][(k % 3 + 1)::INTEGER] || '_trap_' || station)"""


@register("etl_pest_results", _PEST_SQL + """
SELECT substr(sha256(length(k::VARCHAR) || ':' || k || '|' || length(station) || ':' || station), 1, 32) AS tracker_id, k AS sheet_row, trap_id,
  coalesce(building, CASE WHEN k % 2 = 0 THEN 'bip' ELSE 'gh' END) AS site_id, o_orderdate AS start_time, k % 3 <> 0 AS is_active,
  CASE WHEN k % 3 <> 0 THEN CASE k % 4 WHEN 0 THEN 'Mouse' WHEN 1 THEN 'Rat' END END AS pest_type,
  CASE WHEN k % 5 = 0 THEN 'images/fsafe_pest_result/' || k || '.jpg' END AS photo_url FROM r WHERE trap_id IS NOT NULL""")
def q_etl_pest_results(spark, d):
    t = Tables(spark, d)
    return pest_results(raw_pest_log(t), traps(t))[0].select("tracker_id", "sheet_row", "trap_id", "site_id", "start_time", "is_active", "pest_type", "photo_url")


@register("etl_pest_skips", _PEST_SQL + """
SELECT reason, count(*) AS n FROM (SELECT reason FROM s WHERE reason IS NOT NULL UNION ALL SELECT 'unknown_trap' FROM r WHERE trap_id IS NULL) GROUP BY 1""")
def q_etl_pest_skips(spark, d):
    t = Tables(spark, d)
    return pest_results(raw_pest_log(t), traps(t))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- etl_training


def raw_trainings(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    who = F.concat(F.when(k % 3 == 0, "Nobody + ").otherwise(""), F.initcap(jobs_people._first(k)), F.when(k % 2 == 0, F.concat(F.lit("+ https://docs.example/"), k)).otherwise(""))
    return t.orders.where("o_orderpriority = '3-MEDIUM'").select(
        k.alias("training_id"), F.when(k % 4 == 0, "food SAFETY").otherwise("forklift").alias("kind"), F.date_format("o_orderdate", "M/d/yyyy").alias("held"),
        F.when(k % 7 == 0, "").otherwise("hygiene + glass+ ").alias("topics"), F.when(k % 11 == 0, "").otherwise(who).alias("trained_by"))


def called(people: DataFrame) -> DataFrame:
    """(name, employee_id): people by full name in capitals, first and preferred name in small letters; of several the last one
    in the sheet."""
    names = F.array(F.upper(F.concat_ws(" ", "last_name", "first_name")), F.lower("first_name"), F.lower("preferred_name"))
    each = people.select("sheet_row", "id", F.explode(F.filter(names, lambda n: n.isNotNull())).alias("name"))
    return win.keep_last(each.select("name", "sheet_row", "id"), ["name"], ["sheet_row"]).select("name", F.col("id").alias("employee_id"))


def trainings(raw: DataFrame, people: DataFrame) -> DataFrame:
    """Sessions: the trainer is the first name of the cell that is known, links in it are materials; several names and the
    links go to the notes."""
    x = raw.withColumn("parts", lists.split_list("trained_by", r"\+"))
    is_url = lambda p: p.startswith("http")
    x = x.withColumn("names", F.filter("parts", lambda p: ~is_url(p))).withColumn("urls", F.filter("parts", is_url))
    each = x.select("training_id", F.posexplode("names").alias("pos", "part")).withColumn("name", F.lower("part")).join(called(people), "name")
    first = win.keep_first(each.select("training_id", "pos", "employee_id"), ["training_id"], ["pos"]).select("training_id", F.col("employee_id").alias("trainer_id"))
    notes = F.concat_ws("; ", F.when(F.size("names") > 1, F.concat(F.lit("Trainers: "), F.array_join("names", ", "))),
                        F.when(F.size("urls") > 0, F.concat(F.lit("Materials: "), F.array_join("urls", ", "))))
    return x.join(first, "training_id", "left").select(
        "training_id", text.proper_case("kind").alias("training_type"), parse.parse_date_multi("held").alias("training_date"),
        F.array_join(lists.split_list("topics", r"\+"), ",").alias("topics_covered"), "trainer_id", F.get("urls", F.size("urls") - 1).alias("materials_url"), F.nullif(notes, F.lit("")).alias("notes"))


def raw_attendees(t: Tables) -> DataFrame:
    c = F.col("l_partkey") % 150
    return t.lineitem.select(
        F.col("l_orderkey").alias("training_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.concat(jobs_people._last(c), F.lit(" "), F.initcap(jobs_people._first(c))).alias("full_name"),
        F.when(F.col("l_linenumber") % 3 == 0, "false").otherwise("true ").alias("attended"), F.date_format("l_shipdate", "M/d/yyyy H:mm:ss").alias("signed"))


def attendees(raw: DataFrame, sessions: DataFrame, people: DataFrame) -> DataFrame:
    """Who attended a known session: the first row of a person and session counts, and only if it says so."""
    x = raw.join(sessions.select("training_id"), "training_id", "left_semi").withColumn("name", F.upper(F.trim("full_name"))).join(called(people), "name")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    first = win.keep_first(x.select("training_id", "employee_id", *order, "attended", "signed"), ["training_id", "employee_id"], order)
    return first.where(F.upper(F.trim("attended")) == "TRUE").select("training_id", "employee_id", parse.parse_ts_multi("signed").cast("timestamp_ntz").alias("signed_at"))


_TRAINING_SQL = "WITH " + jobs_people._PEOPLE_SQL + f""",
byname AS (SELECT name, arg_max(id, k) AS id FROM (SELECT k, id, unnest([upper(last_name || ' ' || first_name), lower(first_name), lower(preferred_name)]) AS name FROM people)
  WHERE name IS NOT NULL GROUP BY 1),
tr AS (SELECT o_orderkey AS t, o_orderdate::DATE AS d, {jobs_people._sql_first("o_orderkey")} AS who FROM orders WHERE o_orderpriority = '3-MEDIUM')"""


@register("etl_training_sessions", _TRAINING_SQL + """
SELECT t AS training_id, CASE WHEN t % 4 = 0 THEN 'Food Safety' ELSE 'Forklift' END AS training_type, d AS training_date, CASE WHEN t % 7 = 0 THEN '' ELSE 'hygiene,glass' END AS topics_covered,
  CASE WHEN t % 11 <> 0 THEN byname.id END AS trainer_id, CASE WHEN t % 11 <> 0 AND t % 2 = 0 THEN 'https://docs.example/' || t END AS materials_url,
  CASE WHEN t % 11 <> 0 THEN nullif(concat_ws('; ', CASE WHEN t % 3 = 0 THEN 'Trainers: Nobody, ' || who END, CASE WHEN t % 2 = 0 THEN 'Materials: https://docs.example/' || t END), '') END AS notes
FROM tr LEFT JOIN byname ON name = lower(who)""")
def q_etl_training_sessions(spark, d):
    t = Tables(spark, d)
    return trainings(raw_trainings(t), jobs_people._people(t)[0])


@register("etl_training_attendees", _TRAINING_SQL + """,
a AS (SELECT l_orderkey AS training_id, p.id AS employee_id, l_shipdate, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, p.id
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM lineitem JOIN tr ON t = l_orderkey JOIN people p ON p.k = l_partkey % 150)
SELECT training_id, employee_id, l_shipdate AS signed_at FROM a WHERE rn = 1 AND l_linenumber % 3 <> 0""")
def q_etl_training_attendees(spark, d):
    t = Tables(spark, d)
    return attendees(raw_attendees(t), raw_trainings(t), jobs_people._people(t)[0])
