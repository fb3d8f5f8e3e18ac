"""Events out of log sheets (§2.13): the trackers, mixes and sites of
``etl_fertigation``, and the links of ``etl_corrective_actions`` to the rows of
four kinds of logs. The sheets are rendered from orders and events, with text
cells, blanks and unknown names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import codes, lists, parse
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import rows
from furrow.plans.registry import register
from furrow.sources import sinks
from furrow.sources.tables import Tables

SYSTEM = "system@farm"
# Recipes for the water that is added to a mix.
TOP_UP, FLUSH = "Top Up Water", "Flush Water"
TANKS = ("a", "b", "c", "d")


# ---------------------------------------------------------------- etl_fertigation


def raw_fertigation(t: Tables) -> DataFrame:
    """The schedule sheet: a row per order, cells as text."""
    k = F.col("o_orderkey")
    at = lambda hours: F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours), "M/d/yyyy H:mm:ss")
    start = (k % 24).cast("int")
    return t.orders.select(
        "o_orderkey", F.when(k % 4 == 0, F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" "))).otherwise(F.col("o_orderpriority")).alias("recipe"),
        F.when(F.col("o_orderstatus") == "O", "Lettuce").when((F.col("o_orderstatus") == "P") & (k % 2 == 0), " ").otherwise("cuke").alias("farm"),
        F.concat(F.col("o_custkey") % 30, F.when(k % 2 == 0, ", ").otherwise(" + "), (F.col("o_custkey") * 7) % 30).alias("sites"),
        F.when(k % 11 == 0, "").otherwise(at(start)).alias("scheduled"), F.when(k % 5 == 0, "").otherwise(at(start + 2)).alias("completed"),
        F.when(k % 7 == 0, "").otherwise(at(start - 24)).alias("mixed"),
        F.when(k % 3 == 0, "Someone").otherwise(F.concat(F.lit("U"), F.col("o_custkey"), F.lit("@farm"))).alias("scheduled_by"),
        F.when(k % 4 == 1, "").otherwise(F.concat(F.lit("v"), F.col("o_custkey"), F.lit("@farm"))).alias("completed_by"),
        ((k * 7 % 500) / 10).cast("string").alias("tank_a"), F.when(k % 3 == 0, "1,200").otherwise("").alias("tank_b"), F.lit("").alias("tank_c"),
        F.when(k % 9 == 0, "0").otherwise("x").alias("tank_d"), (k % 4).cast("string").alias("top_up_hours"), (k % 6 * 10).cast("string").alias("flush_gallons"))


def fertigation_schedule(raw: DataFrame, recipes: DataFrame, sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be loaded, rows left out with a reason): one per schedule row, with its known sites as a list. A row needs a
    known recipe, a farm, a known site and any of its three times."""
    farm = codes.map_values(F.lower(F.trim("farm")), {"cuke": "Cuke", "lettuce": "Lettuce"})
    listed = raw.select("o_orderkey", F.explode(lists.split_list("sites", r"[+,]", dedupe=True)).alias("site_id")) \
        .withColumn("site_id", F.col("site_id").try_cast("int")).join(sites, "site_id", "left_semi") \
        .groupBy("o_orderkey").agg(F.sort_array(F.collect_list("site_id")).alias("site_ids"))  # the cell of one row
    x = raw.withColumn("recipe", F.upper(F.trim("recipe"))).join(recipes.withColumn("_known", F.lit(True)), "recipe", "left").withColumn("farm", farm)
    x = x.join(listed, "o_orderkey", "left")
    for c in ("scheduled", "completed", "mixed"):
        x = x.withColumn(c, parse.parse_ts_multi(c).cast("timestamp_ntz"))
    x = x.withColumn("start_time", F.coalesce("scheduled", "mixed", "completed"))
    done, by = codes.user_or_default(F.lower("completed_by"), SYSTEM), codes.user_or_default(F.lower("scheduled_by"), SYSTEM)
    x = x.withColumn("is_completed", F.col("completed").isNotNull()) \
        .withColumn("reporter", F.when(F.col("is_completed") & (done != SYSTEM), done).otherwise(by))
    for c in (*[f"tank_{i}" for i in TANKS], "top_up_hours", "flush_gallons"):
        x = x.withColumn(c, parse.parse_number(c))
    return rows.quarantine(x, [("no_recipe", F.col("_known").isNull(), F.col("recipe")), ("no_farm", F.col("farm").isNull(), None),
                               ("no_site", F.col("site_ids").isNull(), None), ("no_datetime", F.col("start_time").isNull(), None)])


def _schedule(t: Tables):
    recipes = t.orders.select(F.upper("o_orderpriority").alias("recipe")).where("recipe <> '4-NOT SPECIFIED'").distinct()
    return fertigation_schedule(raw_fertigation(t), recipes, t.nation.select(F.col("n_nationkey").alias("site_id")))


def _per_site(kept: DataFrame) -> DataFrame:
    """A tracker for each site of a row; its id follows from both, so events need no look-up of their parent."""
    return sinks.surrogate_id(kept.withColumn("site_id", F.explode("site_ids")), ["o_orderkey", "site_id"], "tracker_id")


_FERTIGATION_SQL = f"""
WITH r AS (SELECT *, o_orderkey AS k, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS st FROM orders),
x AS (SELECT k, upper(o_orderpriority) AS recipe, CASE WHEN o_orderstatus = 'O' THEN 'Lettuce' WHEN o_orderstatus = 'P' AND k % 2 = 0 THEN NULL ELSE 'Cuke' END AS farm,
    list_distinct([s FOR s IN [(o_custkey % 30)::INTEGER, (o_custkey * 7 % 30)::INTEGER] IF s < 25]) AS site_ids,
    CASE WHEN k % 5 <> 0 THEN st + INTERVAL 2 HOUR END AS stop_time,
    coalesce(CASE WHEN k % 11 <> 0 THEN st END, CASE WHEN k % 7 <> 0 THEN st - INTERVAL 24 HOUR END, CASE WHEN k % 5 <> 0 THEN st + INTERVAL 2 HOUR END) AS start_time,
    CASE WHEN k % 5 <> 0 AND k % 4 <> 1 THEN 'v' || o_custkey || '@farm' WHEN k % 3 = 0 THEN '{SYSTEM}' ELSE 'u' || o_custkey || '@farm' END AS reporter FROM r),
y AS (SELECT *, CASE WHEN recipe = '4-NOT SPECIFIED' THEN 'no_recipe' WHEN farm IS NULL THEN 'no_farm' WHEN len(site_ids) = 0 THEN 'no_site'
    WHEN start_time IS NULL THEN 'no_datetime' END AS reason FROM x),
tr AS (SELECT *, substr(sha256(length(k::VARCHAR) || ':' || k || '|' || length(site_id::VARCHAR) || ':' || site_id), 1, 32) AS tracker_id
  FROM (SELECT *, unnest(site_ids) AS site_id FROM y WHERE reason IS NULL))"""


@register("etl_fertigation_trackers", _FERTIGATION_SQL + """
SELECT tracker_id, k AS o_orderkey, site_id, farm, start_time, stop_time, stop_time IS NOT NULL AS is_completed, reporter FROM tr""")
def q_etl_fertigation_trackers(spark, d):
    return _per_site(_schedule(Tables(spark, d))[0]).select(
        "tracker_id", "o_orderkey", "site_id", "farm", "start_time", F.col("completed").alias("stop_time"), "is_completed", "reporter")


@register("etl_fertigation_events", _FERTIGATION_SQL + f""",
ev AS (SELECT tracker_id, unnest([{{'no': 1, 'event': 'tank a', 'unit': 'Gallon', 'recipe': recipe, 'equipment_id': lower(farm) || '_tank_a', 'volume': (k * 7 % 500) / 10}},
    {{'no': 2, 'event': 'tank b', 'unit': 'Gallon', 'recipe': recipe, 'equipment_id': lower(farm) || '_tank_b', 'volume': CASE WHEN k % 3 = 0 THEN 1200.0 ELSE 0.0 END}},
    {{'no': 3, 'event': 'top up', 'unit': 'Hour', 'recipe': '{TOP_UP}', 'equipment_id': NULL, 'volume': (k % 4)::DOUBLE}},
    {{'no': 4, 'event': 'flush', 'unit': 'Gallon', 'recipe': '{FLUSH}', 'equipment_id': NULL, 'volume': (k % 6 * 10)::DOUBLE}}]) AS e FROM tr)
SELECT tracker_id, row_number() OVER (PARTITION BY tracker_id ORDER BY e.no)::INTEGER AS event_no, e.event AS event, e.unit AS unit, e.recipe AS recipe,
  e.equipment_id AS equipment_id, e.volume::DOUBLE AS volume FROM ev WHERE e.volume > 0""")
def q_etl_fertigation_events(spark, d):
    """One row per tank that a mix used, and for the water added and flushed, under its tracker."""
    kept = _per_site(_schedule(Tables(spark, d))[0])
    nothing = F.lit(None).cast("string")
    events = [(f"tank {i}", F.col(f"tank_{i}"), "Gallon", {"recipe": F.col("recipe"), "equipment_id": F.concat(F.lower("farm"), F.lit(f"_tank_{i}"))})
              for i in TANKS]
    events += [("top up", F.col("top_up_hours"), "Hour", {"recipe": F.lit(TOP_UP), "equipment_id": nothing}),
               ("flush", F.col("flush_gallons"), "Gallon", {"recipe": F.lit(FLUSH), "equipment_id": nothing})]
    return rs.typed_events(kept, ["tracker_id"], events, "volume")


@register("etl_fertigation_sites", _FERTIGATION_SQL + " SELECT DISTINCT farm, recipe, site_id FROM tr")
def q_etl_fertigation_sites(spark, d):
    return _per_site(_schedule(Tables(spark, d))[0]).select("farm", "recipe", "site_id").distinct()


@register("etl_fertigation_skips", _FERTIGATION_SQL + " SELECT reason, count(*) AS n FROM y WHERE reason IS NOT NULL GROUP BY 1")
def q_etl_fertigation_skips(spark, d):
    return _schedule(Tables(spark, d))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- etl_corrective_actions

# Fixed binding values: the log types, the event type that is their sheet, and what an action on them links to.
LOGS = {"House Checklist": ("view", "tracker"), "Pack Checklist": ("click", "tracker"), "Swab Results": ("purchase", "lab"), "Pest Log": ("signup", "pest")}
ACTION_LOGS = (*LOGS, "Other Log")


def _log_of(event_type):
    return codes.map_values(event_type, {kind: log for log, (kind, _) in LOGS.items()})


def raw_actions(t: Tables) -> DataFrame:
    """The action sheet: a row per error event. It names a log and the id of an entry there."""
    e = t.events.where("event_type = 'error'")
    log = F.element_at(F.array(*[F.lit(x) for x in ACTION_LOGS]), (F.col("event_id") % 9 % 5 + 1).cast("int"))
    return e.select("event_id", log.alias("log"), F.when(F.col("event_id") % 31 == 0, "").otherwise((F.col("event_id") - F.col("user_id") % 4 - 1).cast("string")).alias("log_id"),
                    F.when(F.col("event_id") % 17 == 0, "soon").otherwise(F.date_format("ts", "M/d/yy")).alias("reported"),
                    F.when(F.col("user_id") % 2 == 0, "Cleaned ").otherwise("").alias("action"), F.when(F.col("user_id") % 3 == 0, "Retrained").otherwise("").alias("other"))


def raw_entries(t: Tables) -> DataFrame:
    """The rows of the log sheets: entry id, time as text, who reported (a name is nobody)."""
    e = t.events.where("event_type <> 'error'")
    return e.select(_log_of(F.col("event_type")).alias("log"), F.col("event_id").cast("string").alias("log_id"),
                    F.date_format("ts", "yyyy-MM-dd H:mm:ss").alias("reported_at"), (F.col("user_id") % 20).alias("site_id"),
                    F.when(F.col("user_id") % 5 == 0, "Kim").otherwise(F.concat(F.lit("U"), F.col("user_id"), F.lit("@farm"))).alias("reported_by"))


def link_targets(t: Tables) -> DataFrame:
    """Loaded rows that an action can link to: trackers of both checklists, lab results, and the pest results of each tracker.
    One in seven was not loaded; some have only the site, some only the time of their entry."""
    e = t.events.where("event_type <> 'error' AND event_id % 7 <> 0").withColumn("log", _log_of(F.col("event_type")))
    who = F.when(F.col("user_id") % 5 == 0, SYSTEM).otherwise(F.concat(F.lit("u"), F.col("user_id"), F.lit("@farm")))
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    e = e.select("log", second.alias("at"), F.when((F.col("log") != "Swab Results") & (F.col("event_id") % 6 != 0), who).alias("who"),
                 F.when(F.col("event_id") % 4 != 0, F.col("user_id") % 20).alias("site_id"), "event_id")
    pest = F.col("log") == "Pest Log"
    fan = F.explode(F.when(pest, F.array(F.lit(3), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0))))
    return e.withColumn("n", fan).withColumn("target_id", F.when(pest, F.col("event_id") * 100 + F.col("n")).otherwise(F.col("event_id") * 10))


def corrective_actions(actions: DataFrame, entries: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(linked actions, rows left out with a reason). The entry that an action names gives time, site and reporter; the loaded row
    is the first one of that log with the same time and reporter, else time and site, else time."""
    a = actions.withColumn("reported_on", parse.parse_date_multi("reported")).join(entries, ["log", "log_id"], "left")
    at = parse.parse_ts_multi("reported_at").cast("timestamp_ntz")
    a = a.withColumn("at", at).withColumn("who", F.when(F.col("reported_by").isNotNull(), codes.user_or_default(F.lower("reported_by"), SYSTEM)))
    keys = [["log", "at", "who"], ["log", "at", "site_id"], ["log", "at"]]
    levels = [[F.lit(i), *[F.col(c) for c in k]] for i, k in enumerate(keys)]
    found = jn.prioritised_match(a, "event_id", levels, targets, levels, "target_id", ["event_id", "n"], "target_id", "matched_on")
    notes = F.concat_ws(" | ", F.nullif(F.trim("action"), F.lit("")), F.nullif(F.trim("other"), F.lit("")))
    found = found.withColumn("notes", F.nullif(notes, F.lit("")))
    kind = codes.map_values("log", {log: k for log, (_, k) in LOGS.items()})
    found = found.withColumn("kind", kind)
    return rows.quarantine(found, [("no_source", F.col("kind").isNull(), F.col("log")), ("no_match", F.col("log_id") == "", None),
                                   ("no_date", F.col("reported_on").isNull(), F.col("reported")), ("no_match", F.col("target_id").isNull(), F.col("log_id"))])


def _actions(t: Tables):
    return corrective_actions(raw_actions(t), raw_entries(t), link_targets(t))


_ACTIONS_SQL = f"""
WITH names AS (SELECT * FROM (VALUES {", ".join(f"('{log}', '{e}', '{k}')" for log, (e, k) in LOGS.items())}) v(log, event_type, kind)),
a AS (SELECT event_id, [{", ".join(f"'{x}'" for x in ACTION_LOGS)}][(event_id % 9 % 5 + 1)::INTEGER] AS log, event_id - user_id % 4 - 1 AS entry, event_id % 31 = 0 AS blank,
    event_id % 17 = 0 AS undated, ts::DATE AS reported_on, CASE WHEN user_id % 2 = 0 THEN 'Cleaned' END AS action, CASE WHEN user_id % 3 = 0 THEN 'Retrained' END AS other
  FROM events WHERE event_type = 'error'),
e AS (SELECT event_id AS entry, log, kind, date_trunc('second', ts) AS tm, user_id % 20 AS site_id,
    CASE WHEN user_id % 5 = 0 THEN '{SYSTEM}' ELSE 'u' || user_id || '@farm' END AS who FROM events JOIN names USING (event_type)),
g AS (SELECT log, tm, CASE WHEN log <> 'Swab Results' AND entry % 6 <> 0 THEN who END AS who, CASE WHEN entry % 4 <> 0 THEN site_id END AS site_id,
    entry, CASE WHEN kind = 'pest' THEN entry * 100 + 1 ELSE entry * 10 END AS target_id FROM e WHERE entry % 7 <> 0),
m AS (SELECT a.*, names.kind, e.entry AS found, coalesce(
    (SELECT arg_min({{'level': 0, 'id': target_id}}, g.entry) FROM g WHERE g.log = e.log AND g.tm = e.tm AND g.who = e.who),
    (SELECT arg_min({{'level': 1, 'id': target_id}}, g.entry) FROM g WHERE g.log = e.log AND g.tm = e.tm AND g.site_id = e.site_id),
    (SELECT arg_min({{'level': 2, 'id': target_id}}, g.entry) FROM g WHERE g.log = e.log AND g.tm = e.tm)) AS hit
  FROM a LEFT JOIN names ON names.log = a.log LEFT JOIN e ON e.log = a.log AND e.entry = a.entry AND NOT a.blank),
r AS (SELECT *, CASE WHEN kind IS NULL THEN 'no_source' WHEN blank THEN 'no_match' WHEN undated THEN 'no_date' WHEN hit IS NULL THEN 'no_match' END AS reason FROM m)"""


@register("etl_corrective_actions_links", _ACTIONS_SQL + """
SELECT event_id, log, reported_on, CASE WHEN kind = 'tracker' THEN hit.id END AS tracker_id, CASE WHEN kind = 'lab' THEN hit.id END AS result_id,
  CASE WHEN kind = 'pest' THEN hit.id END AS pest_result_id, hit.level AS matched_on, nullif(concat_ws(' | ', action, other), '') AS notes
FROM r WHERE reason IS NULL""")
def q_etl_corrective_actions_links(spark, d):
    kept = _actions(Tables(spark, d))[0]
    link = {k: F.when(F.col("kind") == k, F.col("target_id")) for k in ("tracker", "lab", "pest")}
    return kept.select("event_id", "log", "reported_on", link["tracker"].alias("tracker_id"), link["lab"].alias("result_id"),
                       link["pest"].alias("pest_result_id"), "matched_on", "notes")


@register("etl_corrective_actions_skips", _ACTIONS_SQL + " SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def q_etl_corrective_actions_skips(spark, d):
    return _actions(Tables(spark, d))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
