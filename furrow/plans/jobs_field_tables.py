"""Further tables of the field jobs (§2.13): lettuce batches, lots and weights,
scouting results and photos, the batches of monitoring rows, spray compliance
and inputs. The sheets are rendered from orders, line items, customers and
parts, with text cells, blanks and unknown names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import arith, codes, lists, parse, text
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import rows
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.sources.tables import Tables

SYSTEM = "system@farm"


# ---------------------------------------------------------------- etl_lettuce

# Days from seeding to pond and to harvest where the sheet has none; batch states.
POND_DAYS, HARVEST_DAYS = 2, 21
STATES = {"complete": "Harvested", "harvesting": "Harvesting", "pre-harvesting": "Transplanted"}
# Binding: seed names that are mixes of items.
MIXES = ("spring mix", "baby mix")


def raw_lettuce(t: Tables) -> DataFrame:
    """The seeding sheet: a row per order."""
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    day = lambda n, fmt="M/d/yyyy": F.date_format(F.date_add(d.cast("date"), n), fmt)
    return t.orders.select(
        k.alias("entry_id"), F.when(k % 41 == 0, "").otherwise(day(0)).alias("seeded"), F.concat(F.lit(" P"), c % 30).alias("pond"),
        F.when(k % 5 == 0, "Spring Mix ").when(k % 5 == 1, "Baby mix").otherwise(F.concat(F.lit("Item "), k % 120)).alias("seed"),
        F.when(k % 43 == 0, " ").otherwise(F.concat(F.date_format(d, "yyMM"), F.lit("P"), "o_orderstatus")).alias("cycle"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("L"), k % 4)).alias("lot"), F.when(k % 3 == 0, "").otherwise(day(3)).alias("ponded"),
        F.when(k % 4 == 0, "").otherwise(day(20, "yyyy-MM-dd")).alias("expected"), F.when(k % 7 == 0, "x").otherwise((k % 9 * 4).cast("string")).alias("boards"),
        F.when(F.col("o_orderstatus") == "F", "Complete").when(F.col("o_orderstatus") == "O", " harvesting").otherwise("?").alias("state"),
        F.when(k % 2 == 0, "").otherwise(day(22)).alias("harvested"), (k % 50 / 2).cast("string").alias("pounds"),
        F.when(k % 4 == 1, "Ann").otherwise(F.concat(F.lit("U"), c, F.lit("@farm"))).alias("reported_by"))


def lettuce_rows(raw: DataFrame, ponds: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be loaded, rows left out with a reason)."""
    x = raw.withColumn("seeding_date", parse.parse_date_multi("seeded")).withColumn("pond", F.lower(F.trim("pond"))).withColumn("seed", F.lower(F.trim("seed"))) \
        .withColumn("cycle", F.nullif(F.trim("cycle"), F.lit("")))
    x = x.join(ponds.select("pond", F.lit(True).alias("_pond")), "pond", "left").join(items.select(F.col("item").alias("seed"), "item_id"), "seed", "left")
    x = x.withColumn("is_mix", F.col("seed").isin(*MIXES))
    return rows.quarantine(x, [("no_seeding_date", F.col("seeding_date").isNull(), None), ("unknown_pond", F.col("_pond").isNull(), F.col("pond")),
                               ("no_seedingcycle", F.col("cycle").isNull(), None), ("unknown_seedname", ~F.col("is_mix") & F.col("item_id").isNull(), F.col("seed"))])


def lettuce_batches(kept: DataFrame) -> DataFrame:
    """A batch per row; further batches of a cycle get '_2', '_3' in order of their entry."""
    x = kept.select(
        "entry_id", F.col("pond").alias("site_id"), F.col("cycle").alias("batch_code"), F.when(~F.col("is_mix"), F.col("item_id")).alias("item_id"),
        F.when(F.col("is_mix"), F.col("seed")).alias("mix_id"), F.when(~F.col("is_mix") & (F.trim("lot") != ""), F.concat_ws(":", "seed", F.trim("lot"))).alias("lot_id"),
        F.coalesce(parse.parse_int_trunc("boards"), F.lit(-1)).alias("number_of_units"), "seeding_date",
        arith.default_dates(parse.parse_date_multi("ponded"), F.col("seeding_date"), POND_DAYS).alias("transplant_date"),
        arith.default_dates(parse.parse_date_multi("expected"), F.col("seeding_date"), HARVEST_DAYS).alias("estimated_harvest_date"),
        F.coalesce(codes.map_values(F.lower(F.trim("state")), STATES), F.lit("Harvested")).alias("status"), codes.user_or_default(F.lower("reported_by"), SYSTEM).alias("created_by"))
    return win.dup_suffix_bucketed(x, "batch_code", ["entry_id"], F.floor(F.col("entry_id") / 10_000))


def _lettuce(t: Tables):
    ponds = t.nation.select(F.concat(F.lit("p"), "n_nationkey").alias("pond"))
    items = t.part.where("p_partkey < 100").select(F.concat(F.lit("item "), "p_partkey").alias("item"), F.col("p_partkey").alias("item_id"))
    return lettuce_rows(raw_lettuce(t), ponds, items)


_LETTUCE_SQL = """
WITH s AS (SELECT *, o_orderkey AS k, o_orderdate::DATE AS d, CASE k % 5 WHEN 0 THEN 'spring mix' WHEN 1 THEN 'baby mix' ELSE 'item ' || (k % 120) END AS seed,
    k % 5 < 2 AS is_mix, strftime(o_orderdate, '%y%m') || 'P' || o_orderstatus AS cycle FROM orders),
r AS (SELECT *, CASE WHEN k % 41 = 0 THEN 'no_seeding_date' WHEN o_custkey % 30 >= 25 THEN 'unknown_pond' WHEN k % 43 = 0 THEN 'no_seedingcycle'
    WHEN NOT is_mix AND k % 120 >= 100 THEN 'unknown_seedname' END AS reason FROM s),
kept AS (SELECT * FROM r WHERE reason IS NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY k) AS rn FROM kept)"""


@register("etl_lettuce_batches", _LETTUCE_SQL + f"""
SELECT k AS entry_id, 'p' || (o_custkey % 30) AS site_id, cycle || CASE WHEN rn > 1 THEN '_' || rn ELSE '' END AS batch_code, CASE WHEN NOT is_mix THEN k % 120 END AS item_id,
  CASE WHEN is_mix THEN seed END AS mix_id, CASE WHEN NOT is_mix AND k % 3 <> 0 THEN seed || ':L' || (k % 4) END AS lot_id,
  CASE WHEN k % 7 = 0 THEN -1 ELSE k % 9 * 4 END::INTEGER AS number_of_units, d AS seeding_date, d + CASE WHEN k % 3 = 0 THEN {POND_DAYS} ELSE 3 END AS transplant_date,
  d + CASE WHEN k % 4 = 0 THEN {HARVEST_DAYS} ELSE 20 END AS estimated_harvest_date, CASE o_orderstatus WHEN 'O' THEN 'Harvesting' ELSE 'Harvested' END AS status,
  CASE WHEN k % 4 = 1 THEN '{SYSTEM}' ELSE 'u' || o_custkey || '@farm' END AS created_by FROM b""")
def q_etl_lettuce_batches(spark, d):
    return lettuce_batches(_lettuce(Tables(spark, d))[0])


@register("etl_lettuce_lots", _LETTUCE_SQL + " SELECT DISTINCT seed || ':L' || (k % 4) AS lot_id, k % 120 AS item_id, 'L' || (k % 4) AS lot_number FROM kept WHERE NOT is_mix AND k % 3 <> 0")
def q_etl_lettuce_lots(spark, d):
    """The seed lots that the sheet names; mixes have none."""
    kept = _lettuce(Tables(spark, d))[0].where(~F.col("is_mix") & (F.trim("lot") != ""))
    return kept.select(F.concat_ws(":", "seed", F.trim("lot")).alias("lot_id"), "item_id", F.trim("lot").alias("lot_number")).distinct()


@register("etl_lettuce_weights", _LETTUCE_SQL + """
SELECT k AS entry_id, 'p' || (o_custkey % 30) AS site_id, d + 22 AS harvest_date, k % 50 / 2 AS net_weight FROM kept WHERE k % 2 = 1 AND k % 50 > 0""")
def q_etl_lettuce_weights(spark, d):
    """Weights of the batches that are harvested."""
    x = _lettuce(Tables(spark, d))[0].withColumn("harvest_date", parse.parse_date_multi("harvested")).withColumn("net_weight", parse.parse_number("pounds"))
    return x.where(F.col("harvest_date").isNotNull() & (F.col("net_weight") > 0)).select("entry_id", F.col("pond").alias("site_id"), "harvest_date", "net_weight")


@register("etl_lettuce_skips", _LETTUCE_SQL + " SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def q_etl_lettuce_skips(spark, d):
    return _lettuce(Tables(spark, d))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- etl_scouting

# Severities, and what the names of the sheet are; photo folders of the sheet and of the store.
SEVERITIES = {"low": "Low", "moderate": "Moderate", "high": "High", "severe": "Severe"}
FINDINGS = {"aphids": "Pest:Aphid", "thrips": "Pest:Thrips", "powdery mildew": "Disease:Powdery Mildew"}
PHOTO_PATHS = [("grow_scouting_observations_Images/", "images/grow_task/scouting/")]


def raw_observations(t: Tables) -> DataFrame:
    """The observation sheet: a row per line item, under the scouting of its order."""
    n = F.col("l_linenumber")
    path = lambda i: F.concat(F.lit("grow_scouting_observations_Images/"), "l_partkey", F.lit(f"_{i}.jpg"))
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("observation_id"), F.col("l_orderkey").alias("scouting_id"),
        F.when(F.col("l_returnflag") == "A", "Aphids ").when(n == 1, "thrips").when(n == 2, "gnome").otherwise("Powdery mildew").alias("pest_type"),
        F.when(F.col("l_tax") < 0.02, "").when(F.col("l_tax") < 0.05, "HIGH").otherwise(" low").alias("severity"), F.when(n % 2 == 0, "leaf").otherwise("").alias("part"),
        F.when(n == 4, "many of them").otherwise(" ").alias("comments"), F.when(n % 3 == 0, path(1)).otherwise("").alias("photo_01"), F.when(n == 6, path(2)).otherwise("").alias("photo_02"))


def scouting(observations: DataFrame, trackers: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, rows left out with a reason): an observation needs its scouting, a known finding and a severity."""
    target = codes.map_values(F.lower(F.trim("pest_type")), FINDINGS)
    x = observations.join(trackers.select("scouting_id", F.lit(True).alias("_tracker")), "scouting_id", "left").withColumn("target", target)
    x = x.join(known.select("target", F.lit(True).alias("_known")), "target", "left").withColumn("severity_level", codes.map_values(F.lower(F.trim("severity")), SEVERITIES))
    missing = F.concat(F.lit("missing_"), F.lower(F.substring_index("target", ":", 1)))
    x = x.withColumn("observation_type", F.substring_index("target", ":", 1)).withColumn("finding_id", F.substring_index("target", ":", -1)).withColumn(
        "notes", lists.join_labelled_notes([("ObsID", F.col("observation_id")), ("Part", F.col("part")), ("Comments", F.col("comments"))]))
    kept, out = rows.quarantine(x, [("orphan_observation", F.col("_tracker").isNull(), None), ("unknown_pest_type", F.col("target").isNull(), F.trim("pest_type")),
                                    ("missing_finding", F.col("_known").isNull(), missing), ("no_severity", F.col("severity_level").isNull(), None)])
    return kept, out


def scouting_photos(kept: DataFrame) -> DataFrame:
    """Up to two photos of each result, in the store's folder, with a caption."""
    x = rs.unpivot_slots(kept, ["observation_id", "scouting_id", "part", "pest_type"], [{"url": F.nullif(F.trim(c), F.lit(""))} for c in ("photo_01", "photo_02")], "photo_no")
    caption = F.concat(F.lit("Obs "), "observation_id", F.lit(": "), F.coalesce(F.nullif(F.trim("part"), F.lit("")), F.lit("?")), F.lit(" - "), F.trim("pest_type"))
    return x.select("observation_id", "scouting_id", "photo_no", codes.rewrite_path("url", PHOTO_PATHS).alias("photo_url"), caption.alias("caption"))


_SCOUT_SQL = """
WITH o AS (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS observation_id,
    CASE WHEN l_returnflag = 'A' THEN 'Aphids' WHEN l_linenumber = 1 THEN 'thrips' WHEN l_linenumber = 2 THEN 'gnome' ELSE 'Powdery mildew' END AS what,
    CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.05 THEN 'High' ELSE 'Low' END AS severity_level, l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS there FROM lineitem),
r AS (SELECT *, CASE WHEN NOT there THEN 'orphan_observation' WHEN what = 'gnome' THEN 'unknown_pest_type' WHEN what = 'thrips' THEN 'missing_finding'
    WHEN severity_level IS NULL THEN 'no_severity' END AS reason FROM o),
kept AS (SELECT * FROM r WHERE reason IS NULL)"""


def _scouting(t: Tables):
    trackers = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("scouting_id"))
    known = t.region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "Pest:Aphid").otherwise("Disease:Powdery Mildew").alias("target"))
    return scouting(raw_observations(t), trackers, known)


@register("etl_scouting_results", _SCOUT_SQL + """
SELECT observation_id, l_orderkey AS scouting_id, CASE what WHEN 'Aphids' THEN 'Pest' ELSE 'Disease' END AS observation_type,
  CASE what WHEN 'Aphids' THEN 'Aphid' ELSE 'Powdery Mildew' END AS finding_id, severity_level,
  concat_ws(' | ', 'ObsID: ' || observation_id, CASE WHEN l_linenumber % 2 = 0 THEN 'Part: leaf' END, CASE WHEN l_linenumber = 4 THEN 'Comments: many of them' END) AS notes FROM kept""")
def q_etl_scouting_results(spark, d):
    return _scouting(Tables(spark, d))[0].select("observation_id", "scouting_id", "observation_type", "finding_id", "severity_level", "notes")


@register("etl_scouting_photos", _SCOUT_SQL + """,
p AS (SELECT *, unnest(CASE WHEN l_linenumber = 6 THEN [1, 2] WHEN l_linenumber % 3 = 0 THEN [1] ELSE [] END) AS photo_no FROM kept)
SELECT observation_id, l_orderkey AS scouting_id, photo_no, 'images/grow_task/scouting/' || l_partkey || '_' || photo_no || '.jpg' AS photo_url,
  'Obs ' || observation_id || ': ' || CASE WHEN l_linenumber % 2 = 0 THEN 'leaf' ELSE '?' END || ' - ' || what AS caption FROM p""")
def q_etl_scouting_photos(spark, d):
    return scouting_photos(_scouting(Tables(spark, d))[0])


@register("etl_scouting_skips", _SCOUT_SQL + " SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def q_etl_scouting_skips(spark, d):
    return _scouting(Tables(spark, d))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- etl_monitoring


@register("etl_monitoring_batches", """
WITH cuke AS (SELECT DISTINCT strftime(o_orderdate, '%y%m') || lpad((o_custkey % 12)::VARCHAR, 2, '0') AS code FROM orders),
let AS (SELECT DISTINCT strftime(o_orderdate, '%y%m') || 'P' || o_orderstatus || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_2' ELSE '_3' END AS code FROM orders),
m AS (SELECT c_custkey AS row_id, strftime(DATE '1995-01-01' + to_months((c_custkey % 84)::INTEGER), '%y%m') AS ym, strftime(DATE '1995-02-01' + to_months((c_custkey % 80)::INTEGER), '%y%m') AS ym2
  FROM customer)
SELECT DISTINCT row_id, code AS batch_code FROM m JOIN cuke ON row_id % 2 = 0 AND starts_with(code, CASE WHEN row_id % 6 = 0 THEN ym ELSE ym || lpad((row_id % 12)::VARCHAR, 2, '0') END)
UNION ALL SELECT DISTINCT row_id, code FROM m JOIN let ON row_id % 2 = 1 AND (regexp_replace(code, '_[0-9]+$', '') IN (ym || 'PF', CASE WHEN row_id % 3 = 0 THEN ym2 || 'PO' END)
  OR code IN (ym || 'PF', CASE WHEN row_id % 3 = 0 THEN ym2 || 'PO' END, CASE WHEN row_id % 5 = 0 THEN ym2 || 'PP_3' END))""")
def q_etl_monitoring_batches(spark, d):
    """The batches that a monitoring row's cycle cell names: of one farm all whose code starts with it, of the other those of each
    '+' part, by their code or without the number at its end."""
    t = Tables(spark, d)
    k = F.col("c_custkey")
    ym = F.date_format(F.add_months(F.lit("1995-01-01").cast("date"), (k % 84).cast("int")), "yyMM")
    ym2 = F.date_format(F.add_months(F.lit("1995-02-01").cast("date"), (k % 80).cast("int")), "yyMM")
    cuke = t.orders.select(F.concat(F.date_format("o_orderdate", "yyMM"), F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0")).alias("batch_code")).distinct()
    suffix = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, "_2").otherwise("_3")
    lettuce = t.orders.select(F.concat(F.date_format("o_orderdate", "yyMM"), F.lit("P"), "o_orderstatus", suffix).alias("batch_code")).distinct()
    a = t.customer.where(k % 2 == 0).select(k.alias("row_id"), F.when(k % 6 == 0, ym).otherwise(F.concat(ym, F.lpad((k % 12).cast("string"), 2, "0"))).alias("cycle"))
    b = t.customer.where(k % 2 == 1).select(k.alias("row_id"), F.concat(
        ym, F.lit("PF"), F.when(k % 3 == 0, F.concat(F.lit(" + "), ym2, F.lit("PO"))).otherwise(""), F.when(k % 5 == 0, F.concat(F.lit("+"), ym2, F.lit("PP_3"))).otherwise("")).alias("cycle"))
    of_cuke = jn.prefix_join(a, "cycle", cuke, "batch_code").select("row_id", "batch_code").distinct()
    of_lettuce = jn.multi_code_join(b, "cycle", lettuce.withColumn("id", F.col("batch_code")), "batch_code", "id", keys=["row_id"])
    return of_cuke.unionByName(of_lettuce.select("row_id", F.explode("matched_ids").alias("batch_code")))


# ---------------------------------------------------------------- etl_spraying


def raw_labels(t: Tables) -> DataFrame:
    """The label sheet: products of two farms, some twice, some without a name or known item."""
    k = F.col("p_partkey")
    return t.part.select(k.alias("sheet_row"), F.when(k % 2 == 0, "Cuke").otherwise("Lettuce").alias("farm"),
                         F.when(k % 29 == 0, "").otherwise(F.concat(F.lit("Product "), k % 150)).alias("item"), F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit("EPA-"), k)).alias("registration"),
                         F.when(k % 5 == 0, "none").otherwise((k % 5).cast("string")).alias("phi"), (k % 48).cast("string").alias("rei"),
                         F.when(k % 3 == 0, "aphids, Mites").otherwise("mildew").alias("targets"), F.when(k % 6 == 0, "").otherwise((k % 6 / 2).cast("string")).alias("per_acre"))


def spray_compliance(labels: DataFrame, items: DataFrame) -> DataFrame:
    """One rule per farm and item, the first row of the sheet."""
    x = labels.withColumn("name", F.lower(F.trim("item"))).join(items, "name").where("farm <> ''")
    first = win.keep_first(x.drop("item"), ["farm", "item_id"], ["sheet_row"])
    return first.select(
        "farm", "item_id", F.coalesce(text.clean_text("registration"), F.lit("LEGACY_UNKNOWN")).alias("epa_registration"), F.coalesce(parse.parse_int_trunc("phi"), F.lit(0)).alias("phi_days"),
        F.coalesce(parse.parse_int_trunc("rei"), F.lit(0)).alias("rei_hours"), F.to_json(lists.split_list("targets", ",")).alias("target_pest_disease"),
        F.coalesce(parse.parse_number("per_acre"), F.lit(-1.0)).alias("maximum_quantity_per_acre"))


_SPRAY_SQL = """
WITH items AS (SELECT p_partkey AS item_id, 'product ' || p_partkey AS name FROM part WHERE p_partkey < 120),
rules AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 2, p_partkey % 150 ORDER BY p_partkey) AS rn FROM part WHERE p_partkey % 29 <> 0 AND p_partkey % 150 < 120),
compliance AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'Cuke' ELSE 'Lettuce' END AS farm, p_partkey % 150 AS item_id FROM rules WHERE rn = 1)"""


def _products(t: Tables) -> DataFrame:
    return t.part.where("p_partkey < 120").select(F.col("p_partkey").alias("item_id"), F.concat(F.lit("product "), "p_partkey").alias("name"))


@register("etl_spray_compliance", _SPRAY_SQL + """
SELECT farm, item_id, CASE WHEN k % 4 = 0 THEN 'LEGACY_UNKNOWN' ELSE 'EPA-' || k END AS epa_registration, CASE WHEN k % 5 = 0 THEN 0 ELSE k % 5 END::INTEGER AS phi_days,
  (k % 48)::INTEGER AS rei_hours, CASE WHEN k % 3 = 0 THEN '["aphids","Mites"]' ELSE '["mildew"]' END AS target_pest_disease,
  CASE WHEN k % 6 = 0 THEN -1.0 ELSE k % 6 / 2 END::DOUBLE AS maximum_quantity_per_acre FROM compliance""")
def q_etl_spray_compliance(spark, d):
    t = Tables(spark, d)
    return spray_compliance(raw_labels(t), _products(t))


@register("etl_spray_inputs", _SPRAY_SQL + """,
s AS (SELECT o_orderkey AS tracker_id, CASE WHEN o_custkey % 2 = 0 THEN 'Cuke' ELSE 'Lettuce' END AS farm, unnest([1, 2, 3]) AS slot, o_custkey, o_orderkey % 4 AS q FROM orders),
p AS (SELECT tracker_id, farm, slot, CASE slot WHEN 1 THEN o_custkey % 150 WHEN 2 THEN o_custkey % 7 WHEN 3 THEN (o_custkey * 3) % 150 END AS item_id, slot * q / 2 AS quantity FROM s WHERE NOT (slot = 2 AND q = 1))
SELECT tracker_id, slot, farm, item_id, quantity::DOUBLE AS quantity FROM p SEMI JOIN compliance USING (farm, item_id) WHERE quantity > 0""")
def q_etl_spray_inputs(spark, d):
    """Up to three products of a spraying, those with a rule on its farm and a quantity."""
    t = Tables(spark, d)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sheet = t.orders.select(k.alias("tracker_id"), F.when(c % 2 == 0, "Cuke").otherwise("Lettuce").alias("farm"), F.concat(F.lit("PRODUCT "), c % 150).alias("p1"),
                            F.when(k % 4 == 1, "").otherwise(F.concat(F.lit(" Product "), c % 7)).alias("p2"), F.concat(F.lit("Product "), c * 3 % 150).alias("p3"),
                            *[(k % 4 * i / 2).cast("string").alias(f"q{i}") for i in (1, 2, 3)])
    long = rs.unpivot_slots(sheet, ["tracker_id", "farm"], [{"name": F.nullif(F.lower(F.trim(f"p{i}")), F.lit("")), "quantity": parse.parse_number(f"q{i}")} for i in (1, 2, 3)])
    rules = spray_compliance(raw_labels(t), _products(t)).select("farm", "item_id")
    return long.where("quantity > 0").join(_products(t), "name").join(rules, ["farm", "item_id"], "left_semi").select("tracker_id", "slot", "farm", "item_id", "quantity")
