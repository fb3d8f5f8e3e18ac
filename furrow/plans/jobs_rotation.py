"""Greenhouse rows, plantings and the seeding rotation (§2.13 ``etl_plant_map``
and ``etl_seed_batches``, the tables beyond their main one), over a plant map
sheet rendered from the given tables: house = supplier, every tenth one an
annex whose rows follow those of the house before it; row = part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import codes, parse
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.session import written_table
from furrow.sources.tables import Tables

# Variety names of the map, the pair that 'Mixed' stands for, plants that a bag can hold.
VARIETIES = {"Keiki": "K", "Japanese": "J", "English": "E"}
MIXED = ("K", "J")
PLANTS_PER_BAG = (4, 5)
# Binding: rows of an annex come after this many of its house; the rotation and its planning time.
ANNEX_OFFSET = 1_000_000
N_SLOTS, ANCHOR_SLOT, ANCHOR_DATE = 52, 8, "2001-01-07"
PLANNED_AFTER, PLANNED_UNTIL = "2002-01-01", "2002-12-31"
TRANSPLANT_DAYS = 14
SHEET_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def raw_plant_map(t: Tables) -> DataFrame:
    """The sheet: text cells, repeated and unreadable rows included."""
    n = F.col("l_linenumber")
    now = F.when(F.col("l_returnflag") == "A", "Keiki").when(F.col("l_returnflag") == "N", " Japanese/Keiki").otherwise("Mixed")
    plan = F.when(n == 2, "English").when(n == 3, "").when(n == 4, "Mixed").when(n == 5, "Keiki/English").when(n == 7, "Unknown").otherwise(now)
    house = F.when(F.col("l_suppkey") % 10 == 7, F.concat(F.lit("Annex "), F.col("l_suppkey") - 1)).otherwise(F.concat(F.lit("House "), F.col("l_suppkey")))
    return t.lineitem.select(
        *SHEET_ORDER, house.alias("greenhouse"), F.when((n == 7) & (F.col("l_quantity") > 45), "n/a").otherwise(F.col("l_partkey").cast("string")).alias("row"),
        now.alias("variety"), (F.col("l_quantity").cast("int") % 3 + 3).cast("string").alias("plants_per_bag"),
        F.col("l_quantity").cast("int").cast("string").alias("bags_per_row"),
        plan.alias("variety2"), (n % 3 + 4).cast("string").alias("plants_per_bag2"),
        F.when(F.col("l_tax") < 0.03, "").otherwise((F.col("l_quantity").cast("int") + n).cast("string")).alias("bags_per_row2"))


def plant_rows(raw: DataFrame) -> DataFrame:
    """One row per site and physical row, the first in the sheet: ids and numbers out of the cells."""
    annex = F.col("greenhouse").startswith("Annex ")
    cells = raw.withColumn("site_id", F.regexp_extract("greenhouse", r"(\d+)$", 1).cast("bigint")) \
        .withColumn("row_number", codes.offset_key(parse.parse_int_trunc("row").cast("bigint"), annex, ANNEX_OFFSET)) \
        .where(F.col("row_number").isNotNull())
    numbers = {c: parse.parse_int_trunc(c) for c in ("plants_per_bag", "plants_per_bag2", "bags_per_row", "bags_per_row2")}
    first = win.keep_first(cells.select("site_id", "row_number", "variety", "variety2", *numbers, *SHEET_ORDER), ["site_id", "row_number"], SHEET_ORDER)
    out = first.select("site_id", "row_number", "variety", "variety2", *[e.alias(c) for c, e in numbers.items()])
    for c, to in (("variety", "now"), ("variety2", "plan")):
        pair = codes.split_pair_cell(c, None, ("Mixed", ("", "")))
        mixed = F.trim(c) == "Mixed"
        for i, part in enumerate(("primary", "secondary")):
            known = F.when(mixed, F.lit(MIXED[i])).otherwise(codes.map_values(pair[part], VARIETIES))
            out = out.withColumn(f"{to}_{i + 1}", known)
    return out


PLANT_ROWS_SQL = f"""
sheet AS (SELECT *, CASE WHEN l_suppkey % 10 = 7 THEN l_suppkey - 1 ELSE l_suppkey END AS site_id,
    l_partkey + CASE WHEN l_suppkey % 10 = 7 THEN {ANNEX_OFFSET} ELSE 0 END AS row_number,
    CASE l_returnflag WHEN 'A' THEN 'K' WHEN 'N' THEN 'J' ELSE 'K' END AS now_1, CASE l_returnflag WHEN 'N' THEN 'K' WHEN 'R' THEN 'J' END AS now_2,
    l_quantity::INTEGER % 3 + 3 AS ppb1, l_quantity::INTEGER AS bags1, l_linenumber % 3 + 4 AS ppb2,
    CASE WHEN l_tax < 0.03 THEN 0 ELSE l_quantity::INTEGER + l_linenumber END AS bags2
  FROM lineitem WHERE NOT (l_linenumber = 7 AND l_quantity > 45)),
prows AS (SELECT *, CASE l_linenumber WHEN 2 THEN 'E' WHEN 3 THEN NULL WHEN 4 THEN 'K' WHEN 5 THEN 'K' WHEN 7 THEN NULL ELSE now_1 END AS plan_1,
    CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 'J' WHEN 5 THEN 'E' WHEN 7 THEN NULL ELSE now_2 END AS plan_2
  FROM (SELECT *, row_number() OVER (PARTITION BY site_id, row_number ORDER BY {", ".join(SHEET_ORDER)}) AS seen FROM sheet) WHERE seen = 1)"""


def plantings(rows: DataFrame) -> DataFrame:
    """A planting per row and scenario that names a variety and a possible number of plants; planned bags default to the
    present ones."""
    bags = F.coalesce("bags_per_row", F.lit(0))
    bags2 = F.coalesce("bags_per_row2", F.lit(0))
    scenarios = F.explode(F.array(*[F.struct(
        F.lit(name).alias("scenario"), F.col(f"{to}_1").alias("variety_1"), F.col(f"{to}_2").alias("variety_2"), F.col(ppb).alias("plants_per_bag"), n.alias("num_bags"))
        for name, to, ppb, n in (("Current", "now", "plants_per_bag", bags), ("Planned", "plan", "plants_per_bag2", F.when(bags2 != 0, bags2).otherwise(bags)))]))
    return rows.select("site_id", "row_number", scenarios.alias("s")).select("site_id", "row_number", "s.*") \
        .where(F.col("variety_1").isNotNull() & F.col("plants_per_bag").isin(*PLANTS_PER_BAG))


_PLANTINGS_SQL = PLANT_ROWS_SQL + """,
plantings AS (SELECT site_id, row_number, 'Current' AS scenario, now_1 AS variety_1, now_2 AS variety_2, ppb1 AS plants_per_bag, bags1 AS num_bags
  FROM prows WHERE ppb1 IN (4, 5)
  UNION ALL SELECT site_id, row_number, 'Planned', plan_1, plan_2, ppb2, CASE WHEN bags2 = 0 THEN bags1 ELSE bags2 END
  FROM prows WHERE plan_1 IS NOT NULL AND ppb2 IN (4, 5))"""


@register("etl_plant_map_plantings", "WITH " + _PLANTINGS_SQL + " SELECT * FROM plantings")
def q_etl_plant_map_plantings(spark, d):
    return plantings(plant_rows(raw_plant_map(Tables(spark, d))))


@register("etl_plant_map_changes", "WITH " + _PLANTINGS_SQL + """,
both_ AS (SELECT site_id, row_number, c.variety_1, c.variety_2, c.plants_per_bag, p.variety_1 AS planned_1, p.variety_2 AS planned_2,
    p.plants_per_bag AS planned_per_bag
  FROM (SELECT * FROM plantings WHERE scenario = 'Planned') p LEFT JOIN (SELECT * FROM plantings WHERE scenario = 'Current') c USING (site_id, row_number)
  WHERE c.variety_1 IS DISTINCT FROM p.variety_1 OR c.variety_2 IS DISTINCT FROM p.variety_2 OR c.plants_per_bag IS DISTINCT FROM p.plants_per_bag),
marked AS (SELECT *, CASE WHEN lag(row_number) OVER w = row_number - 1 AND lag((variety_1, variety_2, plants_per_bag, planned_1, planned_2, planned_per_bag)) OVER w
    IS NOT DISTINCT FROM (variety_1, variety_2, plants_per_bag, planned_1, planned_2, planned_per_bag) THEN 0 ELSE 1 END AS starts
  FROM both_ WINDOW w AS (PARTITION BY site_id ORDER BY row_number)),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY site_id ORDER BY row_number) AS run FROM marked)
SELECT site_id, min(row_number) AS row_number_from, max(row_number) AS row_number_to, count(*) AS n, any_value(variety_1) AS variety_1,
  any_value(variety_2) AS variety_2, any_value(plants_per_bag) AS plants_per_bag, any_value(planned_1) AS planned_1, any_value(planned_2) AS planned_2,
  any_value(planned_per_bag) AS planned_per_bag
FROM runs GROUP BY site_id, run""")
def q_etl_plant_map_changes(spark, d):
    """Runs of neighbouring rows whose planned planting is another than the present one, as row ranges."""
    rows = plantings(plant_rows(raw_plant_map(Tables(spark, d))))
    what = {"variety_1": "planned_1", "variety_2": "planned_2", "plants_per_bag": "planned_per_bag"}
    both = rows.groupBy("site_id", "row_number").agg(
        F.max((F.col("scenario") == "Planned").cast("int")).alias("planned"),
        *[F.max(F.when(F.col("scenario") == "Current", F.col(c))).alias(c) for c in what],
        *[F.max(F.when(F.col("scenario") == "Planned", F.col(c))).alias(p) for c, p in what.items()])
    same = F.lit(True)
    for c, p in what.items():
        same = same & F.col(c).eqNullSafe(F.col(p))
    changed = written_table(both.where((F.col("planned") == 1) & ~same).drop("planned"), "plant-map-changes")
    return win.value_runs(changed, ["site_id"], "row_number", [*what, *what.values()])


def planned_seeds(rows: DataFrame) -> DataFrame:
    """Seeds and rows of 4 and 5 plants a bag for each site and variety; a pair of varieties shares the bags of a row."""
    bags = F.coalesce("bags_per_row2", F.lit(0))
    use = rows.where(F.col("plan_1").isNotNull() & F.col("plants_per_bag2").isin(*PLANTS_PER_BAG) & (bags != 0))
    share = F.when(F.col("plan_2").isNotNull(), bags / 2).otherwise(bags.cast("double"))
    each = use.select("site_id", F.explode(F.filter(F.array("plan_1", "plan_2"), lambda v: v.isNotNull())).alias("variety"), share.alias("bags"),
                      F.col("plants_per_bag2").alias("ppb"))
    return each.groupBy("site_id", "variety").agg(
        F.sum(F.floor(F.col("bags") * F.col("ppb"))).alias("seeds"),
        *[F.sum(F.when(F.col("ppb") == n, F.bround("bags")).otherwise(0.0)).cast("bigint").alias(f"rows_{n}_per_bag") for n in PLANTS_PER_BAG])


@register("etl_seed_batches_forward", "WITH RECURSIVE " + PLANT_ROWS_SQL + f""",
shares AS (SELECT site_id, unnest(CASE WHEN plan_2 IS NULL THEN [plan_1] ELSE [plan_1, plan_2] END) AS variety, ppb2,
    CASE WHEN plan_2 IS NULL THEN bags2::DOUBLE ELSE bags2 / 2 END AS bags
  FROM prows WHERE plan_1 IS NOT NULL AND ppb2 IN (4, 5) AND bags2 <> 0),
seeds AS (SELECT site_id, variety, sum(floor(bags * ppb2))::BIGINT AS seeds,
    sum(CASE WHEN ppb2 = 4 THEN round_even(bags, 0) ELSE 0 END)::BIGINT AS rows_4_per_bag,
    sum(CASE WHEN ppb2 = 5 THEN round_even(bags, 0) ELSE 0 END)::BIGINT AS rows_5_per_bag FROM shares GROUP BY ALL),
turns AS (SELECT s_suppkey AS site_id, (DATE '{ANCHOR_DATE}' + ((((s_suppkey - {ANCHOR_SLOT}) % {N_SLOTS} + {N_SLOTS}) % {N_SLOTS}) * 7)::INTEGER)::DATE AS d
    FROM supplier
  UNION ALL SELECT site_id, (d + {N_SLOTS * 7})::DATE FROM turns WHERE d + {N_SLOTS * 7} <= DATE '{PLANNED_UNTIL}'),
bag_changes AS (SELECT l_suppkey AS site_id, l_shipdate::DATE AS changed FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)
SELECT site_id, variety, d AS seeding_date, (d + {TRANSPLANT_DAYS})::DATE AS transplant_date,
  (SELECT min(changed) FROM bag_changes b WHERE b.site_id = t.site_id AND changed >= d) AS next_bag_change_date, seeds, rows_4_per_bag, rows_5_per_bag
FROM turns t JOIN seeds USING (site_id) WHERE d > DATE '{PLANNED_AFTER}' AND d <= DATE '{PLANNED_UNTIL}' AND seeds > 0""")
def q_etl_seed_batches_forward(spark, d):
    """Planned batches: each site's turns of the rotation, its planned seeds, and the next bag change on or after the seeding."""
    t = Tables(spark, d)
    seeds = planned_seeds(plant_rows(raw_plant_map(t))).where("seeds > 0")
    turns = rs.rotation_calendar(t.supplier.select(F.col("s_suppkey").alias("site_id")), "site_id", ANCHOR_SLOT, ANCHOR_DATE, N_SLOTS,
                                 PLANNED_AFTER, PLANNED_UNTIL, "seeding_date")
    changes = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)) \
        .select(F.col("l_suppkey").alias("site_id"), F.col("l_shipdate").cast("date").alias("changed")).distinct()
    turns = jn.asof_next_bucketed(turns, changes, ["site_id"], "seeding_date", "changed", "year", "next_bag_change_date")
    return turns.join(seeds, "site_id").select(
        "site_id", "variety", "seeding_date", F.date_add("seeding_date", TRANSPLANT_DAYS).alias("transplant_date"), "next_bag_change_date",
        "seeds", *[f"rows_{n}_per_bag" for n in PLANTS_PER_BAG])


# The house codes and variety letters of a cycle code.
HOUSE_CODES = ("01", "02", "03", "04", "05", "06", "07", "08", "KO", "HK", "WA", "HI")
CYCLE_CODE = r"^(\d{2})(0[1-9]|1[0-2])(" + "|".join(HOUSE_CODES) + r")([KJE])$"


def stub_batches(harvest: DataFrame, existing: DataFrame, code: str, order) -> DataFrame:
    """A stub for each cycle code of the harvest that no batch has: 'S-' before a code is a label of the same batch; the
    first raw text in ``order`` is kept for the note, codes of another shape are left out."""
    raw = F.upper(F.trim(F.col(code)))
    plain = F.regexp_replace(raw, "^S-", "")
    named = harvest.select(raw.alias("raw"), plain.alias("code"), *order).where(F.col("code").rlike(CYCLE_CODE))
    first = win.keep_first(named, ["code"], order).select("code", "raw")
    new = first.join(existing.select(F.upper("code").alias("code")), "code", "left_anti")
    year = F.substr("code", F.lit(1), F.lit(2)).cast("int")
    seeded = F.make_date(F.when(year < 70, year + 2000).otherwise(year + 1900), F.substr("code", F.lit(3), F.lit(2)).cast("int"), F.lit(1))
    return new.select("code", F.lower(F.substr("code", F.lit(5), F.lit(2))).alias("site_id"), F.substr("code", F.lit(7), F.lit(1)).alias("variety"),
                      seeded.alias("seeding_date"), F.date_add(seeded, TRANSPLANT_DAYS).alias("transplant_date"),
                      F.concat(F.lit("stub for cycle code "), "raw").alias("notes"))


@register("etl_seed_batch_stubs", """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%y%m') || lpad((o_custkey % 12)::VARCHAR, 2, '0')
    || CASE o_orderstatus WHEN 'F' THEN 'K' WHEN 'O' THEN 'J' ELSE 'E' END AS code FROM orders),
h AS (SELECT code, CASE WHEN l_linenumber % 2 = 0 THEN 'S-' ELSE '' END || code AS raw,
    row_number() OVER (PARTITION BY code ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem JOIN o ON o_orderkey = l_orderkey WHERE substr(code, 5, 2) BETWEEN '01' AND '08')
SELECT code, substr(code, 5, 2) AS site_id, substr(code, 7, 1) AS variety, d AS seeding_date, (d + 14)::DATE AS transplant_date,
  'stub for cycle code ' || raw AS notes
FROM (SELECT *, make_date((substr(code, 1, 2)::INTEGER + CASE WHEN substr(code, 1, 2)::INTEGER < 70 THEN 2000 ELSE 1900 END)::BIGINT, substr(code, 3, 2)::BIGINT, 1) AS d
  FROM h WHERE rn = 1)
WHERE code NOT IN (SELECT code FROM o WHERE o_orderkey % 3 = 0)""")
def q_etl_seed_batch_stubs(spark, d):
    """Batches are known for every third order; the harvest names the cycles of all, even lines with the label."""
    t = Tables(spark, d)
    letter = F.when(F.col("o_orderstatus") == "F", "K").when(F.col("o_orderstatus") == "O", "J").otherwise("E")
    o = t.orders.select("o_orderkey", codes.cycle_code("o_orderdate", F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0"), letter).alias("code"))
    harvest = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "cycle", F.concat(F.when(F.col("l_linenumber") % 2 == 0, " s-").otherwise(""), F.lower("code")))
    return stub_batches(harvest, o.where("o_orderkey % 3 = 0").select("code").distinct(), "cycle", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
