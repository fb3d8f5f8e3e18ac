"""Inventory job (§2.13): the order sheet to purchase orders, lots and receipts, the count sheet to stock on hand. The
sheets are lineitem rendered as text cells, the item list is part, vendors are supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import parse, text
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.sources.tables import Tables

# Order states and units as they are written, and what they are loaded as.
STATUS = {"received": "Received", "ordered": "Ordered", "cancelled": "Cancelled", "partial": "Partial", "approved": "Approved",
          "requested": "Requested", "rejected": "Rejected"}
UNITS = {"lb": "Pound", "oz": "Ounce", "kg": "Kilogram", "box": "Box"}
RECEIVED = ("Received", "Partial")


def _mapped(c, table: dict, default=None):
    """The loaded value of a cell in any case; ``default`` for others."""
    value = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.lower(text.strip_all(c)))
    return value if default is None else F.coalesce(value, F.lit(default))


def raw_orders(t: Tables) -> DataFrame:
    """The order sheet."""
    k = F.col("l_orderkey") + F.col("l_linenumber")

    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))

    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice",
        F.when(k % 50 == 0, " ").otherwise(F.concat(F.lit(" part "), F.col("l_partkey").cast("string"))).alias("ItemName"),
        pick(("RECEIVED", "partial ", "Ordered", "cancelled", "lost")).alias("OrderStatus"),
        F.concat(F.lit("SUPPLIER "), F.col("l_suppkey").cast("string")).alias("SupplierName"),
        pick(("LB", "kg", "crate")).alias("OrderUnits"), pick(("oz", "")).alias("BurnUnits"),
        F.format_number("l_quantity", 1).alias("OrderedQuantity"), F.format_number("l_extendedprice", 2).alias("TotalCost"),
        F.when(k % 4 == 0, "NA").when(k % 4 == 1, " ").otherwise(F.concat(F.lit("Lot "), (F.col("l_partkey") % 97).cast("string"))).alias("ItemLot"),
        F.when(k % 9 != 0, F.date_format("l_shipdate", "M/d/yyyy")).otherwise("").alias("ArrivalDate"),
        F.when(k % 3 == 0, "Acceptable").otherwise("damp").alias("ItemCondition"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" ")).alias("ReceivedQuantity"))


def items(t: Tables) -> DataFrame:
    """The item list: name, unit, and whether it is still in use."""
    return t.part.select(F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("item"), (F.col("p_size") % 2 == 0).alias("is_active"),
                         F.when(F.col("p_size") > 25, "Box").otherwise("Unit").alias("unit"))


def vendors(t: Tables) -> DataFrame:
    return t.supplier.where("s_suppkey % 5 <> 0").select(F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")).alias("vendor"))


def _with_item(raw: DataFrame, item_list: DataFrame) -> DataFrame:
    """Rows with a name, and the item of that name (in any case) if there is one."""
    x = raw.withColumn("_key", F.lower(text.strip_all("ItemName"))).where("_key <> ''")
    known = item_list.groupBy(F.lower("item").alias("_key")).agg(F.min(F.struct("item", "is_active", "unit")).alias("_item"))
    return x.join(known, "_key", "left")


def purchase_orders(raw: DataFrame, item_list: DataFrame, vendor_list: DataFrame) -> DataFrame:
    """One purchase order per named row; unknown states count as received, unknown units fall back to the other
    unit cell, then the item's, then 'Unit'."""
    x = _with_item(raw, item_list)
    by_name = vendor_list.groupBy(F.lower("vendor").alias("_vendor")).agg(F.min("vendor").alias("vendor"))
    x = x.withColumn("_vendor", F.lower(text.strip_all("SupplierName"))).join(by_name, "_vendor", "left")
    order, burn, own = _mapped("OrderUnits", UNITS), _mapped("BurnUnits", UNITS), F.col("_item.unit")
    return text.map_distinct(x, "ItemName", text.proper_case, "item_name").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("_item.item").alias("item"), "item_name", "vendor",
        _mapped("OrderStatus", STATUS, "Received").alias("status"), F.coalesce(order, own, burn, F.lit("Unit")).alias("order_uom"),
        F.coalesce(burn, own, order, F.lit("Unit")).alias("burn_uom"),
        parse.parse_number("OrderedQuantity", default=0, dtype="decimal(18,2)").alias("order_quantity"),
        F.nullif(parse.parse_number("TotalCost", default=0, dtype="decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("total_cost"))


def _lot_id():
    lot = text.strip_all("ItemLot")
    in_use = F.coalesce(F.col("_item.is_active"), F.lit(False))
    return F.when((lot != "") & (F.upper(lot) != "NA") & in_use, text.slug("ItemLot"))


def lots(raw: DataFrame, item_list: DataFrame) -> DataFrame:
    """Lots of items in use, each from its first row in sheet order."""
    x = _with_item(raw, item_list).withColumn("lot_id", _lot_id()).where("lot_id IS NOT NULL")
    x = x.select("lot_id", F.col("_item.item").alias("item"), text.strip_all("ItemLot").alias("lot_number"), "l_orderkey", "l_linenumber", "l_suppkey",
                 "l_partkey")
    return win.keep_first(x, ["lot_id"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]).select("lot_id", "item", "lot_number")


def receipts(raw: DataFrame, item_list: DataFrame) -> DataFrame:
    """Receipts of received or partly received orders with an arrival date."""
    x = _with_item(raw, item_list)
    x = x.withColumn("received_date", parse.parse_date_multi("ArrivalDate")).withColumn("status", _mapped("OrderStatus", STATUS, "Received"))
    x = x.where(F.col("status").isin(*RECEIVED) & F.col("received_date").isNotNull())
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", "received_date", _lot_id().alias("lot_id"),
                    parse.parse_number("ReceivedQuantity", default=0, dtype="decimal(18,2)").alias("received_quantity"),
                    (F.lower(text.strip_all("ItemCondition")) == "acceptable").alias("acceptable"))


def on_hand(raw: DataFrame, item_list: DataFrame, lot_list: DataFrame) -> DataFrame:
    """Counts of known items with a date; the lot by its number, if it was loaded."""
    x = _with_item(raw, item_list).where("_item IS NOT NULL")
    x = x.withColumn("onhand_date", parse.parse_date_multi("ArrivalDate")).where("onhand_date IS NOT NULL")
    by_number = lot_list.groupBy(F.lower("lot_number").alias("_lot")).agg(F.min("lot_id").alias("lot_id"))
    cell = F.lower(text.strip_all("ItemLot"))
    x = x.withColumn("_lot", F.when(cell != "na", cell)).join(by_number, "_lot", "left")
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("_item.item").alias("item"), "onhand_date",
                    F.coalesce(_mapped("OrderUnits", UNITS), F.col("_item.unit")).alias("onhand_uom"),
                    parse.parse_number("ReceivedQuantity", default=0, dtype="decimal(18,2)").alias("onhand_quantity"), "lot_id")


# The sheet's meaning, cell by cell, in DuckDB.
SHEET_SQL = """
WITH sheet AS (
  SELECT l.*, l_orderkey + l_linenumber AS k, 'Part ' || l_partkey AS name, p.is_active, p.unit, p.unit IS NOT NULL AS known FROM lineitem l
  LEFT JOIN (SELECT p_partkey, p_size % 2 = 0 AS is_active, CASE WHEN p_size > 25 THEN 'Box' ELSE 'Unit' END AS unit FROM part) p ON p_partkey = l_partkey
  WHERE (l_orderkey + l_linenumber) % 50 <> 0),
cells AS (SELECT *, CASE k % 5 WHEN 1 THEN 'Partial' WHEN 2 THEN 'Ordered' WHEN 3 THEN 'Cancelled' ELSE 'Received' END AS status,
    CASE k % 3 WHEN 0 THEN 'Pound' WHEN 1 THEN 'Kilogram' END AS order_unit, CASE WHEN k % 2 = 0 THEN 'Ounce' END AS burn_unit,
    CASE WHEN k % 4 > 1 THEN 'Lot ' || (l_partkey % 97) END AS lot, CASE WHEN k % 9 <> 0 THEN CAST(l_shipdate AS DATE) END AS arrived FROM sheet),
marked AS (SELECT *, CASE WHEN is_active THEN replace(lower(lot), ' ', '_') END AS lot_id FROM cells)"""


@register("etl_inventory_orders", SHEET_SQL + """
SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN known THEN name END AS item, name AS item_name,
  CASE WHEN s_suppkey IS NOT NULL AND s_suppkey % 5 <> 0 THEN 'Supplier ' || l_suppkey END AS vendor, status,
  coalesce(order_unit, unit, burn_unit, 'Unit') AS order_uom, coalesce(burn_unit, unit, order_unit, 'Unit') AS burn_uom,
  CAST(l_quantity AS DECIMAL(18,2)) AS order_quantity, nullif(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS total_cost
FROM marked LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def q_etl_inventory_orders(spark, d):
    t = Tables(spark, d)
    return purchase_orders(raw_orders(t), items(t), vendors(t))


@register("etl_inventory_lots", SHEET_SQL + """
SELECT lot_id, arg_min(name, (l_orderkey, l_linenumber, l_suppkey, l_partkey)) AS item, any_value(lot) AS lot_number
FROM marked WHERE lot_id IS NOT NULL GROUP BY lot_id""")
def q_etl_inventory_lots(spark, d):
    t = Tables(spark, d)
    return lots(raw_orders(t), items(t))


@register("etl_inventory_receipts", SHEET_SQL + """
SELECT l_orderkey, l_linenumber, l_suppkey, arrived AS received_date, lot_id, CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(18,2)) AS received_quantity,
  k % 3 = 0 AS acceptable
FROM marked WHERE status IN ('Received', 'Partial') AND arrived IS NOT NULL""")
def q_etl_inventory_receipts(spark, d):
    t = Tables(spark, d)
    return receipts(raw_orders(t), items(t))


@register("etl_inventory_onhand", SHEET_SQL + """,
loaded AS (SELECT DISTINCT lot_id, lot FROM marked WHERE lot_id IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_suppkey, name AS item, arrived AS onhand_date, coalesce(order_unit, unit) AS onhand_uom,
  CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(18,2)) AS onhand_quantity, loaded.lot_id
FROM marked m LEFT JOIN loaded ON loaded.lot = m.lot WHERE known AND arrived IS NOT NULL""")
def q_etl_inventory_onhand(spark, d):
    t = Tables(spark, d)
    raw, known = raw_orders(t), items(t)
    return on_hand(raw, known, lots(raw, known))
