"""Sources and sinks (§2.1, §2.2) exercised on files that Spark derives
from the given tables: sheet tabs landed as CSV (drifting headers),
nested invoice documents and sensor measurements landed as JSON, and
tables written with append / scoped-overwrite semantics. Every file goes
to a fresh folder under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.operators import reshape as rs
from furrow.plans.registry import register
from furrow.session import scratch_path
from furrow.sources import readers, sinks
from furrow.sources.tables import TABLE_NAMES, Tables, table_path


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, f"landing/{name}-{uuid.uuid4().hex[:10]}")


def _land_orders_tab(spark, d, path, where=None):
    """orders as a spreadsheet tab: text cells, drifting header spellings."""
    o = Tables(spark, d).orders
    if where is not None:
        o = o.where(where)
    tab = o.select(F.col("o_orderkey").cast("string").alias("Order Key "), F.col("o_custkey").cast("string").alias("CustKey"),
                   F.col("o_orderpriority").alias(" Priority"), F.col("o_orderstatus").alias("Status"),
                   F.date_format("o_orderdate", "M/d/yyyy").alias("Order Date"),
                   F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Total"))
    tab.write.mode("overwrite").option("header", True).csv(path)


SHEET_COLUMNS = {"order_key": ["Order Key", "OrderKey"], "cust_key": ["Cust Key", "CustKey"], "priority": ["Priority"],
                 "status": ["Status"], "order_date": ["Order Date"], "total": ["Total"]}


@register("scan_sheet", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS cust_key, o_orderpriority AS priority, o_orderstatus AS status,
       strftime(o_orderdate, '%-m/%-d/%Y') AS order_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total FROM orders""")
def q_scan_sheet(spark, d):
    path = _run_dir(spark, "sheet")
    _land_orders_tab(spark, d, path)
    return readers.scan_sheet(spark, path, SHEET_COLUMNS)


@register("scan_csv_export", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status FROM orders""")
def q_scan_csv_export(spark, d):
    path = _run_dir(spark, "csv")
    _land_orders_tab(spark, d, path)
    return readers.scan_csv_export(spark, path, {"order_key": ["Order Key"], "status": ["Status"]})


@register("scan_unformatted", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS total FROM orders""")
def q_scan_unformatted(spark, d):
    path = _run_dir(spark, "unformatted")
    _land_orders_tab(spark, d, path)
    return readers.scan_unformatted(spark, path, ["total"], {"order_key": ["Order Key"], "total": ["Total"]})


@register("scan_tabs_union", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status, 'tab_' || CAST(year(o_orderdate) AS VARCHAR) AS tab
FROM orders""")
def q_scan_tabs_union(spark, d):
    base = _run_dir(spark, "tabs")
    paths = []
    first, last = Tables(spark, d).orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    for y in range(first, last + 1):  # a tab per year
        p = f"{base}/tab_{y}"
        _land_orders_tab(spark, d, p, F.year("o_orderdate") == y)
        paths.append(p)
    u = readers.scan_tabs_union(spark, paths, columns={"order_key": ["Order Key"], "status": ["Status"]})
    return u.select("order_key", "status", F.regexp_extract("_source", r"(tab_\d+)$", 1).alias("tab"))


INVOICE_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("DocNumber", T.StringType()), T.StructField("TxnDate", T.DateType()),
    T.StructField("CustomerRef", T.StructType([T.StructField("value", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("Line", T.ArrayType(T.StructType([
        T.StructField("LineNum", T.IntegerType()), T.StructField("Amount", T.DecimalType(14, 2)),
        T.StructField("SalesItemLineDetail", T.StructType([T.StructField("ItemRef", T.StructType([T.StructField("name", T.StringType())])),
                                                           T.StructField("Qty", T.DecimalType(14, 4))]))]))),
])


@register("scan_json_docs", """
SELECT o.o_orderkey AS invoice_id, CAST(o.o_orderdate AS DATE) AS txn_date, l.l_linenumber AS line_num, CAST(l.l_partkey AS VARCHAR) AS item_name,
       CAST(l.l_quantity AS DECIMAL(14,4)) AS qty, CAST(l.l_extendedprice AS DECIMAL(14,2)) AS amount
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE CAST(o.o_orderdate AS DATE) >= DATE '1999-01-01'""")
def q_scan_json_docs(spark, d):
    t = Tables(spark, d)
    path = _run_dir(spark, "invoices")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("LineNum"), F.col("l_extendedprice").cast("decimal(14,2)").alias("Amount"),
        F.struct(F.struct(F.col("l_partkey").cast("string").alias("name")).alias("ItemRef"),
                 F.col("l_quantity").cast("decimal(14,4)").alias("Qty")).alias("SalesItemLineDetail"))).alias("Line"))
    o = t.orders
    docs = o.join(lines, o.o_orderkey == lines.l_orderkey, "inner").select(
        F.col("o_orderkey").alias("Id"), F.col("o_orderkey").cast("string").alias("DocNumber"), F.col("o_orderdate").cast("date").alias("TxnDate"),
        F.struct(F.col("o_custkey").cast("string").alias("value"), F.lit("c").alias("name")).alias("CustomerRef"), "Line")
    docs.write.mode("overwrite").json(path)
    inv = readers.scan_json_docs(spark, path, INVOICE_SCHEMA, "TxnDate", "1999-01-01")
    inv = inv.select(F.col("Id").alias("invoice_id"), F.col("TxnDate").alias("txn_date"), "Line")
    return rs.explode_docs(inv, "Line", ["invoice_id", "txn_date"], {
        "line_num": F.col("l.LineNum"), "item_name": F.col("l.SalesItemLineDetail.ItemRef.name"),
        "qty": F.col("l.SalesItemLineDetail.Qty"), "amount": F.col("l.Amount")})


MEASUREMENT_SCHEMA = T.StructType([
    T.StructField("device_id", T.StructType([T.StructField("id", T.LongType())])), T.StructField("channel_index", T.IntegerType()),
    T.StructField("timestamp", T.StringType()), T.StructField("value", T.DoubleType())])


@register("scan_measurements", """
SELECT user_id AS device, event_id AS channel, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""")
def q_scan_measurements(spark, d):
    ev = Tables(spark, d).events
    path = _run_dir(spark, "measurements")
    ev.select(F.struct(F.col("user_id").alias("id")).alias("device_id"), F.col("event_id").cast("int").alias("channel_index"),
              F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "value").write.mode("overwrite").json(path)
    m = readers.scan_measurements(spark, path, MEASUREMENT_SCHEMA, start="2024-01-05 00:00:00", end="2024-01-20 00:00:00")
    return m.select(F.col("device_id.id").alias("device"), F.col("channel_index").cast("long").alias("channel"),
                    F.to_timestamp("timestamp").cast("timestamp_ntz").alias("ts"), "value")


# Priority labels of a hand-listed dimension.
PRIORITY_LABELS = [("1-URGENT", "Urgent", 1), ("2-HIGH", "High", 2), ("3-MEDIUM", "Medium", 3), ("4-NOT SPECIFIED", "Unspecified", 4),
                   ("5-LOW", "Low", 5)]


@register("static_dim", """
SELECT o.o_orderkey, v.label, v.rank FROM orders o LEFT JOIN (VALUES ('1-URGENT', 'Urgent', 1), ('2-HIGH', 'High', 2), ('3-MEDIUM', 'Medium', 3),
  ('4-NOT SPECIFIED', 'Unspecified', 4), ('5-LOW', 'Low', 5)) v(code, label, rank) ON v.code = o.o_orderpriority""")
def q_static_dim(spark, d):
    dim = readers.static_dim(spark, PRIORITY_LABELS, "code string, label string, rank int")
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_orderpriority").alias("code"))
    return o.join(dim, "code", "left").select("o_orderkey", "label", "rank")


_SPARK_TYPES_SQL = ("CASE lower(data_type) WHEN 'integer' THEN 'int' WHEN 'varchar' THEN 'string' WHEN 'timestamp' THEN 'timestamp_ntz' "
                    "WHEN 'float[]' THEN 'array<float>' ELSE lower(data_type) END")


@register("catalog_columns", f"""
SELECT table_name, column_name, {_SPARK_TYPES_SQL} AS data_type FROM information_schema.columns
WHERE table_name IN ({", ".join("'" + t + "'" for t in TABLE_NAMES)})""")
def q_catalog_columns(spark, d):
    db = f"furrow_{uuid.uuid4().hex[:8]}"
    # the database folder lives in the shared checkpoint folder, not in the
    # driver's working directory (the default warehouse location)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{_run_dir(spark, 'catalog')}'")
    for t in TABLE_NAMES:
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{t} AS SELECT * FROM parquet.`{table_path(d, t)}`")
    return readers.catalog_columns(spark, db).select("table_name", "column_name", "data_type")


@register("write_append", """
SELECT o_orderkey, o_orderstatus FROM orders""")
def q_write_append(spark, d):
    """Finished orders first, all others appended."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    path = _run_dir(spark, "append")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    sinks.write_append(o.where(finished), path)
    sinks.write_append(o.where(~finished), path)
    return spark.read.parquet(path)


@register("write_full_refresh", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN lower(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders""")
def q_write_full_refresh(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    path = _run_dir(spark, "refresh")
    sinks.write_full_refresh(o, path, ["o_orderstatus"])
    # reload only the 'F' scope; the other scopes stay as written
    sinks.write_full_refresh(o.where(F.col("o_orderstatus") == "F").withColumn("o_orderpriority", F.lower("o_orderpriority")), path, ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@register("write_scoped_replace", """
SELECT c.c_custkey, CASE WHEN n.n_regionkey = 2 THEN upper(c.c_mktsegment) || '!' ELSE c.c_mktsegment END AS c_mktsegment, n.n_regionkey AS org_id
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_write_scoped_replace(spark, d):
    t = Tables(spark, d)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", F.col("n_regionkey").alias("org_id"))
    path = _run_dir(spark, "scoped")
    sinks.write_scoped_replace(c, path, "org_id")
    sinks.write_scoped_replace(c.where(F.col("org_id") == 2).withColumn("c_mktsegment", F.concat(F.upper("c_mktsegment"), F.lit("!"))), path, "org_id")
    return spark.read.parquet(path).select("c_custkey", "c_mktsegment", "org_id")


@register("export_summary", """
SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, o_orderpriority AS priority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total FROM orders""")
def q_export_summary(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("invoice_id"), F.col("o_orderpriority").alias("priority"),
                                       F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    path = _run_dir(spark, "export")
    sinks.export_summary(o, path)
    return spark.read.option("header", True).csv(path)


@register("trim_headers", """
SELECT CAST(o_orderkey AS VARCHAR) AS "Order Key", o_orderpriority AS "Priority" FROM orders""")
def q_trim_headers(spark, d):
    path = _run_dir(spark, "headers")
    _land_orders_tab(spark, d, path)
    raw = spark.read.option("header", True).csv(path)
    return readers.trim_headers(raw).select("`Order Key`", "Priority")
