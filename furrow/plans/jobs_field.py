"""Field and finance load jobs (§2.13) as operator compositions over raw
renderings of the given tables: sales orders, plant map and seed batches,
harvest and sessions, lettuce, fertigation, spraying, scouting, invoices
and expenses."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions import arith, codes
from furrow.operators import aggregates as agg
from furrow.operators import joins as jn
from furrow.operators import reshape as rs
from furrow.operators import rows, setops
from furrow.operators import windows as win
from furrow.plans.registry import register
from furrow.session import spread
from furrow.sources import sinks
from furrow.sources.tables import Tables


@register("etl_sales_orders", """
WITH h AS (SELECT o.o_orderdate::DATE AS po_date, o.o_custkey AS customer, l.l_orderkey AS po_number, COUNT(*) AS n_lines
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3),
s AS (SELECT l_orderkey AS po_number, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS any_f,
             min(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS all_n FROM lineitem GROUP BY 1)
SELECT h.*, CASE WHEN s.any_f = 1 THEN 'fulfilled' WHEN s.all_n = 1 THEN 'invoiced' ELSE 'open' END AS status FROM h JOIN s USING (po_number)""")
def q_etl_sales_orders(spark, d):
    t = Tables(spark, d)
    li, o = spread(t.lineitem, "l_orderkey"), t.orders
    lines = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderdate").cast("date").alias("po_date"), F.col("o_custkey").alias("customer"), F.col("l_orderkey").alias("po_number"),
        "l_linestatus", "l_returnflag")
    h = lines.groupBy("po_date", "customer", "po_number").agg(F.count(F.lit(1)).alias("n_lines"))
    st = agg.any_flag_status(lines, ["po_number"], {"fulfilled": F.col("l_linestatus") == "F"}, {"invoiced": F.col("l_returnflag") == "N"}, "open")
    return h.join(st, "po_number")


@register("etl_plant_map", """
WITH s AS (SELECT l_suppkey AS site, l_linestatus AS block, l_partkey AS rn, l_orderkey, l_linenumber,
                  lag(l_partkey) OVER (PARTITION BY l_suppkey, l_linestatus ORDER BY l_orderkey, l_linenumber, l_partkey) AS prev FROM lineitem
           WHERE l_returnflag <> 'R'),
g AS (SELECT site, block, min(rn) AS row_from, max(rn) AS row_to, SUM(CASE WHEN rn > prev THEN 1 ELSE 0 END) AS up,
             SUM(CASE WHEN rn < prev THEN 1 ELSE 0 END) AS down, min((l_orderkey, l_linenumber)) AS first_seen FROM s GROUP BY 1, 2)
SELECT site, block, CAST(dense_rank() OVER (PARTITION BY site ORDER BY first_seen) AS BIGINT) AS block_number, row_from, row_to,
       CASE WHEN up >= down THEN 'Forward' ELSE 'Reverse' END AS direction FROM g""")
def q_etl_plant_map(spark, d):
    li = Tables(spark, d).lineitem.where(F.col("l_returnflag") != "R").select(
        F.col("l_suppkey").alias("site"), F.col("l_linestatus").alias("block"), F.col("l_partkey").alias("rn"), "l_orderkey", "l_linenumber")
    out = agg.block_extent(li, "site", "block", ["l_orderkey", "l_linenumber", "rn"], "rn", ["l_orderkey", "l_linenumber"],
                           bucket=F.floor(F.col("l_orderkey") / 10_000))
    return out.withColumn("block_number", F.col("block_number").cast("long"))


@register("etl_seed_batches", """
WITH hist AS (SELECT DISTINCT upper(strftime(o_orderdate, '%y%m') || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') || o_orderstatus) AS code FROM orders),
fwd AS (SELECT DISTINCT upper(strftime(c, '%y%m') || lpad(CAST(p_size % 12 AS VARCHAR), 2, '0') || 'F') AS code FROM part,
        LATERAL (SELECT unnest(generate_series(CAST(DATE '2001-01-07' + ((p_size * 7) % 84) + CAST(ceil(greatest(datediff('day',
          DATE '2001-01-07' + ((p_size * 7) % 84), DATE '2001-06-01'), 0) / 84.0) AS INTEGER) * 84 AS TIMESTAMP), TIMESTAMP '2002-06-30',
          INTERVAL 84 DAY)) AS c))
SELECT code FROM hist UNION SELECT code FROM fwd""")
def q_etl_seed_batches(spark, d):
    t = Tables(spark, d)
    hist = t.orders.select(codes.cycle_code("o_orderdate", F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0"), "o_orderstatus").alias("code"))
    p = t.part.select("p_size", F.lit("2001-01-07").cast("date").alias("anchor"))
    cyc = rs.series_cycles(p, "anchor", "p_size", 84, "2001-06-01", "2002-06-30")
    fwd = cyc.select(codes.cycle_code("cycle_start", F.lpad((F.col("p_size") % 12).cast("string"), 2, "0"), F.lit("F")).alias("code"))
    return setops.union_keys(hist, fwd, ["code"])


@register("etl_harvest", """
WITH b AS (SELECT upper(strftime(o_orderdate, '%y%m') || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') || o_orderstatus) AS k, min(o_orderkey) AS v
           FROM orders GROUP BY 1),
h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             CASE WHEN l_linenumber % 2 = 0 THEN 'S-' ELSE '' END || upper(strftime(o_orderdate, '%y%m') || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0')
               || o_orderstatus) AS code, l_quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
j AS (SELECT h.*, COALESCE(b1.v, b2.v) AS batch_id FROM h LEFT JOIN b b1 ON upper(h.code) = b1.k
      LEFT JOIN b b2 ON regexp_replace(upper(h.code), '^S-', '') = b2.k)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, batch_id, l_quantity FROM j WHERE batch_id IS NOT NULL AND l_quantity > 1""")
def q_etl_harvest(spark, d):
    t = Tables(spark, d)
    li, o = t.lineitem, t.orders
    code = codes.cycle_code("o_orderdate", F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0"), "o_orderstatus")
    batches = o.select(code.alias("code"), "o_orderkey")
    h = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.concat(F.when(F.col("l_linenumber") % 2 == 0, F.lit("S-")).otherwise(F.lit("")), code).alias("code"))
    j = jn.strip_prefix_retry_join(h, "code", batches, "code", "o_orderkey", out="batch_id")
    kept, _ = rows.quarantine(j, [("no_batch", F.col("batch_id").isNull(), F.col("code")), ("empty_weight", F.col("l_quantity") <= 1, None)])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "batch_id", "l_quantity")


@register("etl_harvest_sessions", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, l_suppkey % 10 AS site,
                  CASE WHEN l_linenumber = 1 THEN l_orderkey END AS tracker FROM lineitem),
tr AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 10 AS site, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_tracker
       FROM orders GROUP BY 1, 2)
SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, COALESCE(s.tracker, tr.first_tracker) AS tracker
FROM s LEFT JOIN tr ON tr.day = s.day AND tr.site = s.site""")
def q_etl_harvest_sessions(spark, d):
    t = Tables(spark, d)
    s = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("day"),
                          (F.col("l_suppkey") % 10).alias("site"), F.when(F.col("l_linenumber") == 1, F.col("l_orderkey")).alias("tracker"))
    ev = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), (F.col("o_custkey") % 10).alias("site"), "o_orderdate", "o_orderkey")
    ev = ev.withColumn("start", F.struct("o_orderdate", "o_orderkey"))
    out = jn.earliest_link(s, ev, ["day", "site"], "start", "o_orderkey", "tracker")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "tracker")


@register("etl_lettuce", """
WITH s AS (SELECT o_orderkey, upper(strftime(o_orderdate, '%y%m') || 'P' || o_orderstatus) AS code, o_orderdate FROM orders)
SELECT o_orderkey, CASE WHEN rn > 1 THEN code || '_' || CAST(rn AS VARCHAR) ELSE code END AS code,
       CAST(o_orderdate AS DATE) + 14 AS transplant_date
FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY o_orderdate, o_orderkey) AS rn FROM s)""")
def q_etl_lettuce(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", "o_orderdate", F.upper(F.concat(F.date_format("o_orderdate", "yyMM"), F.lit("P"), F.col("o_orderstatus"))).alias("code"))
    x = win.dup_suffix_bucketed(o, "code", ["o_orderdate", "o_orderkey"], F.date_trunc("month", "o_orderdate"))
    return x.select("o_orderkey", "code", arith.default_dates(F.lit(None).cast("date"), F.col("o_orderdate").cast("date"), 14).alias("transplant_date"))


@register("etl_fertigation", """
WITH c AS (SELECT p_type AS recipe, p_brand AS farm, COUNT(*) AS n FROM part GROUP BY 1, 2)
SELECT recipe, arg_min(farm, (-n, farm)) AS farm FROM c GROUP BY 1""")
def q_etl_fertigation(spark, d):
    p = Tables(spark, d).part.select(F.col("p_type").alias("recipe"), F.col("p_brand").alias("farm"))
    return agg.mode_per_key(p, ["recipe"], "farm", default="Unknown")


@register("etl_spraying", """
WITH comp AS (SELECT p_brand AS product, arg_min(p_partkey, p_partkey) AS compliance_id FROM part GROUP BY 1),
ev AS (SELECT o_orderkey, 'Brand#' || CAST(o_custkey % 25 + 1 AS VARCHAR) AS product,
              CAST(o_totalprice AS DECIMAL(18,2)) / greatest(len(string_split(o_orderpriority, '-')), 1) AS water_share,
              unnest(string_split(o_orderpriority, '-')) AS sprayer FROM orders)
SELECT ev.o_orderkey, ev.sprayer, ev.water_share, comp.compliance_id FROM ev LEFT JOIN comp USING (product)""")
def q_etl_spraying(spark, d):
    t = Tables(spark, d)
    comp = win.keep_first(t.part.select(F.col("p_brand").alias("product"), F.col("p_partkey").alias("compliance_id")), ["product"], ["compliance_id"])
    ev = t.orders.select("o_orderkey", F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string")).alias("product"),
                         F.col("o_totalprice").cast("decimal(18,2)").alias("water"), F.split("o_orderpriority", "-").alias("sprayers"))
    x = rs.split_evenly(ev, "water", "sprayers", out="water_share", item="sprayer")
    return x.join(comp, "product", "left").select("o_orderkey", "sprayer", F.col("water_share").cast("double").alias("water_share"), "compliance_id")


@register("etl_spray_precheck", """
SELECT * FROM (
  SELECT o_orderkey, substr(sha256(concat_ws('|', 'Is the tank clean?')), 1, 32) AS question_id,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN true ELSE false END AS response_boolean FROM orders
  UNION ALL SELECT o_orderkey, substr(sha256(concat_ws('|', 'Nozzles checked?')), 1, 32),
         CASE WHEN o_orderpriority = '1-URGENT' THEN false ELSE true END FROM orders)""")
def q_etl_spray_precheck(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(F.col("o_orderstatus").isin("F", "O"), "Y").otherwise("N").alias("tank"),
                                       F.when(F.col("o_orderpriority") == "1-URGENT", "N").otherwise("Y").alias("nozzles"))
    qs = [("Is the tank clean?", "tank"), ("Nozzles checked?", "nozzles")]
    # deterministic question ids: the same hash surrogate_id computes for a one-part natural key
    import hashlib

    ids = {q: hashlib.sha256(q.encode()).hexdigest()[:32] for q, _ in qs}
    long = rs.unpivot_questions(o, ["o_orderkey"], [(ids[q], c, "boolean") for q, c in qs])
    return long.select("o_orderkey", "question_id", "response_boolean")


@register("etl_scouting", """
SELECT * FROM (
  SELECT o_orderkey AS tracker_id, 'pest' AS kind, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS finding FROM orders
  UNION ALL SELECT o_orderkey, 'disease', CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END FROM orders) WHERE finding IS NOT NULL""")
def q_etl_scouting(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("tracker_id"),
                                       F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("pest_finding"),
                                       F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("disease_finding"))
    return rs.unpivot_prefix_groups(o, ["tracker_id"], ["pest", "disease"], ["finding"], label="kind")


def invoice_docs(t: Tables) -> DataFrame:
    """orders with their line items as nested invoice documents (one document holds its own lines)."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("Id")).agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("LineNum"), F.col("l_extendedprice").cast("decimal(14,2)").alias("Amount"),
        F.struct(F.col("l_partkey").cast("string").alias("ItemRef"), F.col("l_quantity").cast("decimal(14,4)").alias("Qty")).alias("Detail"))).alias("Line"))
    head = t.orders.select(F.col("o_orderkey").alias("Id"), F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("DocNumber"),
                           F.col("o_orderdate").cast("date").alias("TxnDate"), F.col("o_custkey").cast("string").alias("CustomerRef"),
                           F.col("o_orderstatus").alias("Status"))
    return head.join(lines, "Id", "left")


def invoice_headers(docs: DataFrame) -> DataFrame:
    amounts = F.transform("Line", lambda x: x["Amount"])
    total = F.aggregate(amounts, F.lit(0).cast("decimal(24,2)"), lambda a, x: (a + F.coalesce(x, F.lit(0))).cast("decimal(24,2)"))
    return docs.select(F.col("Id").alias("invoice_id"), F.col("DocNumber").alias("doc_number"), F.col("TxnDate").alias("txn_date"),
                       F.col("CustomerRef").alias("customer_ref"), F.coalesce(F.size("Line"), F.lit(0)).alias("n_lines"),
                       F.coalesce(total, F.lit(0)).cast("decimal(24,2)").alias("total"))


def invoice_lines(docs: DataFrame) -> DataFrame:
    x = docs.select(F.col("Id").alias("invoice_id"), F.explode("Line").alias("l"))
    return x.select("invoice_id", F.col("l.LineNum").alias("line_num"), F.col("l.Detail.ItemRef").alias("item_ref"),
                    F.col("l.Detail.Qty").alias("qty"), F.col("l.Amount").alias("amount"))


@register("etl_invoices", """
SELECT o_orderkey AS invoice_id, 'D' || o_orderkey AS doc_number, CAST(o_orderdate AS DATE) AS txn_date, o_custkey::VARCHAR AS customer_ref,
       count(l_linenumber)::INTEGER AS n_lines, coalesce(sum(CAST(l_extendedprice AS DECIMAL(14,2))), 0)::DECIMAL(24,2) AS total
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def q_etl_invoices(spark, d):
    """Headers of the nested invoice documents."""
    return invoice_headers(invoice_docs(Tables(spark, d)))


@register("etl_invoice_lines", """
SELECT l_orderkey AS invoice_id, l_linenumber AS line_num, l_partkey::VARCHAR AS item_ref, CAST(l_quantity AS DECIMAL(14,4)) AS qty,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS amount FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def q_etl_invoice_lines(spark, d):
    return invoice_lines(invoice_docs(Tables(spark, d)))


@register("etl_invoice_reload", """
SELECT l_orderkey AS invoice_id, l_linenumber AS line_num, l_partkey::VARCHAR AS item_ref, CAST(l_quantity AS DECIMAL(14,4)) AS qty,
       CASE WHEN o_orderstatus = 'O' THEN -CAST(l_extendedprice AS DECIMAL(14,2)) ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS amount
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'O' OR l_linenumber <= 3""")
def q_etl_invoice_reload(spark, d):
    """A second load of the open invoices, corrected to their first three lines with the sign turned: their old lines go."""
    docs = invoice_docs(Tables(spark, d))
    fixed = F.transform(F.filter("Line", lambda x: x["LineNum"] <= 3), lambda x: x.withField("Amount", (-x["Amount"]).cast("decimal(14,2)")))
    again = docs.where("Status = 'O'").withColumn("Line", fixed)
    _, children = sinks.upsert_parent_replace_children(
        invoice_headers(docs), invoice_lines(docs), invoice_headers(again), invoice_lines(again), ["invoice_id"], ["invoice_id"])
    return children


def expense_docs(t: Tables) -> DataFrame:
    """Line items grouped as expense documents; a returned one is a credit."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("Id")).agg(
        F.max(F.col("l_returnflag") == "R").alias("Credit"),
        F.collect_list(F.struct(
            F.col("l_linenumber").alias("LineNum"), F.col("l_extendedprice").cast("decimal(14,2)").alias("Amount"),
            F.when(F.col("l_linestatus") == "F", F.struct(F.col("l_suppkey").cast("string").alias("AccountRef"))).alias("AccountDetail"),
            F.when(F.col("l_linestatus") != "F", F.struct(F.col("l_partkey").cast("string").alias("ItemRef"))).alias("ItemDetail"))).alias("Line"))


@register("etl_expenses", """
SELECT l_orderkey AS expense_id, l_linenumber AS line_num, CASE WHEN l_linestatus = 'F' THEN 'account' ELSE 'item' END AS detail_type,
       CASE WHEN l_linestatus = 'F' THEN l_suppkey::VARCHAR ELSE l_partkey::VARCHAR END AS ref,
       CASE WHEN bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) THEN -CAST(l_extendedprice AS DECIMAL(14,2)) ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS amount
FROM lineitem""")
def q_etl_expenses(spark, d):
    """Lines of the nested expense documents: account or item detail, credits with a negative sign."""
    x = expense_docs(Tables(spark, d)).select(F.col("Id").alias("expense_id"), "Credit", F.explode("Line").alias("l"))
    return x.select("expense_id", F.col("l.LineNum").alias("line_num"),
                    F.when(F.col("l.AccountDetail").isNotNull(), "account").otherwise("item").alias("detail_type"),
                    arith.coalesce_chain(F.col("l.AccountDetail.AccountRef"), F.col("l.ItemDetail.ItemRef")).alias("ref"),
                    codes.signed_amount(F.col("l.Amount"), F.col("Credit")).alias("amount"))
