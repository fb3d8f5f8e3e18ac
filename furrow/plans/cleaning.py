"""Cleaning scalars (§2.3) bound to the given tables.

Messy spreadsheet cells are produced deterministically from real columns
of ``orders`` (dates re-rendered in mixed layouts, numbers with thousands
separators, blank / junk cells, delimited lists ...), identically in
Spark and in the oracle SQL; each query then applies one cleaning
function to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import arith, codes, lists, parse, text
from furrow.plans.registry import register
from furrow.session import spread
from furrow.sources.tables import Tables


def dirty_orders(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    ts = (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int"))).cast("timestamp_ntz")
    return o.select(
        k.alias("k"), "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice",
        F.when(k % 7 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("txt"),
        F.when(k % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy")).when(k % 3 == 1, F.date_format("o_orderdate", "M/d/yy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dstr"),
        F.when(k % 4 == 0, F.date_format(ts, "M/d/yyyy H:mm:ss")).when(k % 4 == 1, F.date_format(ts, "M/d/yyyy"))
        .when(k % 4 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("n/a")).alias("tsstr"),
        F.when(k % 2 == 0, F.date_format(ts, "H:mm:ss")).otherwise(F.date_format(ts, "H:mm")).alias("tstr"),
        F.format_number("o_totalprice", 2).alias("num"),
        F.concat((k % 100).cast("string"), F.lit("%")).alias("pct"),
        F.when(k % 5 == 0, "yes").when(k % 5 == 1, "TRUE").when(k % 5 == 2, "0").when(k % 5 == 3, "").otherwise("maybe").alias("flag"),
        F.when(k % 11 == 0, F.lit("N/A")).otherwise(F.concat((k % 30).cast("string"), F.lit(" "), (k % 7 + 1).cast("string"), F.lit("/8"))).alias("frac"),
        F.concat(F.date_format("o_orderdate", "M/d/yyyy"), F.lit(" - "), F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 13), "M/d/yyyy")).alias("period"),
        F.when(k % 3 == 0, F.lit("nobody")).otherwise(F.concat(F.lit("pat.lee-"), F.col("o_custkey").cast("string"), F.lit("@farm.example"))).alias("email"),
        F.concat_ws(" + ", F.col("o_orderpriority"), F.col("o_orderstatus"), F.when(k % 2 == 0, F.col("o_orderstatus"))).alias("lst"),
    )


DIRTY_SQL = """
WITH d AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
    CASE WHEN o_orderkey % 7 = 0 THEN '   ' ELSE '  ' || o_orderpriority || ' ' END AS txt,
    CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dstr,
    CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%-m/%-d/%Y %-H:%M:%S')
         WHEN 1 THEN strftime(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%-m/%-d/%Y')
         WHEN 2 THEN strftime(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%Y-%m-%d %H:%M:%S') ELSE 'n/a' END AS tsstr,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%-H:%M:%S')
         ELSE strftime(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%-H:%M') END AS tstr,
    format('{:,.2f}', o_totalprice) AS num,
    CAST(o_orderkey % 100 AS VARCHAR) || '%' AS pct,
    CASE o_orderkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'TRUE' WHEN 2 THEN '0' WHEN 3 THEN '' ELSE 'maybe' END AS flag,
    CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE CAST(o_orderkey % 30 AS VARCHAR) || ' ' || CAST(o_orderkey % 7 + 1 AS VARCHAR) || '/8' END AS frac,
    strftime(o_orderdate, '%-m/%-d/%Y') || ' - ' || strftime(CAST(o_orderdate AS DATE) + 13, '%-m/%-d/%Y') AS period,
    CASE WHEN o_orderkey % 3 = 0 THEN 'nobody' ELSE 'pat.lee-' || CAST(o_custkey AS VARCHAR) || '@farm.example' END AS email,
    concat_ws(' + ', o_orderpriority, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) AS lst
  FROM orders)
"""

# SQL form of the date cascade: the layout regex guards mirror the Spark
# parser (a four-digit-year layout never accepts two digits).
PARSE_DATE_SQL = """CASE WHEN regexp_matches(trim({c}), '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime(trim({c}), '%m/%d/%Y') AS DATE)
  WHEN regexp_matches(trim({c}), '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}$') THEN CAST(try_strptime(trim({c}), '%m/%d/%y') AS DATE)
  WHEN regexp_matches(trim({c}), '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN CAST(try_strptime(trim({c}), '%Y-%m-%d') AS DATE) END"""


def flat_spark(df, c: str = "v", shape: str | None = None):
    """Scalar-only output for the oracle compare: struct fields become
    columns, arrays become '|'-joined text."""
    if shape == "struct":
        return df.select(*[x for x in df.columns if x != c], f"{c}.*")
    if shape == "array":
        return df.withColumn(c, F.array_join(F.transform(F.col(c), lambda e: e.cast("string")), "|"))
    return df


def flat_sql(sql: str, keys: str = "k", c: str = "v", shape: str | None = None) -> str:
    if shape == "struct":
        return f"SELECT {keys}, {c}.* FROM ({sql})"
    if shape == "array":
        return f"SELECT {keys}, array_to_string(list_transform({c}, lambda e: CAST(e AS VARCHAR)), '|') AS {c} FROM ({sql})"
    return sql


def _reg(name: str, sql_expr: str, spark_fn, out: str = "v", shape: str | None = None):
    sql = flat_sql(DIRTY_SQL + f"SELECT k, {sql_expr} AS {out} FROM d", "k", out, shape)

    def q(spark, d):
        x = dirty_orders(Tables(spark, d))
        return flat_spark(x.select("k", spark_fn(x).alias(out)), out, shape)

    register(name, sql)(q)


_reg("clean_text", "NULLIF(trim(txt), '')", lambda x: text.clean_text("txt"))
_reg("slug", "trim(regexp_replace(lower(trim(o_orderpriority || ' ' || o_orderstatus)), '[^a-z0-9_]+', '_', 'g'), '_')",
     lambda x: text.slug(F.concat_ws(" ", "o_orderpriority", "o_orderstatus")))
_reg("parse_date_multi", PARSE_DATE_SQL.format(c="dstr"), lambda x: parse.parse_date_multi("dstr"))
_reg("parse_ts_multi", """CASE WHEN regexp_matches(tsstr, '^\\d{1,2}/\\d{1,2}/\\d{4} \\d{1,2}:\\d{1,2}:\\d{1,2}$') THEN try_strptime(tsstr, '%m/%d/%Y %H:%M:%S')
  WHEN regexp_matches(tsstr, '^\\d{4}-\\d{1,2}-\\d{1,2} \\d{1,2}:\\d{1,2}:\\d{1,2}$') THEN try_strptime(tsstr, '%Y-%m-%d %H:%M:%S')
  WHEN regexp_matches(tsstr, '^\\d{1,2}/\\d{1,2}/\\d{4}$') THEN try_strptime(tsstr, '%m/%d/%Y') + INTERVAL 12 HOUR END""",
     lambda x: parse.parse_ts_multi("tsstr", date_only_hour=12))
_reg("parse_time_multi", "strftime(CASE WHEN regexp_matches(tstr, '^\\d{1,2}:\\d{1,2}:\\d{1,2}$') THEN try_strptime('1970-01-01 ' || tstr, "
     "'%Y-%m-%d %H:%M:%S') WHEN regexp_matches(tstr, '^\\d{1,2}:\\d{1,2}$') THEN try_strptime('1970-01-01 ' || tstr, '%Y-%m-%d %H:%M') END, '%H:%M:%S')", lambda x: parse.parse_time_multi("tstr"))
_reg("combine_date_time", "CAST(o_orderdate AS DATE) + CAST(COALESCE(CASE WHEN k % 3 <> 0 THEN strftime(o_orderdate + to_hours(k % 24), '%H:%M:%S') END, "
     "'07:00:00') AS TIME)",
     lambda x: parse.combine_date_time(F.col("o_orderdate").cast("date"),
                                       F.when(F.col("k") % 3 != 0, F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("k") % 24).cast("int")),
                                                                                 "HH:mm:ss")), default="07:00:00"))
register("split_period", flat_sql(DIRTY_SQL + "SELECT k, {'start': " + PARSE_DATE_SQL.format(c="split_part(period, ' - ', 1)") + ", 'end': "
         + PARSE_DATE_SQL.format(c="split_part(period, ' - ', 2)") + ", 'check_date': " + PARSE_DATE_SQL.format(c="split_part(period, ' - ', 2)")
         + "} AS v FROM d", shape="struct"))(
    lambda spark, d: flat_spark(parse.with_split_period(dirty_orders(Tables(spark, d)), "period", out="v").select("k", "v"), shape="struct"))
_reg("parse_number", "TRY_CAST(NULLIF(replace(trim(num), ',', ''), '') AS DOUBLE)", lambda x: parse.parse_number("num"))
_reg("parse_int_trunc", "CAST(trunc(TRY_CAST(replace(num, ',', '') AS DOUBLE)) AS BIGINT)", lambda x: parse.parse_int_trunc(F.regexp_replace("num", ",", "")))
_reg("percent_to_ratio", "ROUND(TRY_CAST(replace(replace(pct, ',', ''), '%', '') AS DOUBLE) / 100.0, 4)", lambda x: parse.percent_to_ratio("pct"))
_reg("parse_bool", "COALESCE(upper(trim(flag)) IN ('TRUE', 'YES', '1'), false)", lambda x: parse.parse_bool("flag"))
_reg("parse_bool3", "CASE WHEN upper(trim(flag)) IN ('TRUE', 'YES', '1') THEN true WHEN upper(trim(flag)) IN ('FALSE', 'NO', '0') THEN false END",
     lambda x: parse.parse_bool3("flag"))
_reg("parse_positive", "CASE WHEN trim(flag) = '' OR flag IS NULL THEN NULL ELSE lower(trim(flag)) IN ('true', 'positive', 'detected') END",
     lambda x: parse.parse_positive("flag"))
_reg("parse_mixed_fraction", "CASE WHEN frac IS NULL OR trim(frac) = '' OR upper(trim(frac)) = 'N/A' OR NOT regexp_matches(frac, '\\d') THEN NULL "
     "ELSE ROUND(list_reduce(list_transform(string_split(trim(frac), ' '), lambda p: CASE WHEN contains(p, '/') "
     "THEN TRY_CAST(split_part(p, '/', 1) AS DOUBLE) / TRY_CAST(split_part(p, '/', 2) AS DOUBLE) ELSE TRY_CAST(p AS DOUBLE) END), lambda a, b: a + b), 4) END",
     lambda x: parse.parse_mixed_fraction("frac"))
_reg("zero_pad", "CASE WHEN length(CAST(k % 12 AS VARCHAR)) < 2 THEN lpad(CAST(k % 12 AS VARCHAR), 2, '0') ELSE CAST(k % 12 AS VARCHAR) END",
     lambda x: codes.zero_pad((F.col("k") % 12).cast("string"), 2))
_reg("normalize_site_code", "(SELECT CASE WHEN regexp_matches(s, '^\\d+$') AND length(s) < 2 THEN lpad(s, 2, '0') ELSE s END FROM (SELECT "
     "trim(COALESCE(CASE lower(trim(r)) WHEN 'hi' THEN 'hilo' END, lower(trim(r)))) AS s FROM (SELECT CASE WHEN k % 4 = 0 THEN ' HI ' "
     "ELSE CAST(k % 15 AS VARCHAR) END AS r)))",
     lambda x: codes.normalize_site_code(F.when(F.col("k") % 4 == 0, F.lit(" HI ")).otherwise((F.col("k") % 15).cast("string")), {"hi": "hilo"}))
_reg("compose_key", "lower(o_orderstatus) || '_' || CAST(o_custkey AS VARCHAR) || '_trap_' || CAST(k % 9 AS VARCHAR)",
     lambda x: codes.compose_key("{farm}_{site}_trap_{n}", farm=F.lower("o_orderstatus"), site="o_custkey", n=F.col("k") % 9))
_reg("split_pair_cell", "{'primary': CASE WHEN lower(trim(o_orderpriority || '/' || o_orderstatus)) = 'mixed' THEN '' "
     "ELSE trim(split_part(trim(o_orderpriority || '/' || o_orderstatus), '/', 1)) END, 'secondary': trim(split_part(trim(o_orderpriority || '/' || o_orderstatus), '/', -1))}",
     lambda x: codes.split_pair_cell(F.concat_ws("/", "o_orderpriority", "o_orderstatus")), shape="struct")
_reg("offset_key", "CASE WHEN o_orderstatus = 'P' THEN k + 100000 ELSE k END", lambda x: codes.offset_key("k", F.col("o_orderstatus") == "P", 100000))
_reg("map_values", "COALESCE(CASE lower(trim(o_orderstatus)) WHEN 'f' THEN 'Fulfilled' WHEN 'o' THEN 'Open' END, 'Other')",
     lambda x: codes.map_values("o_orderstatus", {"F": "Fulfilled", "O": "Open"}, miss="other"))
_reg("whitelist_or_null", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END",
     lambda x: codes.whitelist_or_null("o_orderpriority", ["1-URGENT", "2-HIGH"]))
_reg("user_or_default", "CASE WHEN contains(trim(email), '@') THEN trim(email) ELSE 'system@farm.example' END",
     lambda x: codes.user_or_default("email", "system@farm.example"))
_reg("prefix_classify", "CASE WHEN starts_with(o_orderpriority, '1') THEN 'urgent' WHEN contains(o_orderpriority, 'HIGH') THEN 'high' "
     "WHEN regexp_matches(o_orderpriority, 'LOW$') THEN 'low' ELSE 'normal' END",
     lambda x: codes.prefix_classify("o_orderpriority", [("startswith", "1", "urgent"), ("contains", "HIGH", "high"), ("rlike", "LOW$", "low")], "normal"))
_reg("name_from_email", "{'first_name': upper(substr(split_part(lower(trim(email)), '@', 1), 1, 1)) || "
     "lower(substr(regexp_split_to_array(split_part(lower(trim(email)), '@', 1), '[._\\-]+')[1], 2)), "
     "'last_name': CASE WHEN len(regexp_split_to_array(split_part(lower(trim(email)), '@', 1), '[._\\-]+')) > 1 THEN "
     "upper(substr(regexp_split_to_array(split_part(lower(trim(email)), '@', 1), '[._\\-]+')[-1], 1, 1)) || "
     "lower(substr(regexp_split_to_array(split_part(lower(trim(email)), '@', 1), '[._\\-]+')[-1], 2)) ELSE '' END}",
     lambda x: text.name_from_email("email"), shape="struct")
_reg("split_list", "(SELECT list_filter(l, lambda x, i: list_position(l, x) = i) FROM (SELECT list_filter(list_transform("
     "regexp_split_to_array(lst, '[+;&,]'), lambda x: trim(x)), lambda x: x <> '') AS l))",
     lambda x: lists.split_list("lst", dedupe=True), shape="array")
_reg("join_labelled_notes", "NULLIF(concat_ws(' | ', CASE WHEN NOT COALESCE(upper(trim(o_orderpriority)) IN ('', 'N/A'), true) "
     "THEN 'Priority: ' || trim(o_orderpriority) END, CASE WHEN NOT COALESCE(upper(trim(o_orderstatus)) IN ('', 'N/A'), true) "
     "THEN 'Status: ' || trim(o_orderstatus) END), '')",
     lambda x: lists.join_labelled_notes([("Priority", "o_orderpriority"), ("Status", "o_orderstatus")]))
_reg("concat_paragraphs", "NULLIF(concat_ws(chr(10) || chr(10), CASE WHEN NOT COALESCE(upper(trim(frac)) IN ('', 'N/A'), true) THEN trim(frac) END, "
     "CASE WHEN NOT COALESCE(upper(trim(flag)) IN ('', 'N/A'), true) THEN trim(flag) END), '')",
     lambda x: lists.concat_paragraphs(["frac", "flag"]))
_reg("collect_nonblank", "list_filter([CASE WHEN NOT COALESCE(upper(trim(frac)) IN ('', 'N/A'), true) THEN trim(frac) END, "
     "CASE WHEN NOT COALESCE(upper(trim(flag)) IN ('', 'N/A'), true) THEN trim(flag) END], lambda x: x IS NOT NULL)",
     lambda x: lists.collect_nonblank(["frac", "flag"]), shape="array")
_reg("carry_unmatched", "CASE WHEN (CASE WHEN o_orderstatus = 'F' THEN 1 END) IS NULL AND o_orderpriority IS NOT NULL THEN "
     "CASE WHEN COALESCE(trim(NULLIF(flag, '')), '') = '' THEN '[' || o_orderpriority || ']' ELSE '[' || o_orderpriority || '] ' || NULLIF(flag, '') END "
     "ELSE NULLIF(flag, '') END",
     lambda x: lists.carry_unmatched("o_orderpriority", F.when(F.col("o_orderstatus") == "F", F.lit(1)), F.when(F.col("flag") != "", F.col("flag"))))
_reg("default_dates", "COALESCE(CASE WHEN k % 2 = 0 THEN CAST(o_orderdate AS DATE) + 3 END, CAST(o_orderdate AS DATE) + 14)",
     lambda x: arith.default_dates(F.when(F.col("k") % 2 == 0, F.date_add(F.col("o_orderdate").cast("date"), 3)), F.col("o_orderdate").cast("date"), 14))
_reg("age_days", "datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')",
     lambda x: arith.age_days(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")))
_reg("bulk_weight", "CASE WHEN (k % 10) <> 0 AND (k % 7) <> 0 THEN ROUND(CAST(k % 10 AS DOUBLE) * (k % 7) * 2.5, 2) END",
     lambda x: arith.bulk_weight((F.col("k") % 10).cast("double"), F.col("k") % 7, F.lit(2.5)))
_reg("reorder_point", "ROUND(CAST(k % 40 AS DOUBLE) * (2 + COALESCE(CASE WHEN k % 3 > 0 THEN k % 3 END, 0)) * 1.0, 2)",
     lambda x: arith.reorder_point((F.col("k") % 40).cast("double"), F.lit(2), F.when(F.col("k") % 3 > 0, F.col("k") % 3)))
_reg("safe_ratio", "CASE WHEN k % 5 > 0 THEN CAST(k % 13 AS DOUBLE) / (k % 5) END",
     lambda x: arith.safe_ratio((F.col("k") % 13).cast("double"), F.col("k") % 5))
_reg("clamp_nonneg", "CASE WHEN k % 9 IS NOT NULL THEN greatest(k % 9 - COALESCE(k % 5, 0), 0) END", lambda x: arith.clamp_nonneg(F.col("k") % 9, F.col("k") % 5))
_reg("coalesce_chain", "COALESCE(CASE WHEN k % 3 = 0 THEN 'scheduled' END, CASE WHEN k % 3 = 1 THEN 'mix' END, 'completed')",
     lambda x: arith.coalesce_chain(F.when(F.col("k") % 3 == 0, F.lit("scheduled")), F.when(F.col("k") % 3 == 1, F.lit("mix")), F.lit("completed")))
_reg("generated_average", "(CAST(k % 5 AS DOUBLE) + (k % 4) + (k % 3) + (k % 2)) / 4", lambda x: arith.generated_average(
    (F.col("k") % 5).cast("double"), F.col("k") % 4, F.col("k") % 3, F.col("k") % 2))
_reg("elapsed_hours", "(epoch(o_orderdate + to_minutes(k % 600)) - epoch(o_orderdate)) / 3600.0",
     lambda x: arith.elapsed_hours(F.col("o_orderdate"), F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("k") % 600).cast("int"))))
_reg("signed_amount", "CASE WHEN o_orderstatus = 'F' THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END",
     lambda x: codes.signed_amount(F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderstatus") == "F"))
_reg("lot_code", "strftime(o_orderdate, '%Y%m%d') || '-' || strftime(CAST(o_orderdate AS DATE) - 2, '%Y%m%d')",
     lambda x: codes.lot_code(F.col("o_orderdate"), F.date_sub(F.col("o_orderdate").cast("date"), 2)))
_reg("cycle_code", "upper(strftime(o_orderdate, '%y%m') || lpad(CAST(k % 12 AS VARCHAR), 2, '0') || o_orderstatus)",
     lambda x: codes.cycle_code(F.col("o_orderdate"), F.lpad((F.col("k") % 12).cast("string"), 2, "0"), F.col("o_orderstatus")))
_reg("display_name_case", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent' WHEN o_orderpriority = '5-LOW' THEN 'Low' ELSE upper(o_orderpriority) END",
     lambda x: text.display_name_case("o_orderpriority", {"1-URGENT": "Urgent", "5-LOW": "Low"}))
_reg("display_full_name", "COALESCE(CASE WHEN trim(CASE WHEN k % 4 = 0 THEN 'Pat' ELSE ' ' END) <> '' THEN trim(CASE WHEN k % 4 = 0 THEN 'Pat' ELSE ' ' END) END, "
     "trim(o_orderstatus || ' ' || o_orderpriority))",
     lambda x: text.display_full_name(F.when(F.col("k") % 4 == 0, F.lit("Pat")).otherwise(F.lit(" ")), "o_orderstatus", "o_orderpriority"))
_reg("normalize_match_name", "trim(regexp_replace(regexp_replace(regexp_replace(lower(trim('GH - ' || o_orderpriority || ' # ' || o_orderstatus)), "
     "'^(ph|gh)\\s*-\\s*', ''), '\\s*#\\s*', '#', 'g'), '\\s+', ' ', 'g'))",
     lambda x: text.normalize_match_name(F.concat(F.lit("GH - "), F.col("o_orderpriority"), F.lit(" # "), F.col("o_orderstatus"))))
_reg("normalize_ts_key", "date_trunc('second', o_orderdate + to_hours(k % 24) + to_microseconds(k * 1000))",
     lambda x: codes.normalize_ts_key(F.concat(F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("k") % 24).cast("int"), F.lit(0),
                                                                                                      (F.col("k") * 1000 / 1e6)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))))
_reg("utc_to_local_ntz", "o_orderdate - INTERVAL 10 HOUR", lambda x: arith.utc_to_local_ntz("o_orderdate"))


_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def proper_case_sql(value: str) -> str:
    """Display-name casing of a SQL text value by DuckDB list functions."""
    alnum = "regexp_replace(w, '[^\\p{L}\\p{N}]', '', 'g')"
    acronyms = ", ".join(f"'{a}'" for a in text.ACRONYMS)
    stops = ", ".join(f"'{a}'" for a in text.STOP_WORDS)
    lead = "length(regexp_extract(lower(x), '^\\P{L}*'))"
    cap = f"substr(lower(x), 1, {lead}) || upper(substr(lower(x), {lead} + 1, 1)) || substr(lower(x), {lead} + 2)"
    name = f"array_to_string(list_transform(string_split(w, chr(39)), lambda x, j: CASE WHEN j > 1 AND length(x) < 2 THEN lower(x) ELSE {cap} END), chr(39))"
    clean = f"regexp_replace({_STRIP.format(value)}, '\\s+', ' ', 'g')"
    words = f"regexp_extract_all({clean}, '[\\s\\-/,]+|[^\\s\\-/,]+')"
    first = f"list_position(list_transform({words}, lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]')), true)"
    return f"""array_to_string(list_transform({words}, lambda w, i: CASE WHEN {alnum} = '' THEN w WHEN upper({alnum}) IN ({acronyms}) THEN upper(w)
  WHEN regexp_matches(w, '\\p{{N}}') AND regexp_matches(w, '\\p{{L}}') AND len(regexp_extract_all(w, '\\p{{Lu}}')) > 1 THEN w
  WHEN lower({alnum}) IN ({stops}) AND i <> {first} THEN lower(w) ELSE {name} END), '')"""


@register("title_case", """
WITH s AS (SELECT p_partkey, regexp_replace(chr(9) || concat_ws('-', p_name, lower(p_type)) || ' ', '^\\s+|\\s+$', '', 'g') AS t FROM part),
c AS (SELECT p_partkey, string_split(t, '') AS cs FROM s)
SELECT p_partkey, array_to_string(list_transform(cs, lambda x, i: CASE WHEN i = 1 OR lower(cs[i - 1]) = upper(cs[i - 1]) THEN upper(x) ELSE lower(x) END), '') AS v
FROM c""")
def q_title_case(spark, d):
    """Python ``str.title`` casing."""
    p = Tables(spark, d).part
    s = F.concat(F.lit("\t"), F.concat_ws("-", "p_name", F.lower("p_type")), F.lit(" "))
    return p.select("p_partkey", text.title_case(s).alias("v"))


# Rows of a task that cases names: a small file is one split, and the casing takes far longer than the reading.
CASED_ROWS = 10_000
_LABEL = "chr(9) || lower(c_mktsegment) || ' of  gh/12AB-o' || chr(39) || 'neil d' || chr(39) || 'x ' || lower(c_name) || ' of'"


@register("proper_case", f"SELECT c_custkey, {proper_case_sql(_LABEL)} AS v FROM customer")
def q_proper_case(spark, d):
    """Display-name casing with acronyms, part codes, apostrophes and stop words."""
    c = spread(Tables(spark, d).customer, "c_custkey", rows=CASED_ROWS)
    s = F.concat(F.lit("\t"), F.lower("c_mktsegment"), F.lit(" of  gh/12AB-o'neil d'x "), F.lower("c_name"), F.lit(" of"))
    return c.select("c_custkey", text.proper_case(s).alias("v"))


_SLUG = "regexp_replace(regexp_replace(lower(trim(c_mktsegment || ' ' || c_name)), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')"


@register("slug_to_proper", "SELECT c_custkey, " + proper_case_sql(f"replace({_SLUG}, '_', ' ')") + " AS v FROM customer")
def q_slug_to_proper(spark, d):
    c = spread(Tables(spark, d).customer, "c_custkey", rows=CASED_ROWS)
    return c.select("c_custkey", text.slug_to_proper(text.slug(F.concat_ws(" ", "c_mktsegment", "c_name"))).alias("v"))


@register("split_person_name", flat_sql("""
SELECT c_custkey, {'first_name': CASE WHEN len(string_split(regexp_replace(trim(c_mktsegment || ' ' || c_name), '\\s+', ' ', 'g'), ' ')) <= 1
    THEN regexp_replace(trim(c_mktsegment || ' ' || c_name), '\\s+', ' ', 'g')
    ELSE array_to_string(string_split(regexp_replace(trim(c_mktsegment || ' ' || c_name), '\\s+', ' ', 'g'), ' ')[2:], ' ') END,
  'last_name': CASE WHEN len(string_split(regexp_replace(trim(c_mktsegment || ' ' || c_name), '\\s+', ' ', 'g'), ' ')) <= 1 THEN 'Unknown'
    ELSE string_split(regexp_replace(trim(c_mktsegment || ' ' || c_name), '\\s+', ' ', 'g'), ' ')[1] END} AS v
FROM customer""", keys="c_custkey", shape="struct"))
def q_split_person_name(spark, d):
    c = Tables(spark, d).customer
    return flat_spark(c.select("c_custkey", text.split_person_name(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("v")), shape="struct")


@register("rewrite_path", """
SELECT page_id, CASE WHEN starts_with(u, 'https://m.') THEN 'https://mobile.' || substr(u, 11) ELSE u END AS v
FROM (SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url END AS u FROM pages)""")
def q_rewrite_path(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", codes.rewrite_path("url", [("http://", "https://"), ("https://m.", "https://mobile.")]).alias("v"))


@register("regex_extract_events", """
SELECT page_id, (SELECT lang FROM (SELECT CASE WHEN regexp_extract(url, '/(\\d+)', 1) <> '' THEN
      lpad(CAST(CASE WHEN TRY_CAST(split_part(regexp_extract(url, '/(\\d+)', 1), ':', 1) AS INTEGER) < 7
                     THEN TRY_CAST(split_part(regexp_extract(url, '/(\\d+)', 1), ':', 1) AS INTEGER) + 12
                     ELSE TRY_CAST(split_part(regexp_extract(url, '/(\\d+)', 1), ':', 1) AS INTEGER) END AS VARCHAR), 2, '0') || ':00' END AS lang)) AS v
FROM pages""")
def q_regex_extract_events(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", F.element_at(codes.regex_extract_events("url", {"lang": r"/(\d+)"}), F.lit("lang")).alias("v"))


@register("parse_cycle_code", flat_sql("""
WITH c AS (SELECT o_orderkey AS k, upper(trim(CASE WHEN o_orderstatus = 'F' THEN 'S-' ELSE '' END || strftime(o_orderdate, '%y%m')
              || lpad(CAST(o_orderkey % 12 AS VARCHAR), 2, '0') || o_orderstatus)) AS s FROM orders),
p AS (SELECT k, starts_with(s, 'S-') AS is_trial, CASE WHEN starts_with(s, 'S-') THEN substr(s, 3) ELSE s END AS core FROM c)
SELECT k, CASE WHEN regexp_matches(core, '^\\d{4}[0-9A-Z]{2}[A-Z]$') AND TRY_CAST(substr(core, 3, 2) AS INTEGER) BETWEEN 1 AND 12 THEN
  {'is_trial': is_trial,
   'year': CASE WHEN TRY_CAST(substr(core, 1, 2) AS INTEGER) >= 70 THEN TRY_CAST(substr(core, 1, 2) AS INTEGER) + 1900 ELSE TRY_CAST(substr(core, 1, 2) AS INTEGER) + 2000 END,
   'month': TRY_CAST(substr(core, 3, 2) AS INTEGER), 'site': substr(core, 5, 2), 'variety': substr(core, 7, 1),
   'seeding_month': make_date(CASE WHEN TRY_CAST(substr(core, 1, 2) AS INTEGER) >= 70 THEN TRY_CAST(substr(core, 1, 2) AS INTEGER) + 1900
                                   ELSE TRY_CAST(substr(core, 1, 2) AS INTEGER) + 2000 END, TRY_CAST(substr(core, 3, 2) AS INTEGER), 1)} END AS v
FROM p""", shape="struct"))
def q_parse_cycle_code(spark, d):
    o = Tables(spark, d).orders
    code = F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("S-")).otherwise(F.lit("")),
                    codes.cycle_code("o_orderdate", F.lpad((F.col("o_orderkey") % 12).cast("string"), 2, "0"), "o_orderstatus"))
    return flat_spark(o.select(F.col("o_orderkey").alias("k"), codes.parse_cycle_code(code).alias("v")), shape="struct")


# Weather channel kinds bound to the event types of the
# given events table (a binding choice), with decimal exponents.
EVENT_CHANNELS = {"view": ("TEMPERATURE", 1), "click": ("HUMIDITY", 0), "purchase": ("WIND_AVERAGE_SPEED", 1),
                  "error": ("WIND_DIRECTION", 0), "signup": ("RAIN", 0)}


@register("unit_convert", flat_sql("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'TEMPERATURE' WHEN 'click' THEN 'HUMIDITY' WHEN 'purchase' THEN 'WIND_AVERAGE_SPEED'
                  WHEN 'error' THEN 'WIND_DIRECTION' ELSE 'RAIN' END AS kind,
                  CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 1 ELSE 0 END AS ex, value FROM events),
v AS (SELECT event_id, kind, value, value / pow(10.0, ex) AS x FROM e)
SELECT event_id, {'value': CASE WHEN kind = 'TEMPERATURE' THEN ROUND((x / 100) * 9 / 5 + 32, 2) WHEN kind = 'HUMIDITY' THEN ROUND(x / 100, 2)
  WHEN kind = 'WIND_AVERAGE_SPEED' THEN ROUND((x / 100) * 2.23694, 2) WHEN kind = 'RAIN' THEN ROUND((x / 1000) * 0.0393701, 4)
  WHEN kind NOT IN ('WIND_DIRECTION', 'POWER_SUPPLY') THEN x END,
  'label': CASE WHEN kind = 'WIND_DIRECTION' THEN ['N', 'NNE', 'NE', 'ENE', 'E', 'ESE', 'SE', 'SSE', 'S', 'SSW', 'SW', 'WSW', 'W', 'WNW', 'NW', 'NNW'][CAST(trunc(x) AS INTEGER) + 1] END} AS v
FROM v""", keys="event_id", shape="struct"))
def q_unit_convert(spark, d):
    ev = Tables(spark, d).events
    kind = F.create_map(*[x for k, (kd, _) in EVENT_CHANNELS.items() for x in (F.lit(k), F.lit(kd))])
    ex = F.create_map(*[x for k, (_, e) in EVENT_CHANNELS.items() for x in (F.lit(k), F.lit(e))])
    return flat_spark(ev.select("event_id", arith.unit_convert(F.element_at(kind, F.col("event_type")), F.col("value"),
                                                                F.element_at(ex, F.col("event_type"))).alias("v")), shape="struct")
