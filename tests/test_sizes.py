"""What one task gets of a large table, on small tables: the thresholds are lowered and nothing is broadcast."""

import re
import time

import pytest
from pyspark.sql import functions as F

from furrow import session
from furrow.functions import text
from furrow.operators import sales
from furrow.plans import catalog, jobs, views
from tests.conftest import SF_SMALL


@pytest.fixture
def large(spark, monkeypatch):
    """Tables count as large from 8 x 100 rows on."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100, raising=False)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans_of_lines(df) -> str:
    """The exchanges right above a scan of the lines."""
    return "\n".join(re.findall(r"Exchange [^\n]*(?=\n[^\n]*(?:Filter|Project)?[^\n]*\n?[^\n]*FileScan parquet \[l_orderkey)", _plan(df)))


def _lineitem_parts(df, key="l_orderkey") -> list[int]:
    return [int(n) for n in re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, (\d+)\), REPARTITION_BY_NUM", _plan(df))]


@pytest.mark.parametrize("name", ["upsert_parent_replace_children", "etl_schedule", "etl_sales_orders", "etl_expense_reload", "spray_restrictions"])
def test_lines_are_spread_by_their_number(large, name):
    before = catalog.queries()[name](large, SF_SMALL)
    parts = _lineitem_parts(before)
    assert parts and min(parts) >= 60 and "Exchange hashpartitioning(l_orderkey" not in re.sub(r"Exchange hash[^\n]*REPARTITION_BY_NUM", "", _scans_of_lines(before))  # 6,000 lines at 100 a task; shuffle partitions are 4


def test_schedule_sorts_few_rows_a_task(large):
    df = catalog.queries()["etl_schedule"](large, SF_SMALL)
    assert df.rdd.getNumPartitions() >= 60


def test_spray_reads_its_events_once(large):
    assert _plan(catalog.queries()["spray_restrictions"](large, SF_SMALL)).count("FileScan parquet") == 2


def test_payroll_rows_without_id_are_not_one_key(large):
    """The wide rows are shuffled by name and id, never by the id alone that a third of them lack."""
    rows = [(i, "", f"P{i % 50} X", "1/1/2024 - 1/14/2024", "", "", "f", "", "Hourly", "", "True", "", *["1"] * len(jobs.PAYROLL_NUMBERS)) for i in range(200)]
    names = ["row_no", "employee_id", "full_name", "pay_period", "check_date", "department", "status", "workers_compensation_code", "pay_structure", "source",
             "is_standard", "invoice_number", *[sheet or out for out, sheet in jobs.PAYROLL_NUMBERS.items()]]
    raw = large.createDataFrame(rows, names)
    people = large.createDataFrame([(f"p{i}", str(i), f"P{i} X", "pack", "F", "a", 1) for i in range(40)],
                                   ["id", "payroll_id", "full_name", "hr_department_id", "hr_work_authorization_id", "wc", "overtime_threshold"])
    df = jobs.etl_payroll(raw, people)
    assert df.count() == 200 and df.where("hr_employee_id = 'p3'").count() == 4
    formatted = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    wide = [b for b in formatted.split("\n\n") if re.match(r"\(\d+\) Exchange", b) and "gross_wage" in b]
    assert wide and all("hashpartitioning(_name" in b and "_eid" in b.split("hashpartitioning")[1] for b in wide)


def test_plant_map_changes_reads_its_sheet_once(large):
    assert _plan(catalog.queries()["etl_plant_map_changes"](large, SF_SMALL)).count("lineitem.parquet") == 0


def test_casing_is_linear_in_the_words(spark):
    """Long names keep their casing (time bound loose; the code before passed it too)."""
    one = " ".join(["of the gh o'neil 12AB"] * 60)
    began = time.time()
    out = spark.range(20).select(text.proper_case(F.concat(F.lit(one), F.col("id").cast("string"))).alias("v")).collect()
    assert out[3].v.startswith("Of the GH O'Neil 12AB of the GH") and time.time() - began < 15


def test_spray_kinds_without_length_have_no_day(spark):
    ev = spark.sql("SELECT 1 AS ops_task_tracker_id, 1 AS org_id, 'a' AS farm_id, 2 AS site_id, TIMESTAMP_NTZ '2024-01-01 15:00:00' AS spray_stop, "
                   "CAST(0 AS DOUBLE) AS max_rei_hours, 1 AS max_phi_days")
    got = sorted((r.restriction_type, str(r.restriction_date), r.restriction_value) for r in views.spray_restrictions(ev).collect())
    assert got == [("NH", "2024-01-01", 1.0), ("NH", "2024-01-02", 1.0)]


def test_few_values_are_spread_by_salt(large):
    df = large.range(1000).withColumn("c", F.when(F.col("id") % 3 > 0, " a"))
    got = text.map_distinct(df, "c", F.upper, "u", salts=16)
    assert got.columns == ["id", "c", "u"] and got.where("u <=> upper(c)").count() == 1000
    assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 500


def test_casing_is_spread_over_tasks(large, monkeypatch):
    """A small file is one split; 150 customers at 10 a task."""
    monkeypatch.setattr("furrow.plans.cleaning.CASED_ROWS", 10, raising=False)
    assert catalog.queries()["proper_case"](large, SF_SMALL).rdd.getNumPartitions() >= 15


def _pallets(spark, **options):
    lines = spark.range(3000).selectExpr("IF(id % 4 < 3, 'F', 'G') AS farm", "CAST(id % 37 AS INT) AS customer", "CAST(id % 3 AS INT) AS product", "CAST(60 AS BIGINT) AS max_cases",
                                         "date_add(DATE '2024-01-01', CAST(id % 200 AS INT)) AS pack_date", "id % 130 AS qty", "CAST(50 AS BIGINT) AS full_cases",
                                         "id % 2 = 0 AS stackable", "IF(id % 3 = 0, 'cucumber', 'lettuce') AS family", "id AS line", "id % 37 % 5 = 0 AS special")
    return sales.palletize(lines, ["farm"], ["customer", "product"], "pack_date", "qty", "max_cases", "full_cases", "stackable", ["line"],
                           number_bucket=F.floor(F.col("customer") / 10), **options)


def test_lines_are_shuffled_once_into_pallets(large):
    """Counting and laying out take the lines as one shuffle by zone leaves them; four shuffles before."""
    _, alloc = _pallets(large)
    per_pallet = alloc.groupBy("farm", F.floor(F.col("customer") / 10), "customer", "product", "pallet_index").count()
    assert _plan(alloc).count("Exchange ") == 1 and _plan(per_pallet).count("Exchange ") <= 2


@pytest.mark.parametrize("block_rows", [0, 700, 10**6])
def test_pallets_of_large_zones_are_the_same(spark, block_rows):
    want, _ = _pallets(spark)
    got, alloc = _pallets(spark, special="special", block_rows=block_rows)
    whole, whole_alloc = _pallets(spark, special="special")
    assert sorted(got.collect()) == sorted(whole.collect()) and sorted(alloc.collect()) == sorted(whole_alloc.collect())
    assert got.agg(F.sum("cases")).first() == want.agg(F.sum("cases")).first()
    numbers = {}
    for r in sorted(got.collect(), key=lambda r: (r.customer, r.product, r.pallet_index)):
        prefix = f"{r.customer}_" if r.label == "Shareable" else {"cucumber": "CP", "lettuce": "LP"}[r.family]
        numbers[r.farm, prefix] = numbers.get((r.farm, prefix), 0) + 1
        assert r.pallet_number == f"{prefix}{numbers[r.farm, prefix]:02d}"


def test_locked_allocations_say_so_themselves(spark):
    """The label of an allocation is that of its pallet, so that a refresh looks nothing up."""
    line, pallet = ["line"], ["farm", "customer", "product", "pallet_index"]
    pallets, alloc = _pallets(spark, special="special", labels=True, number=False)
    key = [F.coalesce(F.col(c), F.lit(-1)) if c != "farm" else F.col(c) for c in pallet]
    assert sorted(alloc.select(*key, "label").distinct().collect()) == sorted(pallets.select(*key, "label").collect())
    locked = F.col("label") == "Full"
    lines = alloc.select("farm", "customer", "product", "line", "qty").distinct()

    def refreshed(old_alloc):
        return sales.lock_preserving_refresh(pallets.withColumn("is_locked", locked), old_alloc, lines, "is_locked", pallet, line, "qty",
                                             lambda rest: rest.select("farm", "customer", "product", F.col("line").alias("pallet_index"), "qty", "_first")
                                             .withColumns({c: F.lit(None) for c in ("cases", "max_cases", "full_cases", "family", "label")})
                                             .withColumns({"cases": F.col("qty"), "max_cases": F.col("_first")}))

    said, looked_up = refreshed(alloc.withColumn("is_locked", locked)), refreshed(alloc)
    assert sorted(map(str, said.collect())) == sorted(map(str, looked_up.collect())) and "LeftSemi" in _plan(looked_up) and "LeftSemi" not in _plan(said)


def test_pallets_are_not_shuffled_by_scope_to_be_stacked(spark):
    """Scopes are few: a join that shuffles by them gives a task all pallets of one."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        pallets = spark.range(100_000).selectExpr("id", "id % 3 AS farm", "IF(id % 2 = 0, 'cucumber', 'lettuce') AS family", "'Shareable' AS label")
        plan = _plan(sales.stack_spaces(pallets, ["farm"], ["id"], bucket=F.floor(F.col("id") / 1000)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan and "hashpartitioning(farm" not in plan


def test_priced_lines_are_joined_to_their_orders_once(large):
    """The lines are written before they ask; no answer is sought in a plan that joins them anew."""
    plan = _plan(catalog.queries()["price_resolution"](large, SF_SMALL))
    assert "o_orderkey" not in plan and "c_custkey" not in plan and plan.count("Join") == 3


def test_pallets_are_not_written_again_to_be_stacked(spark, monkeypatch):
    from furrow.plans import sales_rules

    names = []
    monkeypatch.setattr(sales_rules, "written_table", lambda df, name: names.append(name) or session.written_table(df, name))
    assert catalog.queries()["stack_spaces"](spark, SF_SMALL).count() > 0 and names == ["fulfilments"]
