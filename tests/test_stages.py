"""E1-E3 end to end at sf0.001: expected counts and cross-table invariants."""

import pathlib

import pytest
from pyspark.sql import functions as F

from orderflow.plans import stages
from orderflow.plans.workspace import Workspace
from orderflow.session import new_work_dir
from orderflow.sources import fixtures, io
from orderflow.specs import ENTITIES


@pytest.fixture(scope="module")
def run(spark, ws):
    zones = io.Zones(new_work_dir(spark, "test-etl"))
    for n in ENTITIES:
        io.write_csv(ws.raw(n), zones.raw(n))
    return spark, stages.run(spark, zones)


def _read(spark, result, name):
    return io.read_parquet(spark, result.outputs[name])


def test_validation_summary(run):
    spark, result = run
    got = {r["Dataset"]: (r["Total_count"], r["Valid_count"], r["Invalid_count"]) for r in result.frames["validation_summary"].collect()}
    assert got == {"customers": (150, 107, 43), "products": (200, 178, 22), "orders": (6000, 5237, 763)}


def test_duplicate_summaries(run):
    _, result = run
    before = {r["dataset"]: tuple(r)[1:] for r in result.frames["duplicate_summary_before"].collect()}
    after = {r["dataset"]: tuple(r)[1:] for r in result.frames["duplicate_summary_after"].collect()}
    assert before == {"customers": (107, 104, 3), "products": (178, 170, 8), "orders": (5237, 1388, 1254)}
    assert after == {"customers": (104, 104, 0), "products": (170, 170, 0), "orders": (1388, 1388, 0)}


def test_curated_counts_and_sums(run):
    spark, result = run
    counts = {n: _read(spark, result, n).count() for n in (*stages.CURATED_OUTPUTS, "orphan_customers", "orphan_products")}
    assert counts == {
        "customer_metrics": 104,
        "product_metrics": 139,
        "sales_summary": 838,
        "dim_customers": 104,
        "dim_products": 170,
        "fact_orders": 841,
        "orphan_customers": 449,
        "orphan_products": 139,
    }
    fact = _read(spark, result, "fact_orders").agg(F.sum("order_amount"), F.sum("quantity")).first()
    assert str(fact[0]) == "25516486.10" and fact[1] == 21346
    spend = _read(spark, result, "customer_metrics").agg(F.sum("total_spend")).first()[0]
    gross = _read(spark, result, "product_metrics").agg(F.sum("total_sales")).first()[0]
    recognised = _read(spark, result, "sales_summary").agg(F.sum("total_sales")).first()[0]
    assert spend == gross == fact[0]
    assert str(recognised) == "8660217.40"


def test_retained_plus_orphans_cover_deduped_orders(run):
    spark, result = run
    fact = _read(spark, result, "fact_orders").select("order_id")
    oc = _read(spark, result, "orphan_customers").select("order_id")
    op = _read(spark, result, "orphan_products").select("order_id")
    assert fact.union(oc.union(op).distinct()).count() == 1388
    assert fact.join(oc.union(op), "order_id").count() == 0


def test_output_schemas(run):
    spark, result = run
    assert _read(spark, result, "fact_orders").columns == [
        "order_id", "customer_id", "product_id", "order_date_cleaned", "order_status", "quantity", "unit_price", "order_amount"
    ]
    assert dict(_read(spark, result, "sales_summary").dtypes) == {
        "order_date_cleaned": "date", "country": "string", "category": "string", "total_orders": "bigint",
        "total_quantity": "bigint", "total_sales": "decimal(33,2)", "completed_orders": "bigint",
        "returned_orders": "bigint", "cancelled_orders": "bigint",
    }
    assert _read(spark, result, "orphan_customers").columns[:2] == ["customer_id", "order_id"]
    assert dict(_read(spark, result, "customer_metrics").dtypes)["total_spend"] == "decimal(33,2)"


def test_stage_one_failure_stops_the_run(spark):
    zones = io.Zones(new_work_dir(spark, "test-missing"))
    with pytest.raises(Exception):
        stages.run(spark, zones)


def test_optional_partitioned_curated_output(spark, ws):
    zones = io.Zones(new_work_dir(spark, "test-etl-partitioned"))
    for n in ENTITIES:
        io.write_csv(ws.raw(n), zones.raw(n))
    result = stages.run(spark, zones, partition_by={"sales_summary": ("order_date_cleaned",)})
    path = result.outputs["sales_summary"]
    assert any(p.name.startswith("order_date_cleaned=") for p in pathlib.Path(path.replace("file:", "")).iterdir())
    assert io.read_parquet(spark, path).count() == 838


def test_fixture_sums_sf001(spark):
    """The sf0.01 curated figures of FIXTURES.md (listed there as unchecked)."""
    from orderflow.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.01"
    fact = QUERIES["fact_orders"](spark, sf).agg(F.sum("order_amount"), F.sum("quantity")).first()
    assert (str(fact[0]), fact[1]) == ("269180707.40", 229409)
    assert str(QUERIES["sales_summary"](spark, sf).agg(F.sum("total_sales")).first()[0]) == "89720113.70"
    counts = {n: QUERIES[n](spark, sf).count() for n in ("customer_metrics", "product_metrics", "sales_summary", "dim_customers", "dim_products")}
    assert counts == {"customer_metrics": 1011, "product_metrics": 900, "sales_summary": 8665, "dim_customers": 1011, "dim_products": 971}


def test_cli_runs_the_gated_pipeline(spark, ws, capsys):
    from orderflow.cli import main

    root = new_work_dir(spark, "test-cli")
    for n in ENTITIES:
        io.write_csv(ws.raw(n), f"{root}/raw/{n}")
    assert main(["stage1", "--raw", f"{root}/raw", "--processed", f"{root}/p", "--curated", f"{root}/c"]) == 0
    assert main(["stage2", "--raw", f"{root}/raw", "--processed", f"{root}/p", "--curated", f"{root}/c"]) == 0
    out = capsys.readouterr().out
    assert f"fact_orders\t{root}/c/fact_orders" in out
    assert io.read_parquet(spark, f"{root}/c/fact_orders").count() == 841


def test_two_runs_at_once_in_one_session(spark, ws):
    from orderflow.plans.stages import run_concurrently

    zones = {}
    for tag in ("a", "b"):
        zones[tag] = io.Zones(new_work_dir(spark, f"test-concurrent-{tag}"))
        for n in ENTITIES:
            io.write_csv(ws.raw(n), zones[tag].raw(n))
    results = run_concurrently({t: (lambda z=z: stages.run(spark, z)) for t, z in zones.items()}, spark)
    for result in results.values():
        got = {r["Dataset"]: r["Valid_count"] for r in result.frames["validation_summary"].collect()}
        assert got == {"customers": 107, "products": 178, "orders": 5237}
        assert io.read_parquet(spark, result.outputs["fact_orders"]).count() == 841


def test_work_folder_is_gone_after_a_run(run):
    spark, _ = run
    from orderflow.session import app_id, checkpoint_root

    root = pathlib.Path(f"{checkpoint_root(spark)}/orderflow/{app_id(spark)}".replace("file:", ""))
    assert not [p for p in root.iterdir() if p.name.startswith("curate-")]


def test_stage_one_write_does_not_sort(spark, ws):
    """Under the documented setting the split needs no sort of the rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(key, "8")
    try:
        df = io.with_split(ws.validated("orders"))
        df.write.mode("overwrite").partitionBy(io.SPLIT_COLUMN).parquet(f"{new_work_dir(spark, 'test-nosort')}/t")
        store = spark._jsparkSession.sharedState().statusStore()
        last = store.executionsList().last()
        assert "partitionBy" in last.physicalPlanDescription() or "split" in last.physicalPlanDescription()
        assert "Sort" not in last.physicalPlanDescription()
    finally:
        spark.conf.unset(key)


def _plans(spark, n):
    """Plans of the last ``n`` executions of the session."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(max(0, found.size() - n), found.size())]


def test_processed_write_does_not_sort_whatever_the_session_says(spark, ws):
    """The rows of a task are not sorted by their split, and the session has
    its own setting back afterwards, also from several threads."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(key)
    root = new_work_dir(spark, "test-split")

    def write(n):
        io.write_processed(ws.validated(n), f"{root}/{n}")

    write("orders")
    plan = next(p for p in reversed(_plans(spark, 6)) if "InsertIntoHadoopFsRelationCommand" in p)
    assert f"{root}/orders" in plan and "Sort" not in plan
    assert spark.conf.get(key) == was
    stages.run_concurrently({n: (lambda n=n: write(n)) for n in ENTITIES}, spark)
    assert spark.conf.get(key) == was
    for n in ENTITIES:
        want = ws.validated(n)
        got = io.read_processed(spark, f"{root}/{n}", None)
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    spark.conf.set(key, "20")  # a session that allows more keeps it
    try:
        with io._open_files(spark):
            assert spark.conf.get(key) == "20"
        assert spark.conf.get(key) == "20"
    finally:
        spark.conf.set(key, was)


def test_orders_are_landed_with_one_shuffle_of_the_lines(spark, tmp_path):
    """Lines are dealt out by order before the join; the text made of them is
    not shuffled again."""
    lines = [(k, 7 * k + ln, ln, 5.0, "R", "F") for k in range(1, 40) for ln in (1, 2)] + [(None, 3, 1, 1.0, "A", "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(1, 30).selectExpr("id as o_orderkey", "id * 2 as o_custkey", "date'2020-03-04' as o_orderdate")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    ws = Workspace(spark, str(tmp_path))
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        derived = fixtures.raw_table(spark, str(tmp_path), "orders")
        plan = derived._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2 and plan.count("REBALANCE_PARTITIONS_BY_COL") == 1 and "SortMergeJoin" in plan
        assert ws.raw("orders").count() == 58
        landed = [p for p in _plans(spark, 6) if "InsertIntoHadoopFsRelationCommand" in p and "landed_orders" in p][-1]
        assert landed.split("== Initial Plan ==")[-1].split("\n\n")[0].count("Exchange") == 2
    finally:
        spark.conf.set(key, was)
    by_broadcast = fixtures.raw_table(spark, str(tmp_path), "orders")
    assert "BroadcastHashJoin" in by_broadcast._jdf.queryExecution().executedPlan().toString()
    assert by_broadcast.exceptAll(ws.raw("orders")).isEmpty() and by_broadcast.count() == 58
