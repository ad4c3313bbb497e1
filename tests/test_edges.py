"""Edge cases of the end-to-end run: header-only input, all-invalid rows,
all-orphan orders, extra columns."""

import os

from orderflow.plans import stages
from orderflow.session import new_work_dir
from orderflow.sources import io
from orderflow.specs import ENTITIES

HEADERS = {n: ",".join(s.raw_columns) for n, s in ENTITIES.items()}


def _zone(spark, label, bodies):
    zones = io.Zones(new_work_dir(spark, label))
    for name, body in bodies.items():
        d = zones.raw(name).replace("file:", "")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "part-0.csv"), "w") as fh:
            fh.write(body)
    return zones


def _counts(spark, result):
    return {name: io.read_parquet(spark, path).count() for name, path in result.outputs.items()}


def test_header_only_input(spark):
    zones = _zone(spark, "edge-empty", {n: h + "\n" for n, h in HEADERS.items()})
    result = stages.run(spark, zones)
    counts = _counts(spark, result)
    assert counts.pop("validation_summary") == 3
    assert set(counts.values()) == {0}
    pct = {r["Dataset"]: r["Invalid_percentage"] for r in result.frames["validation_summary"].collect()}
    assert pct == {"customers": 0.0, "products": 0.0, "orders": 0.0}
    assert {r["total_count"] for r in result.frames["duplicate_summary_after"].collect()} == {0}


def test_all_invalid_and_all_orphan(spark):
    zones = _zone(
        spark,
        "edge-orphans",
        {
            # extra column first: it passes through stage 1
            "customers": "note," + HEADERS["customers"] + "\nx,C0001,Ann,ann@x.com,uk,10,01/01/2020\n",
            "products": HEADERS["products"] + "\nbad,,,abc,-1\n",
            "orders": HEADERS["orders"] + "\nO00001,C0002,P001,1,01/01/2020,Shipped\nO00002,C0001,P009,2,02-01-2020,shipped\n",
        },
    )
    result = stages.run(spark, zones)
    counts = _counts(spark, result)
    assert counts["valid_products"] == 0 and counts["invalid_products"] == 1
    assert counts["valid_orders"] == 2
    assert counts["orphan_products"] == 2 and counts["orphan_customers"] == 1
    assert counts["fact_orders"] == 0 and counts["sales_summary"] == 0 and counts["dim_products"] == 0
    assert counts["dim_customers"] == 1
    processed = spark.read.parquet(result.outputs["valid_customers"])
    assert processed.columns[0] == "note" and processed.first()["country"] == "United Kingdom"
    assert "note" not in io.read_parquet(spark, result.outputs["dim_customers"]).columns
    reason = spark.read.parquet(result.outputs["invalid_products"]).select("error_reason").first()[0]
    assert reason == "PRODUCT_ID_INCORRECT_FORMAT;MISSING_PRODUCT_NAME;MISSING_CATEGORY;MISSING_PRICE;NEGATIVE_STOCK_QUANTITY"


def test_curate_alone_on_empty_processed_table(spark):
    zones = _zone(spark, "edge-alone", {n: h + "\n" for n, h in HEADERS.items()})
    stages.process_raw(spark, {n: io.read_csv(spark, zones.raw(n)) for n in ENTITIES}, zones)
    result = stages.curate(spark, zones)  # no schemas passed: taken from the specs
    assert io.read_parquet(spark, result.outputs["fact_orders"]).count() == 0


def test_curate_rejects_a_missing_or_foreign_folder(spark):
    import pytest

    zones = io.Zones(new_work_dir(spark, "edge-foreign"))
    with pytest.raises(Exception):
        stages.curate(spark, zones)
    for n in ENTITIES:
        io.write_parquet(spark.range(3), zones.processed(n))
    with pytest.raises(ValueError, match="missing"):
        stages.curate(spark, zones)


def test_header_in_another_case(spark):
    header = HEADERS["customers"]
    df = spark.createDataFrame([("c0001", "Ann", "ann@x.com", "uk", "10", "01/01/2020")], [c.title() for c in header.split(",")])
    from orderflow.operators.validate import validate

    out = validate(df, ENTITIES["customers"])
    assert out.columns[:4] == ["customer_id", "customer_name", "email", "country"]
    assert out.first()["record_status"] == "Valid"


def test_files_with_headers_in_another_order_fail(spark):
    import pytest

    zones = _zone(spark, "edge-order", {"customers": "a,b\n1,2\n"})
    d = zones.raw("customers").replace("file:", "")
    with open(os.path.join(d, "part-1.csv"), "w") as fh:
        fh.write("b,a\n3,4\n")
    with pytest.raises(Exception):
        io.read_csv(spark, zones.raw("customers")).collect()


def test_rerun_leaves_nothing_of_the_earlier_run_under_dynamic_overwrite(spark):
    good = HEADERS["products"] + "\nP001,Pen,Book,1.00,3\n"
    zones = _zone(spark, "edge-rerun", {"products": good + "bad,,,abc,-1\n"})
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stages.process_raw(spark, {"products": io.read_csv(spark, zones.raw("products"))}, zones)
        assert spark.read.parquet(zones.quarantine("products")).count() == 1
        with open(os.path.join(zones.raw("products").replace("file:", ""), "part-0.csv"), "w") as fh:
            fh.write(good)
        again = spark.read.option("header", True).csv(zones.raw("products"))
        stages.process_raw(spark, {"products": again}, zones)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(zones.quarantine("products")).count() == 0
    assert spark.read.parquet(zones.valid("products")).count() == 1
