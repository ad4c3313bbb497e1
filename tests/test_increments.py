"""Batches of new raw files against one whole run (E1 -> E2)."""

import pytest
from pyspark.sql import functions as F

from orderflow.plans import increments, releases, stages
from orderflow.plans.workspace import Workspace
from orderflow.session import new_work_dir
from orderflow.sources import io
from orderflow.specs import ENTITIES

from .conftest import SF_SMALL

TABLES = (*stages.ORPHAN_OUTPUTS, *stages.CURATED_OUTPUTS)


def append(df, path):
    df.coalesce(1).write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def rows(spark, outputs):
    return {n: sorted(map(str, spark.read.parquet(outputs[n]).collect())) for n in TABLES}


def whole(spark, zones):
    own = io.Zones(new_work_dir(spark, "whole"), raw_root=zones.raw("").rstrip("/"))
    return rows(spark, stages.run(spark, own).outputs)


def test_batches_equal_one_whole_run(spark):
    """Rows are dealt by hash, so keys, their duplicates and the parents of
    orders come in different batches: survivors change, orphans become sales."""
    ws, zones = Workspace.of(spark, SF_SMALL), io.Zones(new_work_dir(spark, "batches"))
    seen = []
    for part in range(2):
        for n in ENTITIES:
            raw = ws.raw(n)
            append(raw.where(F.pmod(F.xxhash64(*raw.columns, F.lit(n)), F.lit(2)) == part), zones.raw(n))
        increments.publish_batch(spark, zones)
        seen.append(releases.current(spark, zones))
    assert rows(spark, seen[-1].outputs) == whole(spark, zones)
    assert len({r.run for r in seen}) == 2
    assert {n: len(fs) for n, fs in seen[-1].consumed.items()} == dict.fromkeys(ENTITIES, 2)
    before = seen[-1]
    assert increments.publish_batch(spark, zones).outputs == before.outputs and releases.current(spark, zones) == before


def test_orders_only_then_parents_then_a_better_row(spark):
    zones = io.Zones(new_work_dir(spark, "small"))
    orders = "order_id string, customer_id string, product_id string, quantity string, order_date string, order_status string"
    customers = "customer_id string, customer_name string, email string, country string, lifetime_value string, signup_date string"
    products = "product_id string, product_name string, category string, price string, stock_qty string"
    batches = [
        {"orders": [("O00001", "C0001", "P001", "2", "05/01/2024", "completed"), ("O00002", "C0001", "P002", "1", "09/01/2024", "returned"), ("O00003", "C0002", "P001", "4", "01/01/2024", "pending")]},
        {"customers": [("C0001", "Zoe", "z@x.com", "uk", "10", "01/01/2020")], "products": [("P001", "Pen", "book", "5", "1")]},
        {"customers": [("C0001", "Ada", "z@x.com", "uk", "10", "01/01/2020"), ("C0002", "Bob", "b@x.com", "es", "1", "01/01/2020")], "products": [("P002", "Cup", "home", "3", "1")]},
        # A smaller row of order 2 (an earlier product), and order 3 again.
        {"orders": [("O00002", "C0001", "P001", "1", "20/01/2024", "completed"), ("O00003", "C0002", "P001", "4", "01/01/2024", "pending"), ("O00009", "C0002", "P002", "1", "bad date", "pending")]},
        {"orders": [("O00001", "C0000", "P001", "2", "05/01/2024", "completed")]},  # customer 1 loses its first order
    ]
    schemas = {"orders": orders, "customers": customers, "products": products}
    for step, batch in enumerate(batches):
        for n, data in batch.items():
            append(spark.createDataFrame(data, schemas[n]), zones.raw(n))
        increments.publish_batch(spark, zones)
        if step in (0, 3):  # the others show in what follows
            continue
        every = {n: io.read_csv(spark, zones.raw(n)) if (zones.raw(n) and _there(spark, zones.raw(n))) else spark.createDataFrame([], schemas[n]) for n in ENTITIES}
        own = io.Zones(new_work_dir(spark, "all"))
        stages.process_raw(spark, every, own)
        assert rows(spark, releases.current(spark, zones).outputs) == rows(spark, stages.curate(spark, own).outputs)
    metrics = {r.customer_id: r for r in releases.read_published(spark, zones, "customer_metrics").collect()}
    assert str(metrics["C0001"].first_order_date) == "2024-01-20" and metrics["C0001"].total_orders == 1


def _there(spark, path):
    from orderflow.sources import files

    return files.exists(spark, path)


def test_changed_files_and_whole_releases_are_refused(spark):
    ws, zones = Workspace.of(spark, SF_SMALL), io.Zones(new_work_dir(spark, "refused"))
    for n in ENTITIES:
        io.write_csv(ws.raw(n).limit(50), zones.raw(n))
    increments.publish_batch(spark, zones)
    io.write_csv(ws.raw("orders").limit(60), zones.raw("orders"))
    with pytest.raises(ValueError, match="changed or are gone"):
        increments.publish_batch(spark, zones)
    releases.publish(spark, zones)
    with pytest.raises(ValueError, match="no state"):
        increments.publish_batch(spark, zones)
