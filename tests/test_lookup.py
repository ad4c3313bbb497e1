"""Value maps from a table."""

import pytest
from pyspark.sql import functions as F

from orderflow.operators.lookup import lookup_table, map_from_table, measured_bytes
from orderflow.operators.validate import validate
from orderflow.plans.workspace import Workspace
from orderflow.specs import CUSTOMERS, ORDERS

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_nulls_conflicts_and_column_order(spark):
    df = spark.createDataFrame([(1, "uk", "x"), (2, "UK", "y"), (3, None, "z"), (4, "Peru", "w"), (5, "void", "v")], "id int, country string, variant string")
    table = spark.createDataFrame([("UK", "United Kingdom"), ("UK", "Uk again"), (None, "nothing"), ("VOID", None), ("OTHER", "o")], "variant string, canonical string")
    for bound in (1 << 20, 0):
        got = map_from_table(df, "country", table, key=F.upper, max_broadcast_bytes=bound)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect())) == [(1, "Uk again", "x"), (2, "Uk again", "y"), (3, None, "z"), (4, "Peru", "w"), (5, "void", "v")]
    assert map_from_table(df, "country", table.limit(0)).collect() == df.collect()


def test_a_large_table_is_not_broadcast(spark):
    table = spark.range(1_000_000).select(F.concat(F.lit("NAME"), "id").alias("variant"), F.concat(F.lit("Canonical name "), "id").alias("canonical"))
    assert measured_bytes(table) > 64 << 20
    df = spark.range(2000).select(F.concat(F.lit("name"), F.col("id") * 977 % 1_500_000).alias("name"))
    large = map_from_table(df, "name", table, key=F.upper)
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
    small = map_from_table(df, "name", table.limit(1000), key=F.upper)
    assert "BroadcastHashJoin" in plan(small)
    want = sorted(f"Canonical name {i}" if i < 1_000_000 else f"name{i}" for i in (k * 977 % 1_500_000 for k in range(2000)))
    assert sorted(r.name for r in large.collect()) == want


def test_validation_with_a_table_equals_the_spec(spark):
    raw = Workspace.of(spark, SF_SMALL).raw("customers")
    table = lookup_table(spark, CUSTOMERS.field("country").synonyms)
    got, want = validate(raw, CUSTOMERS, {"country": table}), validate(raw, CUSTOMERS)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError, match="unknown field"):
        validate(raw, CUSTOMERS, {"town": table})


def test_rows_are_not_shuffled_by_the_values_of_a_synonym_map(spark):
    """Spark knows before it runs anything that the map is small."""
    df = spark.range(500).select(F.when(F.col("id") % 5 > 0, "pending").otherwise(F.col("id").cast("string")).alias("order_status"))
    table = lookup_table(spark, ORDERS.field("order_status").synonyms)
    got = map_from_table(df, "order_status", table, key=F.lower)
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)
    checked = validate(Workspace.of(spark, SF_SMALL).raw("orders"), ORDERS, {"order_status": table})
    assert "SortMergeJoin" not in plan(checked) and "hashpartitioning(__lookup_key" not in plan(checked)
    assert got.count() == 500
    assert lookup_table(spark, {}).collect() == [] and lookup_table(spark, {}).columns == table.columns
