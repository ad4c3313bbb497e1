"""The one-join-per-parent tagging equals the anti / semi joins."""

from pyspark.sql import functions as F

from orderflow.operators import integrity, marts


def _set(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_tagging_matches_anti_and_semi_joins(ws):
    orders, customers, products = ws.deduped("orders"), ws.deduped("customers"), ws.deduped("products")
    tagged = marts.tag_orders(orders, customers, products)
    cols = orders.columns
    assert _set(integrity.key_first(tagged.where(~F.col("has_customer_id")), "customer_id", cols)) == _set(
        integrity.orphans(orders, customers, "customer_id")
    )
    assert _set(integrity.key_first(tagged.where(~F.col("has_product_id")), "product_id", cols)) == _set(
        integrity.orphans(orders, products, "product_id")
    )
    semi = integrity.with_parent(integrity.with_parent(orders, customers, "customer_id"), products, "product_id")
    assert _set(marts.retained(tagged).select(*semi.columns)) == _set(semi)
    assert tagged.count() == orders.count()


def test_orphan_of_both_parents_is_in_both(spark):
    orders = spark.createDataFrame([("O1", "C1", "P1"), ("O2", "C9", "P9")], "order_id string, customer_id string, product_id string")
    customers = spark.createDataFrame([("C1", "n", "e", "c")], "customer_id string, customer_name string, email string, country string")
    products = spark.createDataFrame([("P1", "n", "c", None)], "product_id string, product_name string, category string, price_cleaned decimal(12,2)")
    assert [r.order_id for r in integrity.orphans(orders, customers, "customer_id").collect()] == ["O2"]
    assert [r.order_id for r in integrity.orphans(orders, products, "product_id").collect()] == ["O2"]
    assert integrity.orphans(orders, customers, "customer_id").columns[0] == "customer_id"


def test_fixture_counts_sf0001(ws):
    orders = ws.deduped("orders")
    assert orders.count() == 1388
    assert integrity.orphans(orders, ws.deduped("customers"), "customer_id").count() == 449
    assert integrity.orphans(orders, ws.deduped("products"), "product_id").count() == 139
    assert marts.enrich(ws.tagged()).count() == 841
