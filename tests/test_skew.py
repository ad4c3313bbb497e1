"""A hot key (one customer with a third of all orders) is split, not sent to
one task, and results stay whole."""

from pyspark.sql import functions as F

from orderflow.operators import integrity, marts
from orderflow.session import new_work_dir
from orderflow.sources import io

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _materialised(spark, df, label):
    """Dimensions are joined from their written tables, as in stage 2."""
    path = f"{new_work_dir(spark, label)}/t"
    io.write_parquet(df, path)
    return io.read_parquet(spark, path)


def test_hot_customer_join_is_split(spark, ws):
    customers = _materialised(spark, marts.dim_customers(ws.deduped("customers")), "skew-dim-c")
    products = _materialised(spark, marts.dim_products(ws.deduped("products")), "skew-dim-p")
    hot = customers.agg(F.min("customer_id")).first()[0]
    orders = ws.deduped("orders")
    n = orders.count()
    # A third of the orders move to one customer.
    skewed = orders.withColumn(
        "customer_id", F.when(F.xxhash64("order_id") % 3 == 0, F.lit(hot)).otherwise(F.col("customer_id"))
    )

    def run():
        tagged = marts.tag_orders(skewed, customers, products)
        everything = tagged.collect()  # the final adaptive plan is that of this run
        rows = tagged.groupBy("has_customer_id", "has_product_id").count().collect()
        assert len(everything) == sum(r["count"] for r in rows)
        return rows, tagged._jdf.queryExecution().executedPlan().toString()

    rows, final_plan = _with_conf(spark, SKEW_CONF, run)
    assert sum(r["count"] for r in rows) == n
    assert "SortMergeJoin" in final_plan and "skew=true" in final_plan
    expected_orphans = integrity.orphans(skewed, customers, "customer_id").count()
    got_orphans = sum(r["count"] for r in rows if not r["has_customer_id"])
    assert got_orphans == expected_orphans


def test_hot_key_metrics_match_brute_force(spark, ws):
    customers, products = ws.deduped("customers"), ws.deduped("products")
    hot = customers.agg(F.min("customer_id")).first()[0]
    skewed = ws.deduped("orders").withColumn(
        "customer_id", F.when(F.xxhash64("order_id") % 3 == 0, F.lit(hot)).otherwise(F.col("customer_id"))
    )
    measured = marts.add_measures(marts.enrich(marts.tag_orders(skewed, customers, products)))
    got = _with_conf(spark, SKEW_CONF, lambda: marts.customer_metrics(measured).where(F.col("customer_id") == hot).first())
    rows = [r for r in measured.collect() if r["customer_id"] == hot]
    assert got["total_orders"] == len(rows)
    assert got["total_quantity"] == sum(r["quantity"] for r in rows)
    assert got["total_spend"] == sum(r["order_amount"] for r in rows)
