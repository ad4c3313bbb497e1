"""Compare the library's forms with plain ones on the same inputs.

For each pair of forms: the best of three runs in seconds, and the shuffle and
spill that Spark's event log shows. The plain forms are what a first version
would do: one ``withColumn`` per rule, a scan per count, a window for the
survivor, an anti and a semi join per parent, and a distinct count in the mart.

    python scripts/compare_forms.py [sf_dir]    # prints a Markdown table
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUNS = 3


def work_of(event_dir: str) -> dict[str, tuple[float, float]]:
    """Shuffle and spill in MB by job group."""
    group_of: dict[int, str] = {}
    shuffle, spill = defaultdict(float), defaultdict(float)
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of.update({s: group for s in e.get("Stage IDs", [])})
                elif e.get("Event") == "SparkListenerTaskEnd" and (m := e.get("Task Metrics")):
                    group = group_of.get(e.get("Stage ID"))
                    shuffle[group] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
                    spill[group] += m["Disk Bytes Spilled"] / 1e6
    return {g: (shuffle[g], spill[g]) for g in shuffle}


def main() -> None:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from orderflow.operators import marts
    from orderflow.operators.dedup import dedup
    from orderflow.operators.validate import standardize, validate
    from orderflow.plans.catalog import QUERIES
    from orderflow.plans.workspace import Workspace
    from orderflow.specs import ORDERS

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    events = tempfile.mkdtemp(prefix="orderflow-compare-")
    conf = {
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events, "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    }
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace.of(spark, sf_dir)

    def per_rule():
        out = standardize(ws.raw("orders"), ORDERS).withColumn("reasons", F.array().cast("array<string>"))
        for rule in ORDERS.rules:
            out = out.withColumn("reasons", F.when(rule.code().isNotNull(), F.concat("reasons", F.array(rule.code()))).otherwise(F.col("reasons")))
        return out.withColumn("record_status", F.when(F.size("reasons") == 0, "Valid").otherwise("Invalid"))

    def by_window(df, key, order):
        rest = [c for c in df.columns if c != key and c not in order]
        w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in (*order, *rest)])
        return df.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")

    def plain_valid_orders():
        orders, customers, products = by_window(ws.valid("orders"), ORDERS.key, ORDERS.dedup_order), ws.deduped("customers"), ws.deduped("products")
        return orders.join(customers.select("customer_id"), "customer_id", "left_semi").join(products.select("product_id"), "product_id", "left_semi")

    def plain_summary():
        full = plain_valid_orders().join(ws.deduped("customers").select("customer_id", "country"), "customer_id", "left").join(
            ws.deduped("products").select("product_id", "category", "price_cleaned"), "product_id", "left"
        )
        return marts.sales_summary(marts.add_measures(full), orders_unique=False)

    valid = ws.valid("orders").drop("record_status", "error_reason")
    unique = valid.withColumn("order_id", F.concat("order_id", F.lit("-"), F.monotonically_increasing_id().cast("string")))
    hot = valid.withColumn("order_id", F.when(F.xxhash64(*valid.columns) % 3 == 0, F.lit("O00001")).otherwise(F.col("order_id")))
    pairs = {
        "validate orders": (lambda: validate(ws.raw("orders"), ORDERS), per_rule),
        "dedup, repeated keys": (lambda: dedup(valid, "order_id", ORDERS.dedup_order), lambda: by_window(valid, "order_id", ORDERS.dedup_order)),
        "dedup, unique keys": (lambda: dedup(unique, "order_id", ORDERS.dedup_order), lambda: by_window(unique, "order_id", ORDERS.dedup_order)),
        "dedup, a key with a third": (lambda: dedup(hot, "order_id", ORDERS.dedup_order), lambda: by_window(hot, "order_id", ORDERS.dedup_order)),
        "referentially valid orders": (lambda: QUERIES["referentially_valid_orders"](spark, sf_dir), plain_valid_orders),
        "sales summary": (lambda: QUERIES["sales_summary"](spark, sf_dir), plain_summary),
    }
    seconds: dict[str, float] = {}
    for name, forms in pairs.items():
        for form, make in zip(("library", "plain"), forms, strict=True):
            for i in range(RUNS):
                spark.sparkContext.setJobGroup(f"{name}:{form}" if i == RUNS - 1 else "warm-up", name, False)
                t = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                t = time.perf_counter() - t
                seconds[f"{name}:{form}"] = min(t, seconds.get(f"{name}:{form}", t))
    spark.stop()
    work = work_of(events)
    print("| Input and form | library: s, shuffle MB, spill MB | plain: s, shuffle MB, spill MB |\n| --- | --- | --- |")
    for name in pairs:
        cells = []
        for form in ("library", "plain"):
            moved, spilled = work.get(f"{name}:{form}", (0.0, 0.0))
            cells.append(f"{seconds[f'{name}:{form}']:.2f}, {moved:.1f}, {spilled:.1f}")
        print(f"| {name} | {' | '.join(cells)} |")


if __name__ == "__main__":
    main()
