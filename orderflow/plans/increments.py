"""E1 -> E2 on new raw files: the last run's tables extended by a batch.

A run keeps, besides the published tables, its deduplicated customers,
products and orders (the state). A batch of new files is standardised and
validated on its own; then only what it changes is computed:

* the survivor of a key is the least row of the state's survivor and the
  batch's rows, so orders are compared with the state on the batch's keys only;
* a changed order takes its old row's share out of the marts and puts the new
  one's in; so does an order of the state whose customer or product is new or
  has changed (an orphan may thereby become a sale);
* the marts are counts and sums by key, merged with the last run's; first and
  last dates are merged too, and are found anew only for customers from whom
  something was taken out;
* the fact table and the orphans are the last run's without the rows taken
  out, and the new ones.

Any split of the raw files into batches gives the tables of one whole run.
Every batch is published as a release (see :mod:`orderflow.plans.releases`).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.operators import marts
from orderflow.operators.dedup import dedup, dedup_valid
from orderflow.operators.integrity import key_first, orphans
from orderflow.plans import releases, stages
from orderflow.sources import files, io
from orderflow.specs import CUSTOMERS, ENTITIES, ORDERS, PRODUCTS

STATE = {n: f"state_{n}" for n in ENTITIES}
_NEW, _SIGN = "__new", "__sign"


def _on_key(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, how).select(*df.columns)


def _changed(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys of parents that are new or whose row is another one."""
    held = old.select(F.col(key).alias("k"), F.struct(*[c for c in old.columns if c != key]).alias("was"))
    now = new.select(F.col(key), F.struct(*[c for c in old.columns if c != key]).alias("now"))
    return now.join(held, F.col(key) == F.col("k"), "left").where(~F.col("now").eqNullSafe(F.col("was"))).select(key)


def _signed(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """What comes in and what goes out, with its sign."""
    return plus.withColumn(_SIGN, F.lit(1)).unionByName(minus.withColumn(_SIGN, F.lit(-1)))


def _merged(last: DataFrame, change: DataFrame, keys: tuple[str, ...], count: str, more: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts and sums by key over the last mart and the changes; keys without
    an order left are gone."""
    both = last.unionByName(change)
    sums = [c for c in last.columns if c not in keys and c not in (more or {})]
    out = both.groupBy(*keys).agg(*[F.sum(c).cast(last.schema[c].dataType).alias(c) for c in sums], *[c.alias(n) for n, c in (more or {}).items()])
    return out.where(F.col(count) > 0).select(*last.columns)


def _change(signed: DataFrame, last: DataFrame, keys: tuple[str, ...], values: Mapping[str, Column]) -> DataFrame:
    """The signed changes aggregated in the shape of a mart."""
    found = signed.groupBy(*keys).agg(*[F.sum(v * F.col(_SIGN)).cast(last.schema[n].dataType).alias(n) for n, v in values.items()])
    return found.select(*keys, *values)


def extend(state: Mapping[str, DataFrame], batch: Mapping[str, DataFrame], work: str) -> dict[str, DataFrame]:
    """State, marts, star schema and orphans after a batch of valid rows.

    ``state`` has the tables that this function returns, from the last run;
    ``batch`` the valid rows of each entity. Intermediate tables are written
    below ``work``, which must stay until the result is written."""
    spark = batch["orders"].sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        io.write_parquet(df, f"{work}/{name}")
        return io.read_parquet(spark, f"{work}/{name}", df.schema)

    old = {n: state[STATE[n]] for n in ENTITIES}
    parents = {
        s.name: written(dedup_valid(old[s.name].unionByName(batch[s.name].select(*old[s.name].columns)), s), s.name) for s in (CUSTOMERS, PRODUCTS)
    }
    changed = {s.name: written(_changed(parents[s.name], old[s.name], s.key), f"changed_{s.name}") for s in (CUSTOMERS, PRODUCTS)}

    # Survivors of the batch's keys; equal rows: that of the state.
    key = ORDERS.key
    came = written(dedup_valid(batch["orders"].select(*old["orders"].columns), ORDERS), "came")
    same = _on_key(old["orders"], came, key, "left_semi")
    rivals = same.withColumn(_NEW, F.lit(1)).unionByName(came.withColumn(_NEW, F.lit(2)))
    added = written(dedup(rivals, key, ORDERS.dedup_order).where(F.col(_NEW) == 2).drop(_NEW), "added")
    replaced = written(_on_key(old["orders"], added, key, "left_semi"), "replaced")
    kept = _on_key(old["orders"], added, key, "left_anti")
    by_parent = [_on_key(kept, changed[s.name], s.key, "left_semi") for s in (CUSTOMERS, PRODUCTS)]
    moved = written(by_parent[0].unionByName(by_parent[1]).dropDuplicates([key]), "moved")
    out_rows, in_rows = replaced.unionByName(moved), added.unionByName(moved)

    # Tagged once with the parents as they were, once as they are.
    tagged_out = written(marts.tag_orders(out_rows, old["customers"], old["products"]), "out")
    tagged_in = written(marts.tag_orders(in_rows, parents["customers"], parents["products"]), "in")
    minus, plus = (marts.add_measures(marts.enrich(t)) for t in (tagged_out, tagged_in))
    signed = _signed(plus, minus)

    one = F.lit(1)
    sales = _change(
        signed,
        state["sales_summary"],
        ("order_date_cleaned", "country", "category"),
        {
            "total_orders": one,
            "total_quantity": F.col("quantity"),
            "total_sales": F.col("recognized_sales"),
            **{name: F.when(condition, 1).otherwise(0) for name, condition in marts.status_conditions().items()},
        },
    )
    products = _change(
        signed,
        state["product_metrics"],
        ("product_id", "product_name", "category"),
        {"total_units_sold": F.col("quantity"), "total_sales": F.col("order_amount"), "number_of_orders": one},
    )
    by_customer = ("customer_id", "customer_name", "country")
    customers = _change(
        signed, state["customer_metrics"], by_customer, {"total_orders": one, "total_quantity": F.col("quantity"), "total_spend": F.col("order_amount")}
    )
    dates = {"first_order_date": F.min("first_order_date"), "last_order_date": F.max("last_order_date")}
    spans = plus.groupBy(*by_customer).agg(F.min("order_date_cleaned").alias("first_order_date"), F.max("order_date_cleaned").alias("last_order_date"))
    span_columns = [c for c in state["customer_metrics"].columns if c not in (*by_customer, *dates)]
    no_counts = spans.select(*by_customer, *[F.lit(0).cast(state["customer_metrics"].schema[c].dataType).alias(c) for c in span_columns], *dates)
    no_dates = customers.select(*by_customer, *span_columns, *[F.lit(None).cast("date").alias(c) for c in dates])
    orders = kept.unionByName(added)
    merged = _merged(state["customer_metrics"], no_counts.unionByName(no_dates), by_customer, "total_orders", dates)
    # Who lost an order may have lost the first or the last one.
    lost = written(minus.select("customer_id").distinct(), "lost")
    anew = marts.tag_orders(_on_key(orders, lost, "customer_id", "left_semi"), parents["customers"], parents["products"])
    customer_metrics = _on_key(merged, lost, "customer_id", "left_anti").unionByName(
        marts.customer_metrics(marts.add_measures(marts.enrich(anew))).select(*merged.columns)
    )

    gone = out_rows.select(key)
    result = {
        STATE["customers"]: parents["customers"],
        STATE["products"]: parents["products"],
        STATE["orders"]: orders,
        "dim_customers": marts.dim_customers(parents["customers"]),
        "dim_products": marts.dim_products(parents["products"]),
        "fact_orders": _on_key(state["fact_orders"], gone, key, "left_anti").unionByName(marts.fact_orders(plus)),
        "sales_summary": _merged(state["sales_summary"], sales, ("order_date_cleaned", "country", "category"), "total_orders"),
        "product_metrics": _merged(state["product_metrics"], products, ("product_id", "product_name", "category"), "number_of_orders"),
        "customer_metrics": customer_metrics,
    }
    for parent, parent_key, flag in (("customers", "customer_id", marts.HAS_CUSTOMER), ("products", "product_id", marts.HAS_PRODUCT)):
        name = f"orphan_{parent}"
        fresh = key_first(tagged_in.where(~F.col(flag)).select(*in_rows.columns), parent_key, in_rows.columns)
        result[name] = _on_key(state[name], gone, key, "left_anti").unionByName(fresh)
    return result


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    """The tables before the first batch."""
    none = {n: spark.createDataFrame([], StructType.fromDDL(s.processed_ddl())) for n, s in ENTITIES.items()}
    measured = marts.add_measures(marts.enrich(marts.tag_orders(none["orders"], none["customers"], none["products"])))
    return {
        **{STATE[n]: df for n, df in none.items()},
        "dim_customers": marts.dim_customers(none["customers"]),
        "dim_products": marts.dim_products(none["products"]),
        "fact_orders": marts.fact_orders(measured),
        "customer_metrics": marts.customer_metrics(measured),
        "product_metrics": marts.product_metrics(measured),
        "sales_summary": marts.sales_summary(measured),
        **{f"orphan_{p}": key_first(orphans(none["orders"], none[p], k), k, none["orders"].columns) for p, k in (("customers", "customer_id"), ("products", "product_id"))},
    }


def _new_files(spark: SparkSession, zones: io.Zones, before: releases.Release | None) -> dict[str, list[list]]:
    """Raw files that no earlier batch has read, by entity."""
    read = {n: [tuple(f) for f in fs] for n, fs in (before.consumed if before else {}).items()}
    found = {n: files.listing(spark, zones.raw(n)) if files.exists(spark, zones.raw(n)) else [] for n in ENTITIES}
    gone = [f[0] for n, fs in read.items() for f in fs if f not in set(found[n])]
    if gone:
        raise ValueError(f"raw file(s) of an earlier batch changed or are gone, publish the whole again: {gone[:3]}")
    return {n: [list(f) for f in fs if f not in set(read.get(n, ()))] for n, fs in found.items()}


def publish_batch(spark: SparkSession, zones: io.Zones, keep: int = releases.KEPT_RELEASES) -> stages.StageResult:
    """Extend the current release by the raw files that are new since then,
    and switch the manifest. Without new files nothing is written. The
    validation summary and the processed tables are those of the batch; a
    release that :func:`releases.publish` wrote has no state to extend."""
    before = releases.current(spark, zones)
    if before is not None and STATE["orders"] not in before.outputs:
        raise ValueError("the current release has no state: it was published as a whole")
    fresh = _new_files(spark, zones, before)
    if not any(fresh.values()):
        return stages.StageResult(dict(before.outputs) if before else {})
    said = json.dumps([before.run if before else "", fresh], sort_keys=True)
    run = hashlib.sha256(said.encode()).hexdigest()[:16]
    own = releases.release_zones(zones, run)
    ledger = releases.Ledger(spark, own.curated(releases.MARKERS))

    raw = {n: (lambda fs=fs: io.read_csv_files(spark, [f[0] for f in fs])) for n, fs in fresh.items() if fs}
    first = stages.process_raw(spark, raw, own, ledger)
    state = empty_state(spark)
    if before is not None:
        state = {n: io.read_parquet(spark, before.outputs[n], df.schema) for n, df in state.items()}

    def extended() -> dict:
        batch = {n: io.read_valid(spark, own.processed(n), n) if n in raw else state[STATE[n]].where(F.lit(False)) for n in ENTITIES}
        tables = extend(state, batch, ledger.work)
        done = stages.StageResult()
        stages._write_all({n: (df, own.curated(n)) for n, df in tables.items()}, done, ledger=ledger)
        return done.outputs

    outputs = {**first.outputs, **ledger.once("curated", extended)}
    files.delete(spark, ledger.work)
    consumed = {n: [*(before.consumed.get(n, []) if before else []), *fs] for n, fs in fresh.items()}
    releases.switch(spark, zones, run, outputs, keep, consumed)
    return stages.StageResult(outputs, first.frames)
