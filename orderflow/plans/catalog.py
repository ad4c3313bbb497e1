"""Registry of named queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the test tables in ``sf_dir`` (through the derived raw tables). Computed
columns carry the same names as in :mod:`orderflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import integrity, lookup, marts, summary
from orderflow.operators.validate import rule_codes, validate
from orderflow.plans import stages
from orderflow.plans.workspace import Workspace
from orderflow.session import new_work_dir
from orderflow.sources import io
from orderflow.specs import ENTITIES, INVALID, STATUS_COLUMN

Query = Callable[[SparkSession, str], DataFrame]

ID_COLUMNS = (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("orders", "customer_id"),
    ("orders", "product_id"),
)
NAME_COLUMNS = (("customers", "customer_name"), ("products", "product_name"))
TITLE_COLUMNS = (("customers", "country"), ("products", "category"), ("orders", "order_status"))


def _std_long(targets, upto: str) -> Query:
    """Long form (entity, column_name, raw_value, std_value) of one
    standardisation step over several columns."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = Workspace.of(spark, sf_dir)
        by_entity: dict[str, list[Column]] = {}
        for entity, column in targets:
            f = ENTITIES[entity].field(column)
            row = F.struct(F.lit(entity).alias("entity"), F.lit(column).alias("column_name"), F.col(f.raw).alias("raw_value"), f.expr(upto).alias("std_value"))
            by_entity.setdefault(entity, []).append(row)
        # One scan a table, whatever the number of its columns.
        return summary.union_all([ws.raw(entity).select(F.inline(F.array(*rows))) for entity, rows in by_entity.items()])

    return q


def _mapped_by_table(entity: str, column: str) -> Query:
    """P9-P11 with the synonyms in a table: (entity, column_name, raw_value,
    std_value) before sentinels."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = ENTITIES[entity].field(column)
        rows = Workspace.of(spark, sf_dir).raw(entity).select(
            F.lit(entity).alias("entity"), F.lit(column).alias("column_name"), F.col(f.raw).alias("raw_value"), f.expr("normalize").alias("std_value")
        )
        return lookup.map_from_table(rows, "std_value", lookup.lookup_table(spark, f.synonyms), key=f.synonym_key)

    return q


def _validated_by_table(entity: str, column: str) -> Query:
    """The whole entity validated with the synonyms of a field in a table."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = ENTITIES[entity]
        return validate(Workspace.of(spark, sf_dir).raw(entity), spec, {column: lookup.lookup_table(spark, spec.field(column).synonyms)})

    return q


def _parse(entity: str, column: str) -> Query:
    """(raw_value, parsed_value) of one parsing field."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = ENTITIES[entity].field(column)
        raw = Workspace.of(spark, sf_dir).raw(entity)
        return raw.select(F.col(f.raw).alias("raw_value"), f.expr().cast(f.dtype).alias("parsed_value"))

    return q


def _sentinels(entity: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = [
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.raw).alias("raw_value"), f.expr().alias("std_value"))
            for f in ENTITIES[entity].fields
            if f.sentinels is not None
        ]
        return Workspace.of(spark, sf_dir).raw(entity).select(F.inline(F.array(*rows)))

    return q


def _rule(entity: str, rule: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rule_codes(Workspace.of(spark, sf_dir).raw(entity), ENTITIES[entity], rule)

    return q


def _ws(fn: Callable[[Workspace], DataFrame]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Workspace.of(spark, sf_dir))

    return q


def _wide(fn: Callable[[Workspace], DataFrame]) -> Query:
    """Over raw tables with ids of 12 digits that do not wrap."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Workspace.of(spark, sf_dir, wide=True))

    return q


def _keyed(frames: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str]]:
    return {n: (df, ENTITIES[n].key) for n, df in frames.items()}


# --- sources and sinks -----------------------------------------------------
def _csv_roundtrip(entity: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = Workspace.of(spark, sf_dir)
        return io.read_csv(spark, ws.raw_csv_path(entity))

    return q


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan each processed table (both splits): rows per status."""
    ws = Workspace.of(spark, sf_dir)
    return summary.union_all(
        [
            ws.processed(n, split=None)
            .groupBy(STATUS_COLUMN)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(n).alias("dataset"), STATUS_COLUMN, "row_count")
            for n in ENTITIES
        ]
    )


def _parquet_roundtrip(entity: str) -> Query:
    """Overwrite twice (the second write must replace, not append)."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = Workspace.of(spark, sf_dir)
        path = f"{new_work_dir(spark, 'roundtrip')}/{entity}"
        validated = ws.validated(entity)
        io.write_parquet(validated.where(F.col(STATUS_COLUMN) == INVALID), path)
        io.write_parquet(validated, path)
        return io.read_parquet(spark, path)

    return q


def etl_output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 (+ S1, S4-S8): raw CSV zone -> stage 1 -> stage 2; rows of every
    written dataset."""
    outputs = Workspace.of(spark, sf_dir).etl()
    return summary.table_counts({name: io.read_parquet(spark, path) for name, path in outputs.items()})


def _etl(name: str) -> Query:
    """A dataset that the end-to-end run has written, read as any consumer would."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(Workspace.of(spark, sf_dir).etl()[name])

    return q


def _release(name: str) -> Query:
    """A table that the manifest of a published run names."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(Workspace.of(spark, sf_dir).release()[name])

    return q


def _batches(name: str) -> Query:
    """A table of the release after the raw files came in two batches."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(Workspace.of(spark, sf_dir).batches()[name])

    return q


def _malformed(entity: str) -> Query:
    """The quarantined lines with too few or too many fields."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(Workspace.of(spark, sf_dir).malformed_run().outputs[f"malformed_{entity}"])

    return q


def _well_formed(entity: str) -> Query:
    """What stage 1 makes of the other lines (valid and quarantined rows)."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        outputs = Workspace.of(spark, sf_dir).malformed_run().outputs
        return spark.read.parquet(outputs[f"valid_{entity}"]).unionByName(spark.read.parquet(outputs[f"invalid_{entity}"]))

    return q


def malformed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines a table, counted while stage 1 writes (their rows go on)."""
    ws = Workspace.of(spark, sf_dir)
    raw = {n: io.read_csv(spark, ws.malformed_csv_path(n), mark_malformed=True) for n in ENTITIES}
    return stages.process_raw(spark, raw, io.Zones(new_work_dir(spark, "malformed"))).frames["malformed_summary"]


def curate_plain_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 over processed tables that have no verdict columns."""
    zones = Workspace.of(spark, sf_dir).plain_processed()
    return spark.read.parquet(stages.curate(spark, zones).outputs["sales_summary"])


def _csv_mixed_headers(entity: str) -> Query:
    """A table in two folders whose headers differ in order and case,
    bound by name and validated."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = Workspace.of(spark, sf_dir).raw(entity)
        root = new_work_dir(spark, "mixed-headers")
        first = F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == 0
        io.write_csv(raw.where(first), f"{root}/a")
        io.write_csv(raw.where(~first).select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)]), f"{root}/b")
        return validate(io.read_csv(spark, [f"{root}/b", f"{root}/a"]), ENTITIES[entity]).select(*validate(raw, ENTITIES[entity]).columns)

    return q


def _retype(entity: str) -> Query:
    """P13 over a copy of the valid rows that is all text."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        valid = Workspace.of(spark, sf_dir).valid(entity)
        path = f"{new_work_dir(spark, 'text-copy')}/{entity}"
        io.write_parquet(valid.select(*[F.col(c).cast("string") for c in valid.columns]), path)
        return io.retype(io.read_parquet(spark, path), entity)

    return q


# --- curated ----------------------------------------------------------------
def _orphans(parent: str, key: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = Workspace.of(spark, sf_dir)
        return integrity.orphans(ws.deduped("orders"), ws.parent(parent), key)

    return q


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace.of(spark, sf_dir)
    return integrity.with_parent(ws.deduped("orders"), ws.parent("customers"), "customer_id")


def referentially_valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace.of(spark, sf_dir)
    with_customer = integrity.with_parent(ws.deduped("orders"), ws.parent("customers"), "customer_id")
    return integrity.with_parent(with_customer, ws.parent("products"), "product_id")


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_summary(Workspace.of(spark, sf_dir).measured())


QUERIES: dict[str, Query] = {
    # S1-S8
    "csv_roundtrip_customers": _csv_roundtrip("customers"),
    "csv_roundtrip_products": _csv_roundtrip("products"),
    "csv_roundtrip_orders": _csv_roundtrip("orders"),
    "parquet_scan": parquet_scan,
    "parquet_roundtrip": _parquet_roundtrip("customers"),
    "parquet_roundtrip_products": _parquet_roundtrip("products"),
    "parquet_roundtrip_orders": _parquet_roundtrip("orders"),
    "quarantine_customers": _ws(lambda ws: ws.quarantine("customers")),
    "quarantine_products": _ws(lambda ws: ws.quarantine("products")),
    "quarantine_orders": _ws(lambda ws: ws.quarantine("orders")),
    "etl_output_counts": etl_output_counts,
    "pipeline_output_counts": etl_output_counts,
    **{f"etl_{name}": _etl(name) for name in (*stages.ORPHAN_OUTPUTS, *stages.CURATED_OUTPUTS)},
    **{f"published_{kind}_{n}": _etl(f"{kind}_{n}") for kind in ("valid", "invalid") for n in ENTITIES},
    **{f"release_{name}": _release(name) for name in (*stages.ORPHAN_OUTPUTS, *stages.CURATED_OUTPUTS, "validation_summary")},
    **{f"batches_{name}": _batches(name) for name in (*stages.ORPHAN_OUTPUTS, *stages.CURATED_OUTPUTS)},
    "csv_malformed_lines": _malformed("orders"),
    "csv_malformed_lines_customers": _malformed("customers"),
    "csv_malformed_lines_products": _malformed("products"),
    **{f"csv_well_formed_{n}": _well_formed(n) for n in ENTITIES},
    "malformed_summary": malformed_summary,
    "curate_plain_processed": curate_plain_processed,
    "csv_mixed_headers": _csv_mixed_headers("customers"),
    "csv_mixed_headers_products": _csv_mixed_headers("products"),
    "csv_mixed_headers_orders": _csv_mixed_headers("orders"),
    # P1-P13
    "std_ids": _std_long(ID_COLUMNS, "normalize"),
    "std_names": _std_long(NAME_COLUMNS, "normalize"),
    "std_email": _std_long((("customers", "email"),), "normalize"),
    "std_title_case": _std_long(TITLE_COLUMNS, "normalize"),
    "parse_lifetime_value": _parse("customers", "lifetime_value_cleaned"),
    "parse_price": _parse("products", "price_cleaned"),
    "parse_stock_qty": _parse("products", "stock_qty"),
    "parse_quantity": _parse("orders", "quantity"),
    "parse_signup_date": _parse("customers", "signup_date_cleaned"),
    "parse_order_date": _parse("orders", "order_date_cleaned"),
    "map_country": _std_long((("customers", "country"),), "synonyms"),
    "map_category": _std_long((("products", "category"),), "synonyms"),
    "map_order_status": _std_long((("orders", "order_status"),), "synonyms"),
    "map_country_table": _mapped_by_table("customers", "country"),
    "map_category_table": _mapped_by_table("products", "category"),
    "map_order_status_table": _mapped_by_table("orders", "order_status"),
    "validate_customers_table": _validated_by_table("customers", "country"),
    "validate_products_table": _validated_by_table("products", "category"),
    "validate_orders_table": _validated_by_table("orders", "order_status"),
    "null_sentinels_customers": _sentinels("customers"),
    "null_sentinels_products": _sentinels("products"),
    "null_sentinels_orders": _sentinels("orders"),
    "retype_processed": _retype("orders"),
    "retype_customers": _retype("customers"),
    "retype_products": _retype("products"),
    # V1-V18, F1
    **{r.name: _rule(spec.name, r.name) for spec in ENTITIES.values() for r in spec.rules},
    "validate_customers": _ws(lambda ws: ws.validated("customers")),
    "validate_products": _ws(lambda ws: ws.validated("products")),
    "validate_orders": _ws(lambda ws: ws.validated("orders")),
    "valid_customers": _ws(lambda ws: ws.valid("customers")),
    "valid_products": _ws(lambda ws: ws.valid("products")),
    "valid_orders": _ws(lambda ws: ws.valid("orders")),
    # A1-A5, U1-U2
    "validation_summary": _ws(lambda ws: summary.validation_summary({n: ws.validated(n) for n in ENTITIES})),
    "table_counts": _ws(lambda ws: summary.table_counts({n: ws.raw(n) for n in ENTITIES})),
    "distinct_key_counts": _ws(lambda ws: summary.distinct_key_counts(_keyed({n: ws.valid(n) for n in ENTITIES}))),
    "duplicate_keys": _ws(lambda ws: summary.duplicate_keys(_keyed({n: ws.valid(n) for n in ENTITIES}))),
    "duplicate_summary_before": _ws(
        lambda ws: summary.duplicate_summary(_keyed({n: ws.valid(n) for n in ENTITIES}))
    ),
    "duplicate_summary_after": _ws(
        lambda ws: summary.duplicate_summary(_keyed({n: ws.deduped(n) for n in ENTITIES}))
    ),
    # D1
    "dedup_customers": _ws(lambda ws: ws.deduped("customers")),
    "dedup_products": _ws(lambda ws: ws.deduped("products")),
    "dedup_orders": _ws(lambda ws: ws.deduped("orders")),
    # J1-J6
    "orphan_customer_orders": _orphans("customers", "customer_id"),
    "orphan_product_orders": _orphans("products", "product_id"),
    "orders_with_customer": orders_with_customer,
    "referentially_valid_orders": referentially_valid_orders,
    "enriched_orders": _ws(lambda ws: marts.enrich(ws.tagged())),
    # M1-M4, K1-K4, A6-A9
    "order_amounts": _ws(lambda ws: ws.measured()),
    "customer_metrics": _ws(lambda ws: marts.customer_metrics(ws.measured())),
    "product_metrics": _ws(lambda ws: marts.product_metrics(ws.measured())),
    "sales_summary": sales_summary,
    "status_counts": _ws(lambda ws: marts.status_counts(ws.measured())),
    "fact_orders": _ws(lambda ws: marts.fact_orders(ws.measured())),
    "wide_validation_summary": _wide(lambda ws: summary.validation_summary({n: ws.validated(n) for n in ENTITIES})),
    "wide_duplicate_summary": _wide(lambda ws: summary.duplicate_summary(_keyed({n: ws.valid(n) for n in ENTITIES}))),
    "wide_orphan_customer_orders": _wide(lambda ws: integrity.orphans(ws.deduped("orders"), ws.parent("customers"), "customer_id")),
    "wide_customer_metrics": _wide(lambda ws: marts.customer_metrics(ws.measured())),
    "wide_product_metrics": _wide(lambda ws: marts.product_metrics(ws.measured())),
    "wide_sales_summary": _wide(lambda ws: marts.sales_summary(ws.measured())),
    "wide_fact_orders": _wide(lambda ws: marts.fact_orders(ws.measured())),
    "dim_customers": _ws(lambda ws: marts.dim_customers(ws.deduped("customers"))),
    "dim_products": _ws(lambda ws: marts.dim_products(ws.deduped("products"))),
}
