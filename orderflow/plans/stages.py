"""The two batch stages and the gated end-to-end run.

Stage 1 (raw -> processed): one scan and one write job per entity. The
validated rows are written into the valid and the quarantine folder while an
``Observation`` counts total / valid / invalid rows in the same job, so the
validation summary needs no further pass over the data.

Stage 2 (processed -> curated): every intermediate that more than one
output needs is staged once in a work folder and read back: the deduplicated
parents and the tagged orders (the order columns, the three parent attributes
that the marts need, and presence flags). The orphan quarantines are written
before any curated table; the fact table and the metric tables are narrow
reads of the tagged orders, and customer and product names join the metrics
after the aggregation. The work folder is deleted at the end.

Stage boundaries are Parquet: Catalyst plans stage 2 against plain scans,
not against the validation expressions of stage 1 (planning a filter,
dedup and joins on top of un-materialised rule expressions is very slow),
and a lost executor costs a task retry, not a rerun of the stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import marts
from orderflow.operators.dedup import AGAIN, dedup_valid_marked
from orderflow.operators.integrity import key_first
from orderflow.operators.summary import duplicate_summaries_from_marks, status_counts_exprs, validation_summary_from_counts
from orderflow.operators.validate import validate
from orderflow.session import new_work_dir, remove_dir
from orderflow.sources import io
from orderflow.specs import ENTITIES, REASON_COLUMN, STATUS_COLUMN, VALID

MALFORMED_COUNT = "Malformed_count"
ORPHAN_OUTPUTS = ("orphan_customers", "orphan_products")
CURATED_OUTPUTS = (
    "customer_metrics",
    "product_metrics",
    "sales_summary",
    "dim_customers",
    "dim_products",
    "fact_orders",
)


def run_concurrently(jobs: Mapping[str, Callable[[], object]], spark: SparkSession | None = None) -> dict[str, object]:
    """Submit independent Spark actions from driver threads.

    The jobs share the cluster's task slots, so a small output does not wait
    for a large one and per-job latency overlaps. The caller's local
    properties (job group, scheduler pool, description) carry over to the
    worker threads. An exception in any job is re-raised after all of them
    finished.
    """
    if len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    wrap = inheritable_thread_target(spark) if spark is not None else inheritable_thread_target
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(wrap(job)) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class StageResult:
    outputs: dict[str, str] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)


class Finished(Protocol):
    """Remembers finished outputs of a run (``releases.Ledger``)."""

    work: str

    def once(self, name: str, job: Callable[[], Mapping | None]) -> Mapping: ...


def _once(ledger: Finished | None, name: str, job: Callable[[], Mapping | None]) -> Mapping:
    return (job() or {}) if ledger is None else ledger.once(name, job)


def _write_all(
    outputs: Mapping[str, tuple[DataFrame, str]],
    result: StageResult,
    partition_by: Mapping[str, tuple[str, ...]] | None = None,
    ledger: Finished | None = None,
) -> None:
    layout = partition_by or {}
    spark = next(iter(outputs.values()))[0].sparkSession if outputs else None

    def write(name: str, df: DataFrame, path: str) -> None:
        if layout.get(name):
            io.write_partitioned(df, path, layout[name])
        else:
            io.write_parquet(df, path)

    def job(name: str, df: DataFrame, path: str) -> Callable[[], object]:
        return lambda: _once(ledger, name, lambda: write(name, df, path))

    run_concurrently({n: job(n, df, path) for n, (df, path) in outputs.items()}, spark)
    for n, (_, path) in outputs.items():
        result.outputs[n] = path


def process_raw(
    spark: SparkSession,
    raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
    zones: io.Zones,
    ledger: Finished | None = None,
    quarantine_malformed: bool = False,
) -> StageResult:
    """Standardise, validate, split and summarise each raw entity. A raw
    table may be given as a function that reads it; with a ``ledger``, entities
    that it says are finished are neither read nor written.

    Where the raw tables mark malformed lines (``io.read_csv``), these are
    counted in the same job (``malformed_summary``) and their rows, padded or
    cut, go on; with ``quarantine_malformed`` the lines are written to a
    quarantine of their own instead (one more scan), and no row is made of them."""
    result = StageResult()

    def process(name: str, given: DataFrame | Callable[[], DataFrame]) -> Callable[[], Mapping]:
        def job() -> dict:
            df = given if isinstance(given, DataFrame) else given()
            marked, apart = io.MALFORMED in df.columns, {}
            if marked and quarantine_malformed:
                seen = Observation(f"malformed_{name}_{uuid.uuid4().hex[:8]}")
                lines = io.malformed_lines(df).observe(seen, F.count(F.lit(1)).alias(MALFORMED_COUNT))
                io.write_parquet(lines, zones.malformed(name))
                apart = seen.get
                df = df.where(F.col(io.MALFORMED).isNull())
            obs = Observation(f"validation_{name}_{uuid.uuid4().hex[:8]}")  # unique per run
            validated = validate(df, ENTITIES[name])
            counted = [F.count_if(F.col(io.MALFORMED).isNotNull()).alias(MALFORMED_COUNT)] if marked and not apart else []
            observed = validated.observe(obs, *status_counts_exprs(), *counted)
            io.write_processed(observed.drop(io.MALFORMED), zones.processed(name))
            return {**obs.get, **apart}

        return lambda: _once(ledger, f"processed_{name}", job)

    counts = run_concurrently({name: process(name, df) for name, df in raw.items()}, spark)
    for name in counts:
        result.outputs[f"valid_{name}"] = zones.valid(name)
        result.outputs[f"invalid_{name}"] = zones.quarantine(name)
        if MALFORMED_COUNT in counts[name] and quarantine_malformed:
            result.outputs[f"malformed_{name}"] = zones.malformed(name)
    malformed = [(name, int(c[MALFORMED_COUNT])) for name, c in counts.items() if MALFORMED_COUNT in c]
    if malformed:
        result.frames["malformed_summary"] = spark.createDataFrame(malformed, "dataset string, malformed_count bigint")
    summary = validation_summary_from_counts(spark, counts)
    _once(ledger, "validation_summary", lambda: io.write_parquet(summary.coalesce(1), zones.validation_summary))
    result.outputs["validation_summary"] = zones.validation_summary
    result.frames["validation_summary"] = io.read_parquet(spark, zones.validation_summary)
    return result


def curate(
    spark: SparkSession,
    zones: io.Zones,
    partition_by: Mapping[str, tuple[str, ...]] | None = None,
    ledger: Finished | None = None,
) -> StageResult:
    """Dedup, referential integrity, enrichment, marts, star schema.

    Curated tables are unpartitioned unless ``partition_by`` names columns
    for an output (e.g. ``{"sales_summary": ("order_date_cleaned",)}``). With a
    ``ledger`` the intermediate tables of a broken run stay, and it goes on with
    the outputs that are missing."""
    result = StageResult()
    if ledger is not None:

        def job() -> dict:
            _curate_in(spark, zones, ledger.work, result, partition_by, ledger)
            return result.outputs

        result.outputs = dict(ledger.once("curated", job))
        remove_dir(spark, ledger.work)  # with the markers of what is in it
        return result
    work = new_work_dir(spark, "curate")
    try:
        _curate_in(spark, zones, work, result, partition_by)
    finally:
        remove_dir(spark, work)
    return result


def _curate_in(
    spark: SparkSession,
    zones: io.Zones,
    work: str,
    result: StageResult,
    partition_by: Mapping[str, tuple[str, ...]] | None,
    ledger: Finished | None = None,
) -> None:
    valid = {name: io.read_valid(spark, zones.processed(name), name) for name in ENTITIES}
    # Survivors, and a marked second row of every repeated key: both duplicate
    # summaries come from the pass that deduplicates.
    marked = {n: dedup_valid_marked(df, ENTITIES[n]) for n, df in valid.items()}

    # The parents are the join inputs of the orders and the curated dims.
    attributes = {"customers": marts.dim_customers, "products": marts.dim_products}
    rows = {n: marked[n].select(*dim(marked[n]).columns, AGAIN) for n, dim in attributes.items()}
    run_concurrently({n: (lambda df=df, n=n: _once(ledger, f"work/{n}", lambda: io.write_split(df, f"{work}/{n}", (AGAIN,)))) for n, df in rows.items()}, spark)
    parents = {n: io.read_parquet(spark, f"{work}/{n}", df.schema) for n, df in rows.items()}
    customers, products = (parents[n].where(~F.col(AGAIN)).drop(AGAIN) for n in attributes)

    # Partitioned by the two presence flags and the mark: the orphan outputs and
    # the marts each read only their own files. The dedup has dealt the rows out
    # evenly, and a task writes at most eight files. The verdict is the same on
    # every row and is put back where it is published.
    order_cols = valid["orders"].columns
    verdict = {STATUS_COLUMN: F.lit(VALID), REASON_COLUMN: F.lit(None).cast("string")}
    tag_df = marts.tag_orders(marked["orders"], customers, products, marts.ORDER_CUSTOMER_ATTRS, marts.ORDER_PRODUCT_ATTRS)
    flags = (marts.HAS_CUSTOMER, marts.HAS_PRODUCT, AGAIN)
    _once(ledger, "work/tagged", lambda: io.write_split(tag_df, f"{work}/tagged", flags))
    every = io.read_parquet(spark, f"{work}/tagged", tag_df.schema)
    tagged = every.where(~F.col(AGAIN)).drop(AGAIN)

    # Orphans before the curated tables; an order missing both parents lands
    # in both quarantines.
    orphans: dict[str, tuple[DataFrame, str]] = {}
    for parent, key, flag in (
        ("customers", "customer_id", marts.HAS_CUSTOMER),
        ("products", "product_id", marts.HAS_PRODUCT),
    ):
        lost = tagged.where(~F.col(flag)).withColumns(verdict)
        orphans[f"orphan_{parent}"] = (key_first(lost, key, order_cols), zones.orphans(parent))
    _write_all(orphans, result, ledger=ledger)

    measured = marts.add_measures(marts.retained(tagged))
    curated = {
        "dim_customers": customers,
        "dim_products": products,
        "customer_metrics": marts.customer_metrics(measured, customers),
        "product_metrics": marts.product_metrics(measured, products),
        "sales_summary": marts.sales_summary(measured),
        "fact_orders": marts.fact_orders(measured),
    }
    _write_all({n: (df, zones.curated(n)) for n, df in curated.items()}, result, partition_by, ledger)

    # Computed now, from tables that go with the work folder: three rows each.
    totals = {n: df.count() for n, df in valid.items()}  # from the files' footers
    tables = {n: (df, ENTITIES[n].key, totals[n]) for n, df in {**parents, "orders": every}.items()}
    for name, df in zip(("duplicate_summary_before", "duplicate_summary_after"), duplicate_summaries_from_marks(tables, AGAIN), strict=True):
        counts = df.agg(F.collect_list(F.struct(*df.columns))).first()[0]
        result.frames[name] = spark.createDataFrame(counts, df.schema)


def run(
    spark: SparkSession,
    zones: io.Zones,
    *,
    show_summaries: bool = False,
    partition_by: Mapping[str, tuple[str, ...]] | None = None,
) -> StageResult:
    """Stage 1 over the raw CSV zone, then stage 2. An exception in stage
    1 stops the run before stage 2 starts."""
    raw = {name: io.read_csv(spark, zones.raw(name)) for name in ENTITIES}
    first = process_raw(spark, raw, zones)
    if show_summaries:
        first.frames["validation_summary"].show(truncate=False)
    second = curate(spark, zones, partition_by)
    if show_summaries:
        second.frames["duplicate_summary_before"].show(truncate=False)
        second.frames["duplicate_summary_after"].show(truncate=False)
    return StageResult(
        outputs={**first.outputs, **second.outputs},
        frames={**first.frames, **second.frames},
    )
