"""Per-session access to the derived tables the registered queries share.

A workspace derives the raw tables from a test-data folder and lands each
once as Parquet under the shared checkpoint folder, rebalanced into evenly
sized files the way a raw zone arrives as many files (the test tables are
single-row-group files, which Spark cannot split, so without this every
narrow stage after them would run as one task). It then
materialises the processed zone once (stage 1) and builds every later table
lazily on top of it, so each query plan starts from plain Parquet scans
(see ``plans.stages``).
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import marts
from orderflow.operators.dedup import dedup_valid
from orderflow.operators.validate import validate
from orderflow.plans import increments, releases, stages
from orderflow.session import app_id, new_work_dir
from orderflow.sources import fixtures, io
from orderflow.specs import ENTITIES, REASON_COLUMN, STATUS_COLUMN, wide_entities

_CACHE: dict[tuple[str, str, bool], Workspace] = {}
_CACHE_LOCK = threading.Lock()


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, wide: bool = False):
        self.spark = spark
        self.wide = wide
        self.entities = wide_entities() if wide else ENTITIES
        self.sf_dir = sf_dir.rstrip("/")
        self.zones = io.Zones(new_work_dir(spark, "workspace"))
        self._written: dict[str, object] = {}
        # One lock per table: callers on several threads write each table once.
        self._locks: dict[str, threading.Lock] = {}
        self._locks_guard = threading.Lock()

    def _once(self, tag: str, write) -> object:
        """Run ``write`` (returning the written schema) the first time ``tag``
        is asked for; later callers get the recorded schema."""
        if tag in self._written:
            return self._written[tag]
        with self._locks_guard:
            lock = self._locks.setdefault(tag, threading.Lock())
        with lock:
            if tag not in self._written:
                self._written[tag] = write()
        return self._written[tag]

    def _materialised(self, tag: str, write, read) -> DataFrame:
        """``read(schema)`` of a table written once by ``write``; if its files
        were removed since (a cleaned shared folder), write it again."""
        for attempt in (0, 1):
            schema = self._once(tag, write)
            try:
                return read(schema)
            except AnalysisException:
                if attempt:
                    raise
                self._written.pop(tag, None)
        raise AssertionError("unreachable")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, wide: bool = False) -> Workspace:
        """The workspace of a folder; ``wide``: with ids that do not wrap."""
        key = (app_id(spark), sf_dir.rstrip("/"), wide)
        with _CACHE_LOCK:
            if key not in _CACHE:
                _CACHE[key] = cls(spark, sf_dir, wide)
            return _CACHE[key]

    @staticmethod
    def forget(spark: SparkSession, sf_dir: str) -> None:
        """Drop the cached workspace of ``sf_dir`` (its tables stay on disk)."""
        with _CACHE_LOCK:
            for wide in (False, True):
                _CACHE.pop((app_id(spark), sf_dir.rstrip("/"), wide), None)

    # -- raw --------------------------------------------------------------
    def raw(self, entity: str) -> DataFrame:
        path = self.zones.staging(f"landed_{entity}")

        def land():
            derived = fixtures.raw_table(self.spark, self.sf_dir, entity, self.wide)
            # AQE sizes the partitions in which the sources are dealt out, so
            # the landing is parallel here and bounded at scale.
            io.write_parquet(derived, path)
            return derived.schema

        return self._materialised(f"landed:{entity}", land, lambda schema: io.read_parquet(self.spark, path, schema))

    def raw_csv_path(self, entity: str) -> str:
        """The raw table written once as CSV into the raw zone."""
        self._once(f"csv:{entity}", lambda: io.write_csv(self.raw(entity), self.zones.raw(entity)))
        return self.zones.raw(entity)

    def validated(self, entity: str) -> DataFrame:
        return validate(self.raw(entity), self.entities[entity])

    # -- processed zone (materialised) -----------------------------------
    def processed(self, entity: str, split: str | None = io.VALID_SPLIT) -> DataFrame:
        path = self.zones.processed(entity)

        def write():
            validated = self.validated(entity)
            io.write_processed(validated, path)
            return validated.schema

        return self._materialised(f"processed:{entity}", write, lambda schema: io.read_processed(self.spark, path, split, schema))

    def valid(self, entity: str) -> DataFrame:
        return io.retype(self.processed(entity), entity)

    def quarantine(self, entity: str) -> DataFrame:
        return self.processed(entity, io.QUARANTINE_SPLIT)

    # -- one end-to-end run over the written raw zone ------------------------
    def etl(self) -> dict[str, str]:
        """Paths of everything that a run of both stages writes."""
        zones = io.Zones(f"{self.zones.root}/etl")

        def run():
            for n in ENTITIES:
                io.write_csv(self.raw(n), zones.raw(n))
            return stages.run(self.spark, zones).outputs

        return self._once("etl", run)

    def release(self) -> dict[str, str]:
        """Paths that the manifest names after a published run over the raw
        zone of :meth:`etl`."""
        self.etl()
        zones = io.Zones(f"{self.zones.root}/release", raw_root=io.Zones(f"{self.zones.root}/etl").raw("").rstrip("/"))

        def run():
            releases.publish(self.spark, zones)
            return releases.current(self.spark, zones).outputs

        return self._once("release", run)

    def batches(self) -> dict[str, str]:
        """Paths that the manifest names after the raw tables came in two
        batches (rows dealt by hash, so keys and their duplicates are parted)."""
        zones = io.Zones(f"{self.zones.root}/batches")

        def run():
            for part in range(2):
                for n in ENTITIES:
                    raw = self.raw(n)
                    io.write_csv(raw.where(F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == part), f"{zones.raw(n)}/batch{part}")
                increments.publish_batch(self.spark, zones)
            return releases.current(self.spark, zones).outputs

        return self._once("batches", run)

    def malformed_csv_path(self, entity: str) -> str:
        """The raw table as CSV text in which some lines lack their last field
        and some have one more."""
        path = self.zones.staging(f"malformed_{entity}")

        def write():
            raw = self.raw(entity)
            short, long_ = (F.expr(c) for c in fixtures.MALFORMED_SQL[entity])
            quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in raw.columns]
            line = F.when(short, F.concat_ws(",", *quoted[:-1])).when(long_, F.concat_ws(",", *quoted, F.lit("more"))).otherwise(F.concat_ws(",", *quoted))
            # One text column whose name is the header; nothing is quoted again.
            text = raw.select(line.alias(",".join(raw.columns)))
            io.write_csv(text, path, sep="\u0001", quote="\u0000", escapeQuotes=False)

        self._once(f"malformed:{entity}", write)
        return path

    def malformed_run(self) -> stages.StageResult:
        """Stage 1 over the malformed CSV folders with a quarantine for lines."""
        zones = io.Zones(f"{self.zones.root}/malformed")

        def run():
            raw = {n: io.read_csv(self.spark, self.malformed_csv_path(n), mark_malformed=True) for n in ENTITIES}
            return stages.process_raw(self.spark, raw, zones, quarantine_malformed=True)

        return self._once("malformed", run)

    def plain_processed(self) -> io.Zones:
        """Processed tables of valid rows only, without verdict columns."""
        zones = io.Zones(f"{self.zones.root}/plain")

        def write():
            for n in ENTITIES:
                io.write_parquet(self.valid(n).drop(STATUS_COLUMN, REASON_COLUMN), zones.processed(n))

        self._once("plain", write)
        return zones

    # -- stage 2, lazily over the processed zone ----------------------------
    def deduped(self, entity: str) -> DataFrame:
        return dedup_valid(self.valid(entity), self.entities[entity])

    def parent(self, entity: str) -> DataFrame:
        """A deduplicated parent table (customers / products), written once
        like the dimensions of stage 2, so joins against it see a plain scan
        (which also lets AQE split a skewed order partition)."""
        path = self.zones.staging(f"dedup_{entity}")

        def write():
            deduped = self.deduped(entity)
            io.write_parquet(deduped, path)
            return deduped.schema

        return self._materialised(f"parent:{entity}", write, lambda schema: io.read_parquet(self.spark, path, schema))

    def tagged(self) -> DataFrame:
        return marts.tag_orders(self.deduped("orders"), self.parent("customers"), self.parent("products"))

    def measured(self) -> DataFrame:
        return marts.add_measures(marts.enrich(self.tagged()))


def forget(spark: SparkSession, sf_dir: str) -> None:
    Workspace.forget(spark, sf_dir)
