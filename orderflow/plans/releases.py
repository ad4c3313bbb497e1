"""Atomic publishing and resuming of an end-to-end run.

A run writes every output into folders of its own release, named by a
fingerprint of its raw files, below ``_releases`` in the processed and the
curated zone. Consumers find the tables by a manifest in the curated zone,
which is replaced in one rename after the last output is written: a run that
fails half-way changes nothing that they read.

Each finished output leaves a marker with what was observed while it was
written. A run over the same raw files finds the markers of the broken one and
writes only what is missing; over other files it is another release.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from orderflow import __version__
from orderflow.plans import stages
from orderflow.sources import files, io
from orderflow.specs import ENTITIES

RELEASES, MANIFEST, MARKERS = "_releases", "_manifest.json", "_markers"
#: Releases that stay after a switch: the new one, and those that readers may
#: still be reading.
KEPT_RELEASES = 2


class Ledger:
    """Markers of finished outputs in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @property
    def work(self) -> str:
        """Intermediate tables of the run, with markers of their own."""
        return f"{self.folder}/work"

    def once(self, name: str, job: Callable[[], Mapping | None]) -> dict:
        """What ``job`` returned when it first finished; it runs only if it has
        not finished before."""
        path = f"{self.folder}/{name}.json"
        facts = files.read_json(self.spark, path)
        if facts is None:
            facts = dict(job() or {})
            files.write_json(self.spark, path, facts)
        return facts


@dataclass(frozen=True)
class Release:
    run: str
    outputs: dict[str, str]
    earlier: tuple[str, ...] = ()
    #: Raw files read so far by batches (``increments``), by entity.
    consumed: dict[str, list[list]] = field(default_factory=dict)


def _manifest(zones: io.Zones) -> str:
    return zones.curated(MANIFEST)


def current(spark: SparkSession, zones: io.Zones) -> Release | None:
    """The release that the manifest names, or None before the first one."""
    held = files.read_json(spark, _manifest(zones))
    return held and Release(held["run"], held["outputs"], tuple(held["earlier"]), held["consumed"])


def read_published(spark: SparkSession, zones: io.Zones, name: str) -> DataFrame:
    """A table of the current release."""
    release = current(spark, zones)
    if release is None or name not in release.outputs:
        raise ValueError(f"{_manifest(zones)}: no published {name!r}")
    return io.read_parquet(spark, release.outputs[name])


def fingerprint(spark: SparkSession, zones: io.Zones, partition_by: Mapping[str, tuple[str, ...]] | None = None) -> str:
    """Name of a run: a digest of the raw files (path, size, time), the layout
    asked for and the library's version."""
    raw = {name: files.listing(spark, zones.raw(name)) for name in ENTITIES}
    layout = {k: list(v) for k, v in (partition_by or {}).items()}
    said = json.dumps([__version__, layout, raw], sort_keys=True)
    return hashlib.sha256(said.encode()).hexdigest()[:16]


def release_zones(zones: io.Zones, run: str) -> io.Zones:
    """The zones with processed and curated tables in the folders of a release."""
    processed, curated = zones.processed(RELEASES), zones.curated(RELEASES)
    return replace(zones, processed_root=f"{processed}/{run}", curated_root=f"{curated}/{run}", raw_root=zones.raw("").rstrip("/"))


def publish(
    spark: SparkSession,
    zones: io.Zones,
    *,
    partition_by: Mapping[str, tuple[str, ...]] | None = None,
    keep: int = KEPT_RELEASES,
) -> stages.StageResult:
    """Both stages over the raw zone, then the switch of the manifest.

    What an earlier run over the same raw files has finished is not written
    again; a run that the manifest already names writes nothing. The folders of
    releases before the last ``keep`` ones of the manifest are deleted;
    folders that it never named (another run, broken or under way) stay."""
    run = fingerprint(spark, zones, partition_by)
    own = release_zones(zones, run)
    ledger = Ledger(spark, own.curated(MARKERS))
    raw = {name: (lambda name=name: io.read_csv(spark, zones.raw(name))) for name in ENTITIES}
    first = stages.process_raw(spark, raw, own, ledger)
    second = stages.curate(spark, own, partition_by, ledger)
    result = stages.StageResult({**first.outputs, **second.outputs}, {**first.frames, **second.frames})

    switch(spark, zones, run, result.outputs, keep)
    return result


def switch(spark: SparkSession, zones: io.Zones, run: str, outputs: Mapping[str, str], keep: int, consumed: Mapping[str, list[list]] | None = None) -> None:
    """Let the manifest name a finished release, then delete the folders of
    those it no longer keeps."""
    before = current(spark, zones)
    if before is not None and before.run == run:
        return
    named = list(dict.fromkeys([run, *([before.run, *before.earlier] if before else [])]))
    files.write_json(spark, _manifest(zones), {"run": run, "outputs": dict(outputs), "earlier": named[1:keep], "consumed": dict(consumed or {})})
    for gone in named[max(keep, 1) :]:
        old = release_zones(zones, gone)
        for folder in (old.processed_root, old.curated_root):
            files.delete(spark, folder)
