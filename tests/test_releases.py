"""Atomic publishing and resuming."""

import threading

import pytest

from orderflow.plans import releases, stages
from orderflow.plans.workspace import Workspace
from orderflow.session import new_work_dir
from orderflow.sources import files, io
from orderflow.specs import ENTITIES

from .conftest import SF_SMALL


@pytest.fixture()
def zones(spark):
    """A raw zone of the small tables, less half of the orders."""
    ws, own = Workspace.of(spark, SF_SMALL), io.Zones(new_work_dir(spark, "test-releases"))
    for n in ENTITIES:
        raw = ws.raw(n)
        io.write_csv(raw.sample(0.5, seed=1) if n == "orders" else raw, own.raw(n))
    return own


def contents(spark, zones):
    release = releases.current(spark, zones)
    return release.run, {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in release.outputs.items()}


class Failing:
    """Counts the writes of curated tables and breaks the ``at``-th."""

    def __init__(self, at):
        self.at, self.paths, self.lock, self.write = at, [], threading.Lock(), io.write_parquet

    def __call__(self, df, path, partition_by=()):
        with self.lock:
            self.paths.append(path)
            broken = "/curated/" in path and not path.count("work") and sum("/curated/" in p and not p.count("work") for p in self.paths) == self.at
        if broken:
            self.failed = path
            raise OSError("disk full")
        return self.write(df, path, partition_by)


def add_orders(spark, zones):
    Workspace.of(spark, SF_SMALL).raw("orders").write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(zones.raw("orders"))


def test_a_failed_write_leaves_the_earlier_release_and_is_resumed(spark, zones, monkeypatch):
    first = releases.publish(spark, zones)
    run, before = contents(spark, zones)
    assert set(before) == set(first.outputs) and len(before) == 15
    assert {n: len(rows) for n, rows in before.items() if n in stages.CURATED_OUTPUTS}["fact_orders"] > 0

    add_orders(spark, zones)
    failing = Failing(at=4)
    monkeypatch.setattr(io, "write_parquet", failing)
    with pytest.raises(OSError, match="disk full"):
        releases.publish(spark, zones)
    assert contents(spark, zones) == (run, before)  # all six tables, and all others

    # The next run goes on: stage 1, the intermediate tables and the finished
    # outputs are not written again.
    again = Failing(at=-1)
    monkeypatch.setattr(io, "write_parquet", again)
    spark.sparkContext.setJobGroup("resumed-run", "resumed")
    result = releases.publish(spark, zones)
    spark.sparkContext.setJobGroup("rest", "rest")
    assert 1 <= len(again.paths) <= 3 and {p.rsplit("/", 1)[1] for p in again.paths} <= set(stages.CURATED_OUTPUTS)
    assert {p for p in failing.paths if "/processed/" in p} and failing.failed in again.paths
    new_run, after = contents(spark, zones)
    assert new_run != run and set(after) == set(before) and len(after["fact_orders"]) > len(before["fact_orders"])

    # The same tables as a run of its own, without releases.
    whole = io.Zones(new_work_dir(spark, "test-whole"), raw_root=f"{zones.root}/raw")
    plain = stages.run(spark, whole).outputs
    assert set(plain) == set(result.outputs)
    for n, p in plain.items():
        assert sorted(map(str, spark.read.parquet(p).collect())) == after[n], n


def test_a_run_over_the_same_files_writes_nothing(spark, zones, monkeypatch):
    first = releases.publish(spark, zones)
    counting = Failing(at=-1)
    monkeypatch.setattr(io, "write_parquet", counting)
    group = "same-files"
    spark.sparkContext.setJobGroup(group, group)
    second = releases.publish(spark, zones)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("rest", "rest")
    assert not counting.paths and second.outputs == first.outputs
    assert len(jobs) <= 1  # the schema of the validation summary


def test_releases_beyond_the_last_ones_go(spark, zones):
    runs = []
    for _ in range(3):
        releases.publish(spark, zones, keep=2)
        runs.append(releases.current(spark, zones).run)
        add_orders(spark, zones)
    assert len(set(runs)) == 3
    folders = [releases.release_zones(zones, r) for r in runs]
    assert [files.exists(spark, z.curated_root) and files.exists(spark, z.processed_root) for z in folders] == [False, True, True]
    assert releases.read_published(spark, zones, "sales_summary").count() > 0
    with pytest.raises(ValueError, match="no published"):
        releases.read_published(spark, zones, "nothing")


def test_json_files_are_replaced_whole(spark):
    path = f"{new_work_dir(spark, 'json')}/x.json"
    assert files.read_json(spark, path) is None
    for value in ({"a": 1}, {"b": "é", "c": [1, 2]}):
        files.write_json(spark, path, value)
        assert files.read_json(spark, path) == value
    assert not [f for f, *_ in files.listing(spark, path.rsplit("/", 1)[0]) if f.endswith(".tmp")]
