"""Stage 1 over raw tables with malformed lines."""

from orderflow.plans import stages
from orderflow.plans.workspace import Workspace
from orderflow.session import new_work_dir
from orderflow.sources import io
from orderflow.specs import ENTITIES

from .conftest import SF_SMALL


def test_lines_are_counted_or_quarantined(spark):
    ws = Workspace.of(spark, SF_SMALL)
    raw = {n: io.read_csv(spark, ws.malformed_csv_path(n), mark_malformed=True) for n in ENTITIES}
    want = {n: df.where(f"{io.MALFORMED} is not null").count() for n, df in raw.items()}
    assert min(want.values()) > 0
    counted = stages.process_raw(spark, raw, io.Zones(new_work_dir(spark, "counted")))
    apart = stages.process_raw(spark, raw, io.Zones(new_work_dir(spark, "apart")), quarantine_malformed=True)
    for result in (counted, apart):
        assert {r.dataset: r.malformed_count for r in result.frames["malformed_summary"].collect()} == want
    rows = {n: spark.read.parquet(counted.outputs[f"valid_{n}"]).count() + spark.read.parquet(counted.outputs[f"invalid_{n}"]).count() for n in ENTITIES}
    rest = {n: spark.read.parquet(apart.outputs[f"valid_{n}"]).count() + spark.read.parquet(apart.outputs[f"invalid_{n}"]).count() for n in ENTITIES}
    assert rows == {n: raw[n].count() for n in ENTITIES} and rest == {n: rows[n] - want[n] for n in ENTITIES}
    assert {n: spark.read.parquet(apart.outputs[f"malformed_{n}"]).count() for n in ENTITIES} == want
    assert not [n for n in counted.outputs if n.startswith("malformed")]
    assert io.MALFORMED not in spark.read.parquet(counted.outputs["valid_orders"]).columns


def test_plain_raw_tables_have_no_malformed_summary(spark):
    ws = Workspace.of(spark, SF_SMALL)
    result = stages.process_raw(spark, {"products": io.read_csv(spark, ws.raw_csv_path("products"))}, io.Zones(new_work_dir(spark, "plain")))
    assert "malformed_summary" not in result.frames
