"""Every registered query against its DuckDB oracle (sf0.001 here; the
correctness gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

from .conftest import SF_SMALL

from orderflow.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["values_ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "order_date_cleaned", "country", "category", "total_orders", "total_quantity", "total_sales",
        "completed_orders", "returned_orders", "cancelled_orders",
    ]


def test_queries_from_several_threads(spark, con):
    """Callers on several threads share one workspace; each table is
    materialised once and every answer still matches its oracle."""
    from concurrent.futures import ThreadPoolExecutor

    from orderflow.plans import workspace

    sf = "/root/testdata/sf0.01"
    workspace.forget(spark, sf)
    names = ["valid_orders", "dedup_orders", "sales_summary", "orphan_customer_orders", "csv_roundtrip_orders", "quarantine_orders"]
    duck_con = duck(sf)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        frames = dict(zip(names, pool.map(lambda n: entry.queries()[n](spark, sf), names)))
    for n in names:
        r = compare(spark, duck_con, sf, n, lambda s, d, df=frames[n]: df, entry.oracle_sql()[n])
        assert r["values_ok"], r


def test_results_do_not_depend_on_session_settings(spark, con):
    """Same answers with ANSI off, AQE off and 200 shuffle partitions."""
    conf = {"spark.sql.ansi.enabled": "false", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in ("parse_quantity", "parse_price", "parse_order_date", "validate_orders", "dedup_orders", "sales_summary"):
            r = compare(spark, con, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
            assert r["values_ok"], r
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_workspace_rewrites_tables_removed_from_the_shared_folder(spark, con):
    import shutil

    from orderflow.plans.workspace import Workspace

    ws = Workspace.of(spark, SF_SMALL)
    before = ws.valid("products").count()
    shutil.rmtree(ws.zones.processed("products").replace("file:", ""))
    assert ws.valid("products").count() == before


@pytest.mark.parametrize("query", ["csv_roundtrip", "csv_mixed_headers", "parquet_roundtrip"])
def test_sources_and_sinks_cover_every_table(query):
    first = "csv_roundtrip_customers" if query == "csv_roundtrip" else query
    names = {first, f"{query}_products", f"{query}_orders"}
    assert names <= set(entry.queries()) and names <= set(entry.oracle_sql())
