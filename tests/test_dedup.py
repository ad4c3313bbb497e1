"""One deterministic survivor per key, whatever the partitioning."""

from pyspark.sql import functions as F

from orderflow.operators.dedup import AGAIN, dedup, dedup_marked, dedup_valid_marked
from orderflow.operators.summary import duplicate_summaries_from_marks, duplicate_summary
from orderflow.specs import ENTITIES, ORDERS, REASON_COLUMN, STATUS_COLUMN


def _sorted(df):
    return sorted(df.collect(), key=lambda r: tuple("" if v is None else str(v) for v in r))


def test_smallest_row_wins_nulls_first(spark):
    df = spark.createDataFrame(
        [("k", "b", 2), ("k", None, 9), ("k", "a", 1), ("j", "z", 1), (None, "x", 1), (None, "w", 2)],
        "key string, a string, b int",
    )
    got = {r["key"]: (r["a"], r["b"]) for r in dedup(df, "key", ("a",)).collect()}
    assert got == {"k": (None, 9), "j": ("z", 1), None: ("w", 2)}


def test_same_survivors_under_any_partitioning(spark, ws):
    orders = ws.valid("orders")
    base = None
    for n in (1, 4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            rows = _sorted(dedup(orders.repartition(n), ORDERS.key, ORDERS.dedup_order))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        base = rows if base is None else base
        assert rows == base


def test_survivors_are_the_grouped_minimum(ws):
    orders = ws.valid("orders")
    rest = [c for c in orders.columns if c != ORDERS.key and c not in ORDERS.dedup_order]
    least = orders.groupBy(ORDERS.key).agg(F.min(F.struct(*ORDERS.dedup_order, *rest)).alias("m")).select(ORDERS.key, "m.*")
    assert _sorted(dedup(orders, ORDERS.key, ORDERS.dedup_order)) == _sorted(least.select(*orders.columns))


def test_keys_unique_after_dedup_and_columns_kept(ws):
    d = ws.deduped("orders")
    assert d.columns == ws.valid("orders").columns
    assert d.groupBy("order_id").count().where(F.col("count") > 1).count() == 0


def test_hot_key_is_combined_before_the_shuffle(ws):
    plan = ws.deduped("orders")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_marked_rows_give_the_duplicate_summaries(ws):
    tables = {}
    for n, spec in ENTITIES.items():
        valid = ws.valid(n)
        marked = dedup_valid_marked(valid, spec)
        survivors = marked.where(~F.col(AGAIN)).drop(AGAIN)
        assert _sorted(survivors) == _sorted(ws.deduped(n).drop(STATUS_COLUMN, REASON_COLUMN))
        tables[n] = (marked, spec.key, valid.count())
    before, after = duplicate_summaries_from_marks(tables, AGAIN)
    assert _sorted(before) == _sorted(duplicate_summary({n: (ws.valid(n), s.key) for n, s in ENTITIES.items()}))
    assert _sorted(after) == _sorted(duplicate_summary({n: (ws.deduped(n), s.key) for n, s in ENTITIES.items()}))


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), ("a", 1), ("b", 1), ("b", 0)], "k string, v int")
    before, after = duplicate_summaries_from_marks({"t": (dedup_marked(df, "k"), "k", df.count())}, AGAIN)
    assert _sorted(before) == _sorted(duplicate_summary({"t": (df, "k")}))
    assert _sorted(after) == _sorted(duplicate_summary({"t": (dedup(df, "k"), "k")}))


def test_marking_still_combines_a_hot_key_before_the_shuffle(ws):
    plan = dedup_valid_marked(ws.valid("orders"), ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("FileScan") == 1


def test_curate_reads_its_valid_tables_once(spark, ws):
    """The summaries come with the result: no plan that reads a table again."""
    from orderflow.plans import stages

    result = stages.curate(spark, ws.plain_processed())
    for name in ("duplicate_summary_before", "duplicate_summary_after"):
        assert "FileScan" not in result.frames[name]._jdf.queryExecution().executedPlan().toString()
