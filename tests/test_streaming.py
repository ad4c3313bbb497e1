"""Stage 1 as an incremental stream gives the batch result, exactly once."""

from orderflow.session import new_work_dir
from orderflow.sources import io
from orderflow.specs import CUSTOMERS
from orderflow.streaming.ingest import start_processing


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_stream_matches_batch_and_restarts_cleanly(spark, ws):
    root = new_work_dir(spark, "test-stream")
    src, out, ckpt = f"{root}/raw", f"{root}/processed", f"{root}/_checkpoint"
    raw = ws.raw("customers")
    io.write_csv(raw, src)
    q = start_processing(spark, CUSTOMERS, src, out, ckpt)
    q.awaitTermination(300)
    streamed = io.read_processed(spark, out, split=None)
    batch = ws.processed("customers", split=None)
    assert _rows(streamed.select(*batch.columns)) == _rows(batch)
    # Restart over the same input: nothing is reprocessed.
    q = start_processing(spark, CUSTOMERS, src, out, ckpt)
    q.awaitTermination(300)
    assert io.read_processed(spark, out, split=None).count() == raw.count()


def test_stream_rejects_a_header_in_another_order(spark):
    import os

    import pytest

    root = new_work_dir(spark, "test-stream-header")
    src = f"{root}/raw".replace("file:", "")
    os.makedirs(src)
    cols = list(CUSTOMERS.raw_columns)
    with open(os.path.join(src, "part-0.csv"), "w") as fh:
        fh.write(",".join(reversed(cols)) + "\n" + ",".join(["x"] * len(cols)) + "\n")
    q = start_processing(spark, CUSTOMERS, f"{root}/raw", f"{root}/processed", f"{root}/_checkpoint")
    with pytest.raises(Exception):
        q.awaitTermination(300)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
