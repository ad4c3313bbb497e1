"""The registered queries: contracts, SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from orderflow.llm.decontaminate import fold
from orderflow.llm.minhash import near_duplicates
from orderflow.llm.oracle import ORACLE
from orderflow.llm.queries import QUERIES
from tests.oracle_compare import compare, duck

from .helpers import SF, docs

COLUMNS = {
    "op1": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op4": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7": ["page_id", "url", "text", "n_chars"],
    "op8": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10": ["doc_id", "held_out", "lang_pred", "score"],
    "op12": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), SF, name, QUERIES[name], ORACLE[name])
    assert r["values_ok"], r


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLE])
def test_contract_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SF)
    want = COLUMNS.get(name.split("_")[0], ["doc_id"])
    assert got.columns[: len(want)] == want
    if name.startswith("op12"):
        assert got.count() == 4 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    elif name != "op5_benchmark_decontamination":
        table = "pages" if name.startswith("op7") else "documents"
        assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline_stages(spark):
    """Each stage keeps rows of its predecessor, and each decision holds."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    frame, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF).cache()
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
        assert frame.columns == documents.columns + ["token_ids"] * (name == "sentencepiece")
    sizes = [documents.count(), *map(len, kept.values())]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0.7 * sizes[0]
    before = documents.where(F.col("doc_id").isin(list(kept["language_id"])))
    assert kept["minhash_near_dedup"] == {r.doc_id for r in near_duplicates(before).where("kept").collect()}
    items = [fold(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {r.doc_id for r in documents.collect() if any(i in fold((r.text or "").encode()) for i in items)}
    assert exact and not exact & kept["benchmark_decontamination"]
    assert kept["minhash_near_dedup"] - exact == kept["benchmark_decontamination"] - exact
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == kept["sentencepiece"]


def test_pipeline_stages_take_odd_documents(spark):
    frame = docs(spark, [(1, None), (2, ""), (None, "the of and to the in that is was for it with as on"), (3, "the of and to in"), (3, "the of and to in")])
    for stage in (f for _, f in corpus_pipeline.STAGES):
        frame = stage(spark, frame if "lang" in frame.columns else frame.withColumn("lang", F.lit("en")), SF)
    assert sorted(r.doc_id or 0 for r in frame.collect()) == [0, 3]
    empty = docs(spark, []).withColumn("lang", F.lit("en"))
    for stage in (f for _, f in corpus_pipeline.STAGES):
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
