"""The registered queries of the operators: each applies one operator with
its production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import id_remainder, table
from orderflow.llm.decontaminate import contaminated_regions
from orderflow.llm.fuzzy_hash import compare_with_successors
from orderflow.llm.html_text import extract_main_text
from orderflow.llm.langid import fit_languages, predict_languages
from orderflow.llm.lexical import rank_documents
from orderflow.llm.minhash import near_duplicates
from orderflow.llm.pieces import encode_documents
from orderflow.llm.ppm import score_documents
from orderflow.llm.preference import branches, format_preferences
from orderflow.llm.severity import fit_severity, label_grades, score_severity
from orderflow.llm.substrings import remove_repeated_passages
from orderflow.llm.warc import archive_round_trip
from orderflow.llm.whitening import whiten


def op1_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; those whose crc32 remainder modulo 7 is 2 are
    not learned from."""
    return score_documents(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) != 2)


def op2_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against its branch with another last reply."""
    return format_preferences(*branches(table(spark, sf_dir, "conversations")))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region of ``documents`` that holds a benchmark item, under each
    id of the item."""
    return contaminated_regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), all_ids=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document under a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return score_severity(docs, fit_severity(docs, label_grades(table(spark, sf_dir, "labels"))))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_successors(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose crc32 remainder
    modulo 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    found = predict_languages(docs, fit_languages(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that a document with a
    smaller id holds."""
    kept = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ppm_scores,
        op2_preference_formatting,
        op3_warc_archives,
        op4_minhash_near_dedup,
        op5_benchmark_decontamination,
        op6_toxicity,
        op7_html_extraction,
        op8_document_fingerprints,
        op9_sentencepiece,
        op10_language_id,
        op11_substring_dedup,
        op12_embedding_whitening,
        op13_lexical_search,
    )
}
