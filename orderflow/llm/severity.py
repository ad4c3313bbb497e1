"""Severity grades by cumulative-link ordinal regression.

``P(grade >= k) = sigmoid(w.x - theta_k)`` for ``k = 1..K``: one weight
vector shared by all thresholds, which are ordered. A feature is a word or a
word beginning (inflected forms share it) and counts the document's distinct
words that carry it. Weights are sparse and not negative: words raise the
severity, and no amount of clean text hides them.

The first threshold, from which a text is rejected, is then moved to where it errs
least on the sample: with clean rows that carry no weight at all, the fitted one
would ask for more words than the labels do. The others stay at or above it.

Fitting works on a bounded sample of the labelled rows (``max_rows``, those
with the smallest hash of the id) and on the ``max_features`` features that
stand out most from chance; both are parameters. Scoring covers every whole text, and a
task needs the sparse weights only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import WordCache, ids_and_bytes, map_whole_rows, slices

MAX_ROWS = 20_000
MAX_FEATURES = 5_000
EVIDENCE = 12.0  # nats: a feature as common among graded rows by chance is one in 160,000
PREFIXES = (4, 5, 6)
L1 = 0.02
ROUNDS = 3_000
SLICE_BYTES = 1 << 21
#: Features whose counts a task holds at a time.
MOST_COUNTED = 1 << 16
#: Bytes of words and their weights that are kept between texts.
SCORE_BYTES = 12 << 20
_LETTERS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


@dataclass(frozen=True)
class SeverityModel:
    """Sparse weights by feature hash and one threshold per grade above 0: the
    sum of weights from which the grade is as likely as not."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    @property
    def cut(self) -> float:
        """The sum from which a text is rejected."""
        return self.thresholds[0] if self.thresholds else math.inf


def distinct_words(data: bytes | None) -> set[bytes]:
    return set(data.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()) if data else set()


def word_features(word: bytes) -> list[int]:
    """Hashes of the whole word and of its beginnings."""
    return [xxhash.xxh64_intdigest(word) >> 1, *(xxhash.xxh64_intdigest(word[:n], n) >> 1 for n in PREFIXES if len(word) > n)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_cumulative_link(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, l1: float = L1, rounds: int = ROUNDS):
    """Weights and thresholds minimising the summed cumulative logistic loss
    plus ``l1`` times the weights, by accelerated proximal steps."""
    n, k = len(grades), int(grades.max())
    above = (grades[:, None] >= np.arange(1, k + 1)).astype(float)
    share = np.clip(above.mean(axis=0), 1e-6, 1 - 1e-6)
    w, theta = np.zeros(n_features), -np.log(share / (1 - share))
    # A step for each coordinate: the curvature along it is at most
    # k/4 * sum_i x_ij * (sum_j x_ij + 1).
    reach = np.bincount(rows, values, n) + 1
    step_w = 4 / (k * np.maximum(np.bincount(cols, values * reach[rows], n_features), 1))
    step_t = 4 / (k * reach.sum())
    yw, yt, pace = w.copy(), theta.copy(), 1.0
    for _ in range(rounds):
        z = np.bincount(rows, values * yw[cols], n)
        error = _sigmoid(z[:, None] - yt) - above
        grad_w = np.bincount(cols, values * error.sum(axis=1)[rows], n_features)
        new_w = np.maximum(yw - step_w * (grad_w + l1), 0)
        new_t = np.maximum.accumulate(yt + step_t * error.sum(axis=0))
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        yw = new_w + (pace - 1) / new_pace * (new_w - w)
        yt = new_t + (pace - 1) / new_pace * (new_t - theta)
        w, theta, pace = new_w, new_t, new_pace
    return w, theta


def best_cut(sums: np.ndarray, high: np.ndarray) -> float:
    """The positive cut between two sums that puts the fewest rows on the wrong
    side, a clean row counting twice; of equally good ones the middle of the
    widest gap."""
    values = np.unique(np.append(sums, 0.0))
    if len(values) < 2:
        return math.inf
    middle = (values[1:] + values[:-1]) / 2
    over = len(sums) - np.searchsorted(np.sort(sums), middle)
    high_over = high.sum() - np.searchsorted(np.sort(sums[high]), middle)
    wrong = 2 * (over - high_over) + (high.sum() - high_over)
    best = np.flatnonzero(wrong == wrong.min())
    return float(middle[best[np.argmax((values[1:] - values[:-1])[best])]])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and graded rows of each feature, in parts of about ``MOST_COUNTED``
    features: a task holds no more than that, and the parts are summed before
    the shuffle."""
    high, all_ = Counter(), Counter()

    def counted() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(all_.keys(), pa.int64()), pa.array(all_.values(), pa.int64()), pa.array((high[f] for f in all_), pa.int64())],
            names=["feature", "rows", "high"],
        )
        high.clear()
        all_.clear()
        return out

    for batch in slices(batches, "data", SLICE_BYTES):
        for data, grade in zip(batch.column("data").to_pylist(), batch.column("grade").to_pylist()):
            found = {f for w in distinct_words(data) for f in word_features(w)}
            all_.update(found)
            if grade > 0:
                high.update(found)
            if len(all_) >= MOST_COUNTED:
                yield counted()
    yield counted()


def _feature_rows(chosen: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", SLICE_BYTES):
            cols, counts = [], []
            for data in batch.column("data").to_pylist():
                found = Counter(chosen[f] for w in distinct_words(data) for f in word_features(w) if f in chosen)
                cols.append(list(found))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array(cols, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], names=["grade", "cols", "counts"]
            )

    return run


def fit_severity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES,
) -> SeverityModel:
    """Fit on at most ``max_rows`` labelled documents. Rows with a null id or
    grade are no labels; of several grades of one id the highest counts, of
    several texts the least. With no labelled document, or one grade only, the model says grade 0 always."""
    label = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
    label = label.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    sample = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    held = sample.toArrow()
    if not held.num_rows or pc.max(held.column("grade")).as_py() < 1:
        return SeverityModel({}, ())
    sample = docs.sparkSession.createDataFrame(held, sample.schema)  # max_rows ids at most; from Arrow: no Python worker
    rows = ids_and_bytes(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "grade").agg(F.min("data").alias("data"))
    n, high = rows.agg(F.count("*"), F.count_if(F.col("grade") > 0)).first()
    if not high:
        return SeverityModel({}, ())
    base = min(high / n, 1 - 0.5 / n)
    counts = rows.mapInArrow(_feature_counts, "feature bigint, rows bigint, high bigint").groupBy("feature").agg(F.sum("rows").alias("rows"), F.sum("high").alias("high"))
    # Chernoff bound on so many graded rows among those of the feature, were it void.
    low = F.col("rows") - F.col("high")
    evidence = F.col("high") * F.log(F.col("high") / F.col("rows") / base) + F.when(low > 0, low * F.log(low / F.col("rows") / (1 - base))).otherwise(0.0)
    best = counts.where(F.col("high") > base * F.col("rows")).withColumn("evidence", evidence).where(F.col("evidence") > EVIDENCE)
    best = best.orderBy(F.col("evidence").desc(), "feature").limit(max_features)
    chosen = {r.feature: i for i, r in enumerate(best.collect())}
    if not chosen:
        return SeverityModel({}, ())
    table = rows.mapInArrow(_feature_rows(chosen), "grade int, cols array<int>, counts array<int>").toArrow()
    grades = table.column("grade").to_numpy()
    per_row = pc.list_value_length(table.column("cols")).to_numpy()
    cols = table.column("cols").combine_chunks().flatten().to_numpy()
    values = table.column("counts").combine_chunks().flatten().to_numpy().astype(float)
    row = np.repeat(np.arange(len(grades)), per_row)
    w, theta = fit_cumulative_link(row, cols, values, grades, len(chosen))
    w[w <= 1e-6] = 0
    # Calibrated: the first threshold is where rejecting errs least.
    cut = best_cut(np.bincount(row, values * w[cols], len(grades)), grades > 0)
    return SeverityModel({f: float(w[i]) for f, i in chosen.items() if w[i]}, (cut, *(max(cut, float(t)) for t in theta[1:])))


def word_scores(model: SeverityModel) -> WordCache:
    """The weight of each word: the sum of those of its features."""
    weights = model.weights
    return WordCache(lambda word: sum(weights.get(f, 0.0) for f in word_features(word)), SCORE_BYTES)


def weight_sums(scores: WordCache, texts: list[bytes | None]) -> np.ndarray:
    """The summed weights of each text's distinct words."""
    return np.array([sum(map(scores.__getitem__, distinct_words(d))) for d in texts], float)


def _scores(model: SeverityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, theta = word_scores(model), np.array(model.thresholds)
        for batch in slices(batches, "data", SLICE_BYTES):
            z = weight_sums(scores, batch.column("data").to_pylist())
            above = _sigmoid(z[:, None] - theta) if len(theta) else np.zeros((len(z), 1))
            grade = (z[:, None] >= theta).sum(axis=1) if len(theta) else np.zeros(len(z))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(grade.astype(np.int32)), pa.array(above[:, 0])],
                names=["doc_id", "severity", "grade", "p_toxic"],
            )

    return run


def score_severity(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row, in any order: ``doc_id``, ``severity`` (expected
    grade), ``grade`` (the highest that is as likely as not), ``p_toxic`` (chance
    of a grade above 0),
    ``rejected`` (grade above 0). A null or
    wordless text scores as no evidence; ids may be null or repeat."""
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = ids_and_bytes(docs, id_col, text_col).mapInArrow(_scores(model), f"doc_id {id_type}, severity double, grade int, p_toxic double")
    return scored.withColumn("rejected", F.col("grade") > 0)


def keep_clean(docs: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """The rows that :func:`score_severity` does not reject, all columns."""

    def run(parts):
        scores = word_scores(model)
        for batch, texts in parts:
            yield batch.filter(pa.array(weight_sums(scores, texts) < model.cut)), []

    return map_whole_rows(docs, text_col, run, limit=SLICE_BYTES)


def label_grades(labels: DataFrame) -> DataFrame:
    """Grades of the ``labels`` table: 0 clean, 1 toxic, 2 toxic and of low
    quality. A null ``toxic`` is no label."""
    toxic, low = F.col("toxic") == 1, F.coalesce(F.col("quality") == 0, F.lit(False))
    return labels.where("toxic is not null").select("doc_id", F.when(~toxic, 0).when(low, 2).otherwise(1).alias("grade"))
