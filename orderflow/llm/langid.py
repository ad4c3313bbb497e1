"""Language identification by nearest centroid.

A text becomes a TF-IDF vector over hashed byte n-grams of its lower-cased
letters (runs of other characters count as one space), scaled to length one.
Every language has several centroids, found by spherical k-means on a bounded
sample of labelled rows (``max_rows`` a language, smallest hash of id and
text); document frequencies cover all labelled rows. A text gets the language
of the nearest centroid by cosine and is rejected when that is farther than
the language's radius: a low quantile of the cosines of held-out members, with
a margin, less for short texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import ids_and_bytes, map_whole_rows, slices, stage

DIMS = 1 << 12
CENTROIDS = 4
MAX_ROWS = 400
KMEANS_ROUNDS = 12
#: The radius: this share of the low quantile of held-out cosines, at most
#: ``MOST_RADIUS`` (texts of another language stay below it: their hashed n-grams
#: meet a centroid by chance and by common letters only).
RADIUS_FACTOR, RADIUS_QUANTILE, MOST_RADIUS = 0.75, 0.05, 0.2
#: Texts of fewer bytes of letters have few n-grams, and so smaller cosines in
#: any language: their radius falls to half.
SHORT_TEXT = 200
#: The members farthest from the mean start no centroid, and a centroid has at
#: least this share of its language's sample: a few rows far from all others
#: have a wrong label.
OUTER_SHARE, LEAST_SHARE = 0.25, 0.05
#: One in so many members is held out to find the radius.
HOLD_OUT = 4
SLICE_BYTES, SLICE_ROWS = 1 << 19, 256
UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_HAS_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    """``centroids``: ``(dims, m)`` unit columns; ``langs`` names each;
    ``radius``: least cosine that is accepted; ``idf`` by dimension."""

    langs: tuple[str, ...]
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray


def letters_only(data: bytes | None) -> bytes:
    """Lower-case letters, words parted by one space; empty without a letter."""
    text = data.decode("utf-8", "replace") if data else ""
    if not _HAS_LETTER.search(text):
        return b""
    return (" " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode()


def gram_counts(texts: list[bytes], dims: int = DIMS) -> np.ndarray:
    """``(texts, dims)`` counts of hashed 2- and 3-byte grams."""
    out = np.zeros((len(texts), dims), np.float32)
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    if not len(flat):
        return out
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * dims, lengths)
    ends = np.cumsum(lengths)
    shift = np.uint32(32 - (dims - 1).bit_length())
    total = np.zeros(len(texts) * dims, np.int64)
    for width in (2, 3):
        if len(flat) < width:
            continue
        gram = flat[: len(flat) - width + 1].copy()
        for i in range(1, width):
            gram = (gram << np.uint32(8)) | flat[i : len(flat) - width + 1 + i]
        cell = row[: len(gram)] + ((gram * np.uint32(2654435761) + np.uint32(width * 0x9E3779B1 & 0xFFFFFFFF)) >> shift)
        inside = np.ones(len(gram), bool)
        for i in range(1, width):  # grams that run over a text's end
            last = ends - i
            inside[last[(lengths >= i) & (last < len(gram))]] = False
        total += np.bincount(cell[inside], minlength=len(total))
    out[:] = total.reshape(out.shape)
    return out


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def cluster(vectors: np.ndarray, k: int, rounds: int = KMEANS_ROUNDS) -> np.ndarray:
    """Spherical k-means from farthest-first starts among the usual members:
    ``(k', dims)`` unit centroids, without those of few members."""
    typical = vectors @ vectors.mean(axis=0)
    usual = typical >= np.quantile(typical, OUTER_SHARE)
    picks = [int(np.argmax(typical))]
    while len(picks) < min(k, len(vectors)):
        nearest = np.where(usual, (vectors @ vectors[picks].T).max(axis=1), 1.0)
        far = int(np.argmin(nearest))
        if nearest[far] > 0.999:
            break
        picks.append(far)
    centres = vectors[picks]
    for turn in range(rounds):
        owner = (vectors @ centres.T).argmax(axis=1)
        held, size = np.unique(owner, return_counts=True)
        if turn == rounds // 2:  # what is left of far starts are wrong labels
            held = held[size >= min(size.max(), LEAST_SHARE * len(vectors))]
        centres = np.stack([vectors[owner == c].sum(axis=0) for c in held])
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def _document_frequency(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(dims, np.int64), 0
        for batch in slices(batches, "data", SLICE_BYTES, SLICE_ROWS):
            texts = [t for t in map(letters_only, batch.column("data").to_pylist()) if t]
            seen += (gram_counts(texts, dims) > 0).sum(axis=0)
            n += len(texts)
        cells = np.append(np.arange(dims), -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.append(seen, n))], names=["cell", "docs"])

    return run


def fit_languages(
    docs: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dims: int = DIMS,
    centroids: int = CENTROIDS,
    max_rows: int = MAX_ROWS,
) -> LanguageModel:
    """Learn from the rows where ``train`` holds, the language is not null and
    the text has a letter. ``max_rows`` texts a language shape the centroids
    (rows that repeat id and text count once there; ids may be null);
    document frequencies count every such row. Each language is clustered in
    a task of its own; the driver gets ``dims`` counts, the size of each language
    and the centroids."""
    rows = ids_and_bytes(docs.where(F.coalesce(train, F.lit(False))) if train is not None else docs, id_col, text_col, F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where("lang is not null and data is not null")
    frequency = rows.mapInArrow(_document_frequency(dims), "cell int, docs bigint").groupBy("cell").agg(F.sum("docs").alias("docs")).toPandas()
    counts = np.zeros(dims + 1)
    counts[frequency["cell"]] = frequency["docs"]
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])).astype(np.float32) + np.float32(0.1)
    # Rows that may be among the smallest hashes of their language: a share that
    # holds twice as many as are asked for, so no task ranks a whole language.
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "data"))
    kinds = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("kinds")).collect()
    sizes = {r["lang"]: min(1.0, 2.0 * max_rows / max(1, r["kinds"])) for r in kinds}
    shares = pa.table({"of": pa.array(sizes.keys(), pa.string()), "share": pa.array(sizes.values(), pa.float64())})
    shares = docs.sparkSession.createDataFrame(shares, "of string, share double")  # a row a language, like the model
    near = hashed.join(F.broadcast(shares), F.col("lang") == F.col("of"))
    few = near.where(F.col("h") / F.lit(2.0**64) + 0.5 < F.col("share")).groupBy("lang", "h").agg(F.any_value("data").alias("data"))
    few = stage(few, "sample")
    order = Window.partitionBy("lang").orderBy("h")
    chosen = few.select("lang", "h").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_rows).drop("rank")
    vectors = few.join(chosen, ["lang", "h"]).mapInArrow(_vectors(idf), "h long, lang string, vector array<float>")
    found = vectors.groupBy("lang").applyInArrow(_clusters(centroids, dims), "lang string, place int, centroid array<float>, radius float").toArrow()
    found = found.sort_by([("lang", "ascending"), ("place", "ascending")])
    columns = found.column("centroid").combine_chunks().flatten().to_numpy().reshape(-1, dims)
    return LanguageModel(tuple(found.column("lang").to_pylist()), columns.T.astype(np.float32, order="C"), found.column("radius").to_numpy().astype(np.float32), idf)


def _radius(vectors: np.ndarray, centroids: int) -> float:
    """Least cosine to accept: from members that the centroids have not seen
    (all, where there are too few to hold any out)."""
    apart = np.arange(len(vectors)) % HOLD_OUT == 0 if len(vectors) > HOLD_OUT else np.ones(len(vectors), bool)
    seen = vectors if apart.all() else vectors[~apart]
    nearest_ = (vectors[apart] @ cluster(seen, centroids).T).max(axis=1)
    return min(MOST_RADIUS, RADIUS_FACTOR * float(np.quantile(nearest_, RADIUS_QUANTILE)))


def _clusters(centroids: int, dims: int):
    """The centroids and the radius of one language."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("h")
        own = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        found = cluster(own, centroids)
        radius = [_radius(own, centroids)] * len(found)
        offsets = np.arange(len(found) + 1, dtype=np.int32) * dims
        return pa.table(
            {
                "lang": pa.array([rows.column("lang")[0].as_py()] * len(found), pa.string()),
                "place": pa.array(range(len(found)), pa.int32()),
                "centroid": pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.astype(np.float32).ravel())),
                "radius": pa.array(radius, pa.float32()),
            }
        )

    return run


def _vectors(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", SLICE_BYTES, SLICE_ROWS):
            texts = [letters_only(d) for d in batch.column("data").to_pylist()]
            some = np.array([bool(t) for t in texts], bool)
            if not some.any():
                continue
            v = unit_vectors(gram_counts([t for t in texts if t], len(idf)), idf)
            offsets = np.arange(len(v) + 1, dtype=np.int32) * len(idf)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).filter(pa.array(some)) for c in ("h", "lang")), pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.ravel()))],
                names=["h", "lang", "vector"],
            )

    return run


def least_cosines(model: LanguageModel, pick: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """From what cosine to its nearest centroid each text is accepted."""
    return model.radius[pick] * (0.5 + 0.5 * np.minimum(1.0, lengths / SHORT_TEXT))


def nearest(model: LanguageModel, data: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest centroid (their number: none), its cosine, and
    whether the text is rejected, for each text."""
    texts = [letters_only(d) for d in data]
    best, score, far = np.full(len(texts), len(model.langs)), np.zeros(len(texts)), np.ones(len(texts), bool)
    known = np.array([i for i, t in enumerate(texts) if t], np.int64)
    if len(known) and model.langs:
        likeness = unit_vectors(gram_counts([texts[i] for i in known], len(model.idf)), model.idf) @ model.centroids
        pick = likeness.argmax(axis=1)
        found = likeness[np.arange(len(known)), pick]
        best[known], score[known] = pick, np.clip(found, 0, 1)
        far[known] = found < least_cosines(model, pick, np.array([len(texts[i]) for i in known]))
    return best, score, far


def _predictions(model: LanguageModel):
    names = np.array([*model.langs, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", SLICE_BYTES, SLICE_ROWS):
            best, score, far = nearest(model, batch.column("data").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(far)], names=["doc_id", "lang_pred", "score", "rejected"]
            )

    return run


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``lang_pred``, ``score`` (cosine, 0
    to 1), ``rejected`` (too far from every centroid). A null text or one
    without a letter is ``und``, scores 0 and is rejected; so is every text
    under a model that learned nothing. Equal cosines: the first language in
    alphabetical order."""
    id_type = docs.schema[id_col].dataType.simpleString()
    return ids_and_bytes(docs, id_col, text_col).mapInArrow(_predictions(model), f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def keep_recognised(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows that :func:`predict_languages` does not reject, all columns."""

    def run(parts):
        for batch, texts in parts:
            yield batch.filter(pa.array(~nearest(model, texts)[2])), []

    return map_whole_rows(docs, text_col, run, limit=SLICE_BYTES, rows=SLICE_ROWS)
