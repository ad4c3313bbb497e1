"""Exact ranked lexical search by dense blocks of BLAS products.

Items (the queries) are numbered and cut into blocks of bounded text by a
Spark job and written; blocks are read one at a time. Within a block, items
with their vocabulary form tiles: a dense matrix of term weights, terms by
items. Each task turns its documents into dense tiles of term impacts,
documents by terms, and multiplies the two in float64. Weights and impacts are
integers, and the columns are cut so that no partial sum reaches 2^53: every
product is exact whatever order BLAS adds in. A tile keeps its best documents
by score and id, ties included, so that merging tiles loses none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import in_blocks, slices, stage

#: Results for each item.
TOP = 10
#: Bytes of item text that are sent to the tasks at a time.
BLOCK_BYTES = 2 << 20
#: Items in a tile, and documents in a tile.
TILE_ITEMS = 64
TILE_DOCS = 256
#: Bytes of document text that a task holds at a time.
SLICE_BYTES = 1 << 20
#: Terms whose counts a task holds before passing them on.
HELD_TERMS = 200_000
#: Of an item's weight and of a document's impact.
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
EXACT = 1 << 53

# Terms are runs of digits, ASCII letters (folded) and bytes above 0x7F.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(data: bytes | None) -> list[bytes]:
    return data.translate(_FOLD).split() if data else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, partial by task; the row without a term
    has documents with terms (``n``) and all terms (``length``)."""
    holders: Counter[bytes] = Counter()
    n = length = 0

    def flush(*last: tuple[int, int]) -> pa.RecordBatch:
        names = [*holders, *[None] * len(last)]
        counts = [*holders.values(), *(x for x, _ in last)]
        lengths = [0] * len(holders) + [y for _, y in last]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(counts, pa.int64()), pa.array(lengths, pa.int64())], names=["term", "n", "length"])

    for batch in slices(batches, "data", SLICE_BYTES):
        for text in batch.column("data").to_pylist():
            own = terms(text)
            n += bool(own)
            length += len(own)
            holders.update(set(own))
            if len(holders) > HELD_TERMS:
                yield flush()
                holders.clear()
    yield flush((n, length))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "data", SLICE_BYTES):
        found = [sorted(set(terms(t))) for t in batch.column("data").to_pylist()]
        at = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
        names = pa.array([w for x in found for w in x], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(at)) for c in ("block", "item")] + [names], names=["block", "item", "term"])


class Tile:
    """Some items: their numbers, their terms, and the weights in blocks of
    columns whose sums of products stay below 2^53."""

    def __init__(self, items: list[int], weights: dict[int, dict[bytes, int]]) -> None:
        self.items = np.array(items, np.int64)
        vocabulary = sorted({w for i in items for w in weights[i]})
        self.columns = {w: c for c, w in enumerate(vocabulary)}
        self.weights = np.zeros((len(vocabulary), len(items)))
        for c, i in enumerate(items):
            for w, weight in weights[i].items():
                self.weights[self.columns[w], c] = weight
        # An impact is below IMPACT_SCALE / WEIGHT_SCALE, so a block of
        # columns may hold weights of this sum for any item.
        most, self.cuts, held = EXACT // (IMPACT_SCALE // WEIGHT_SCALE), [0], np.zeros(len(items))
        for row, own in enumerate(self.weights):
            if np.any(held + own >= most):
                self.cuts.append(row)
                held[:] = 0
            held += own
        self.cuts.append(len(vocabulary))

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """Documents by items, in exact integers."""
        total = np.zeros((len(impacts), len(self.items)), np.int64)
        for a, z in zip(self.cuts, self.cuts[1:], strict=False):
            used = a + np.flatnonzero(impacts[:, a:z].any(axis=0))
            total += (impacts[:, used] @ self.weights[used]).astype(np.int64)
        return total


def tiles_of(weights: dict[int, dict[bytes, int]], size: int = TILE_ITEMS) -> list[Tile]:
    items = sorted(weights)
    return [Tile(items[i : i + size], weights) for i in range(0, len(items), size)]


def _impacts(found: list[tuple[int, int, int]], lengths: list[int], n_docs: int, n_terms: int, shape: tuple[int, int]) -> np.ndarray:
    """The dense impacts of ``(row, column, tf)`` entries; ``lengths`` are the
    terms of each row's document."""
    out = np.zeros(shape)
    if found:
        row, column, tf = np.array(found, np.int64).T
        m = np.array([10 + 90 * n * n_docs // max(n_terms, 1) for n in lengths], np.int64)
        out[row, column] = IMPACT_SCALE * tf // (WEIGHT_SCALE * tf + 8 * m[row])
    return out


def _better(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """Places of the best ``top`` scores above 0: highest first, then the
    least id, rows without an id last."""
    held = np.flatnonzero(scores > 0)
    if len(held) > top:
        # All that tie with the last place stay until the ids decide.
        least = np.partition(scores[held], len(held) - top)[len(held) - top]
        held = held[scores[held] >= least]
    return held[np.lexsort((ids[held], null[held], -scores[held]))[:top]]


def _search(tiles: list[Tile], n_docs: int, n_terms: int, top: int, docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * len(t.items) for t in tiles]
        vocabulary = {w for t in tiles for w in t.columns}
        for batch in slices(batches, "data", SLICE_BYTES, docs):
            known = np.asarray(batch.column("doc_id").is_valid())
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            lengths, counts = [], []
            for text in batch.column("data").to_pylist():
                own = terms(text)
                lengths.append(len(own))
                counts.append(Counter(filter(vocabulary.__contains__, own)))
            for tile, kept in zip(tiles, best, strict=True):
                columns = tile.columns
                found = [(row, columns[w], tf) for row, own in enumerate(counts) for w, tf in own.items() if w in columns]
                scores = tile.scores(_impacts(found, lengths, n_docs, n_terms, (len(ids), len(columns))))
                for c in np.flatnonzero((scores > 0).any(axis=0)).tolist():
                    at = _better(scores[:, c], ids, ~known, top)
                    merged = [np.concatenate(x) for x in zip(kept[c], (scores[at, c], ids[at], ~known[at]), strict=True)]
                    first = _better(merged[0], merged[1], merged[2], top)
                    kept[c] = tuple(x[first] for x in merged)
        for tile, kept in zip(tiles, best, strict=True):
            item = np.repeat(tile.items, [len(k[0]) for k in kept])
            score, ids, null = (np.concatenate([k[j] for k in kept]) for j in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every row of
    ``items`` with the highest score above 0, equal scores by ascending id
    (rows without an id last). The score sums, over the item's terms, a weight
    that falls with the documents holding the term times an impact that rises
    with its occurrences and falls with the document's length.

    Null texts have no term; an item without terms has no result. Rows that
    repeat an id each count, as documents and as items. Ids of documents are
    whole numbers. Other columns are not read. Empty tables give an empty result.
    The result is read from the checkpoint folder.
    """
    spark = docs.sparkSession
    data = F.col(f"`{text_col}`").cast("string").cast("binary").alias("data")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), data)
    item_type = items.schema[item_col].dataType.simpleString()
    cut = in_blocks(items.select(F.col(f"`{item_col}`").alias("item_id"), data), F.octet_length("data"), block_bytes)
    counts = stage(rows.select("data").mapInArrow(_count, "term binary, n long, length long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("length").alias("length")), "terms")
    total = counts.where("term is null").first()
    n_docs, n_terms = (total.n, total.length) if total else (0, 0)
    weight = F.floor(F.lit(float(WEIGHT_SCALE)) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.coalesce(F.col("n"), F.lit(0)) + 1.0)))
    asked = cut.mapInArrow(_item_terms, "block long, item long, term binary")
    weighed = stage(asked.join(counts.where("term is not null").select("term", "n"), "term").select("block", "item", "term", weight.alias("weight")), "weights")
    found = None
    for (block,) in weighed.select("block").distinct().orderBy("block").toLocalIterator():
        weights: dict[int, dict[bytes, int]] = {}
        for r in weighed.where(F.col("block") == block).toLocalIterator():
            weights.setdefault(r.item, {})[bytes(r.term)] = r.weight
        best = rows.mapInArrow(_search(tiles_of(weights), n_docs, n_terms, top, TILE_DOCS), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = stage(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "ranked")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return found.join(cut.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
