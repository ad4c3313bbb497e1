"""Near-duplicate documents by circulant MinHash.

A document's set is its distinct word 5-grams. Two permutations make the
whole signature: the first scatters the shingles over a universe of 2**32,
the second ranks them, and coordinate ``k`` ranks the scattered set shifted
circularly by ``k``. Bands of the signature give candidates; every link is
confirmed by exact Jaccard on the full sets.

Copies of one word sequence are folded into their smallest id before any
banding. Inside a band bucket no pair list is made: its members are compared
with its smallest document. Those of buckets that still lie in several
components meet again in buckets of rare shingles (an exact filter), and are
compared with ever more pivots of these until every bucket is settled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import WordCache, ids_and_bytes, mix64, slices, stage, words
from orderflow.llm.components import connected_components

SHINGLE_WORDS = 5
BANDS, ROWS = 40, 5  # a pair at Jaccard 0.75 shares no band in 20 of a million cases
THRESHOLD_PCT = 75
CHUNK_BYTES = 1 << 19
PIVOT_GROWTH = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(tokens: list[bytes], hashes: dict, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``width``-grams; a shorter
    text is one shingle, no words none."""
    n = len(tokens)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, n)
    if n < width:
        out = np.uint64(n) + _STEP
        for i in range(n):
            out = np.multiply(out, _STEP) + h[i : i + 1]
        return mix64(out)
    out = h[: n - width + 1].copy()
    for i in range(1, width):
        out *= _STEP
        out += h[i : n - width + 1 + i]
    out = np.sort(mix64(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def _scatter(x: np.ndarray) -> np.ndarray:
    """First permutation of the universe of 32-bit numbers."""
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(13)
    return x


def signatures(flat: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Circulant signatures ``(size, documents)`` of the concatenated,
    non-empty sets that begin at ``starts``."""
    base = _scatter(flat.astype(np.uint32))
    y, t = np.empty_like(base), np.empty_like(base)
    out = np.empty((size, len(starts)), np.uint32)
    for k in range(size):
        np.add(base, np.uint32(k), out=y)  # circular shift by k
        np.multiply(y, np.uint32(0x7FEB352D), out=y)  # second permutation
        np.right_shift(y, np.uint32(15), out=t)
        np.bitwise_xor(y, t, out=y)
        np.multiply(y, np.uint32(0x846CA68B), out=y)
        np.right_shift(y, np.uint32(16), out=t)
        np.bitwise_xor(y, t, out=y)
        out[k] = np.minimum.reduceat(y, starts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``(documents, bands)`` 64-bit keys; the band's number is part of it."""
    parts = sig.reshape(bands, rows, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)[:, None] * _STEP + parts[:, 0]
    for r in range(1, rows):
        key = mix64(key) + parts[:, r]
    return mix64(key).T.view(np.int64)


def _sketches(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordCache(xxhash.xxh64_intdigest)
        for batch in slices(batches, "data", CHUNK_BYTES):
            keys, sizes, sets = [], [], []
            for data in batch.column("data").to_pylist():
                tokens = words(data)
                found = shingle_set(tokens, hashes, width)
                keys.append(xxhash.xxh3_128_digest(b" ".join(tokens)))
                sizes.append(len(found))
                if len(found):
                    sets.append(found)
            n = np.array(sizes, np.int64)
            full = n[n > 0]
            count = np.where(n > 0, bands, 0)
            if len(full):
                sig = signatures(np.concatenate(sets), np.concatenate(([0], np.cumsum(full)[:-1])), bands * rows)
                values = np.ascontiguousarray(band_keys(sig, bands, rows)).ravel()
            else:
                values = np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["doc_id", "content", "n", "bands"],
            )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordCache(xxhash.xxh64_intdigest)
        for batch in slices(batches, "data", 4 * CHUNK_BYTES):
            sets = [shingle_set(words(data), hashes, width).view(np.int64) for data in batch.column("data").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "shingles"]
            )

    return run


def _links(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets meet the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("c"))
    return common.where(F.col("c") * 100 >= (F.col("na") + F.col("nb") - F.col("c")) * pct).select("a", "b").distinct()


def _rare_buckets(ids: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """``(band, rep, n, at, lead)`` with a rare shingle in the place of the band.

    In any one order of all shingles, here from the rarest on, two sets that
    meet the threshold share a shingle that is among the first ``n - ceil(2 *
    pct / (100 + pct) * n) + 1`` of the smaller one (``lead``) and the first
    ``n - ceil(pct / 100 * n) + 1`` of the other: a passage that many
    documents share makes no bucket unless it is most of them."""
    held = ids.join(sets, ids["rep"] == sets["doc_id"]).select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    counted = held.join(held.groupBy("s").agg(F.count("*").alias("docs")), "s")
    ordered = counted.groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("docs", "s"))).alias("l"))
    met, led = (F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1 for share in (pct / 100, 2 * pct / (100 + pct)))
    first = ordered.select("rep", "n", led.alias("led"), F.posexplode(F.slice("l", F.lit(1), met.cast("int"))).alias("at", "e"))
    return first.where("e.docs > 1").select(F.col("e.s").alias("band"), "rep", "n", "at", (F.col("at") < F.col("led")).alias("lead"))


def _repeated_ids(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("copies")).where("copies > 1").select("doc_id")


def _keyed(rows: DataFrame) -> DataFrame:
    """``doc_id`` with the text's digest, in the order of the ids; null
    without an id. Rows of one id with different texts have different keys."""
    key = F.struct("doc_id", F.unhex(F.sha1(F.coalesce("data", F.lit(b"")))).alias("text"))
    return rows.withColumn("key", F.when(F.col("doc_id").isNotNull(), key))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold_pct: int = THRESHOLD_PCT,
    bands: int = BANDS,
    rows: int = ROWS,
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``
    (smallest id reachable over links), ``kept`` (is that document).

    Null or wordless texts have no shingles and link with nothing. Where ids
    repeat, rows are judged by id and text: of the texts of the component's
    smallest id one is kept, equal rows alike. A row without an id cannot be
    named by a link: its ``component_id`` is null and it is kept. An empty table
    gives an empty result.
    """
    rows_in = ids_and_bytes(docs, id_col, text_col)
    if _repeated_ids(rows_in).isEmpty():
        return _judged(rows_in, threshold_pct, bands, rows, width)
    keyed = _keyed(rows_in).select(F.col("key").alias("doc_id"), "data")
    found = _judged(keyed, threshold_pct, bands, rows, width)
    return found.select("doc_id.doc_id", "n_shingles", "component_id.doc_id", "kept").toDF("doc_id", "n_shingles", "component_id", "kept")


def _judged(rows_in: DataFrame, threshold_pct: int, bands: int, rows: int, width: int) -> DataFrame:
    """:func:`near_duplicates` of ``doc_id, data``; rows that repeat an id
    have equal texts."""
    id_type = rows_in.schema["doc_id"].dataType.simpleString()
    sketch = stage(
        rows_in.mapInArrow(_sketches(bands, rows, width), f"doc_id {id_type}, content binary, n bigint, bands array<bigint>"),
        "sketches",
    )
    named = sketch.where("doc_id is not null and n > 0")
    folded = stage(named.groupBy("content").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.any_value("bands").alias("bands")), "folded")
    spread = folded.select("rep", "n", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(spread.join(shared.select("band"), "band"), "members")
    candidates = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(rows_in.join(candidates, "doc_id", "left_semi").mapInArrow(_full_sets(width), f"doc_id {id_type}, shingles array<bigint>"), "sets")

    pivots, done, roots = 1, None, None
    rest = members.select("band", "rep", "n", F.lit(0).alias("at"), F.lit(True).alias("lead"), F.col("rep").alias("root"))
    while True:
        if pivots > 1:
            # Buckets with documents of several components and one to lead.
            open_ = rest.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("lead").alias("lead")).where("lo <> hi and lead").select("band")
            rest = stage(rest.join(open_, "band"), "rest")
        if rest.isEmpty():
            break
        if pivots == PIVOT_GROWTH:
            ids = stage(rest.select("rep", "root").distinct(), "ids")
            rest = stage(_rare_buckets(ids.select("rep"), sets, threshold_pct).join(ids, "rep").select("band", "rep", "n", "at", "lead", "root"), "rare")
        leads = rest.where("lead")
        if pivots == 1:
            lead = leads.groupBy("band").agg(F.min(F.struct("n", "rep", "at", "root")).alias("p")).select("band", "p.*")
        else:
            order = Window.partitionBy("band").orderBy("n", "rep")
            lead = leads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pivots).drop("rank")
        lead = lead.select("band", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("at").alias("ata"), F.col("root").alias("ra"))
        pairs = (
            rest.join(lead, "band")
            .where("(n > na or n = na and rep > a) and root <> ra")
            # What follows the shared shingle in both must still make the overlap.
            .where(F.least(F.col("na") - F.col("ata"), F.col("n") - F.col("at")) * (100 + threshold_pct) >= (F.col("na") + F.col("n")) * threshold_pct)
            .where(F.col("na") * 100 >= F.col("n") * threshold_pct)
            .select("a", F.col("rep").alias("b"))
            .distinct()
        )
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        done = pairs if done is None else done.unionByName(pairs)
        links = stage(_links(pairs, sets, threshold_pct), "links")
        if roots is None:
            roots = connected_components(links)
        elif not links.isEmpty():
            earlier = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = connected_components(links.unionByName(earlier))
        # Pivots have met every larger member of their bucket and leave it.
        last = lead.groupBy("band").agg(F.max(F.struct("na", "a")).alias("last"))
        rest = (
            rest.drop("root")
            .join(last, "band")
            .where("n > last.na or n = last.na and rep > last.a")
            .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
            .select("band", "rep", "n", "at", "lead", F.coalesce("root", "rep").alias("root"))
        )
        pivots *= PIVOT_GROWTH

    reps = folded.select("content", "rep")
    if roots is not None:
        reps = reps.join(roots, reps["rep"] == roots["node"], "left").select("content", F.coalesce("root", "rep").alias("rep"))
    placed = sketch.join(reps, "content", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns: one of each group of
    near-duplicates, that of the smallest id. Rows without an id all stay, as
    do rows without words. Where ids repeat, rows are judged by id and text: a
    text that is like no other stays, and of rows that are equal in both the
    one with the least other columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own_id, own_text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    rows = docs.toDF(*names)
    pair = rows.select(F.col(own_id).alias("doc_id"), F.col(own_text).cast("string").cast("binary").alias("data"))
    if _repeated_ids(pair).isEmpty():
        gone = stage(near_duplicates(docs, id_col, text_col).where("not kept").select("doc_id"), "gone")
        return rows.join(gone, F.col(own_id) == F.col("doc_id"), "left_anti").toDF(*docs.columns)
    keyed = _keyed(pair).select(F.col("key").alias("doc_id"), "data")
    judged = stage(_judged(keyed, THRESHOLD_PCT, BANDS, ROWS, SHINGLE_WORDS).select(F.col("doc_id").alias("key"), "n_shingles", "kept"), "judged")
    gone = judged.where("not kept").select("key").distinct()
    again = judged.where("key is not null and n_shingles > 0").groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1").select(F.col("key").alias("again"))
    marked = _keyed(rows.withColumns({"doc_id": F.col(own_id), "data": F.col(own_text).cast("string").cast("binary")})).drop("doc_id", "data")
    left = marked.join(gone, "key", "left_anti").join(again, F.col("key") == F.col("again"), "left")
    # Only rows that are equal in id and text are ranked.
    order = [F.col(n).asc_nulls_last() for n, f in zip(names, docs.schema.fields, strict=True) if not f.dataType.simpleString().count("map<") and n != own_text]
    first = left.where("again is not null").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where("rank = 1")
    return first.select(*names).unionByName(left.where("again is null").select(*names)).toDF(*docs.columns)
