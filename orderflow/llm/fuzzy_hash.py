"""Context-triggered piecewise hashes.

A rolling hash of the last seven bytes ends a chunk wherever its remainder
modulo the block size is the block size less one; each chunk gives one base-64
character of its hash. The block size doubles from 3 until the text has at
most 64 chunks or so, and is halved while the signature is short. A
fingerprint holds the signatures at the block size and its double, so texts
whose block sizes are equal or differ by one doubling can be compared: by edit
distance, scaled to a likeness from 0 to 1.

The neighbour query needs each document's successor by id. Ids are cut into
ranges of about ``RANGE_BYTES`` of text; every range also gets the first document
of the next one as a guard row, so the ranges are read side by side and in
order, a few rows in memory at a time. The driver sees ids only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderflow.llm.common import ids_and_bytes, slices

WINDOW = 7
LEAST_BLOCK = 3
LENGTH = 64
SLICE_BYTES = 1 << 20
#: Bytes of text in a range of ids, on average.
RANGE_BYTES = 16 << 20
#: Ranges at most (beyond it they hold more bytes: they are sorted and read row
#: by row, so this bounds the driver's list of bounds, not what is read).
MOST_RANGES = 20_000
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


class _Powers:
    """Powers of the chunk hash's multiplier and of its inverse."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, s, np.uint64)))) for s in (_STEP, _BACK))
        return self.up[:n], self.down[:n]


def rolling_hash(a: np.ndarray) -> np.ndarray:
    """Of the last ``WINDOW`` bytes at every place (zeros before the text):
    their sum, their sum weighted by nearness, and their shifted exclusive or."""
    padded = np.concatenate((np.zeros(WINDOW - 1, np.uint32), a.astype(np.uint32)))
    n = len(a)
    out, mixed = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for back in range(WINDOW):
        c = padded[WINDOW - 1 - back : WINDOW - 1 - back + n]
        out += c * np.uint32(1 + WINDOW - back)
        mixed ^= c << np.uint32(5 * back) if 5 * back < 32 else np.uint32(0)
    return out + mixed


def _signature(ends: np.ndarray, size: int, prefix: np.ndarray, down: np.ndarray, longest: int) -> str:
    """A character for each chunk; beyond ``longest - 1`` chunks the rest of
    the text is the last one."""
    ends = ends[: longest - 1]
    stops = np.append(ends, size - 1) if not len(ends) or ends[-1] < size - 1 else ends
    begins = np.concatenate(([0], stops[:-1] + 1))
    value = (prefix[stops + 1] - prefix[begins]) * down[begins]
    value ^= value >> np.uint64(32)
    value *= np.uint64(_STEP)
    return _DIGITS[(value >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes, powers: _Powers) -> str:
    """``block:signature:signature at twice the block``; the empty text has
    ``3::``."""
    n = len(data)
    if not n:
        return f"{LEAST_BLOCK}::"
    a = np.frombuffer(data, np.uint8)
    up, down = powers.upto(n + 1)
    prefix = np.concatenate(([np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:n])))
    roll = rolling_hash(a)
    block = LEAST_BLOCK
    while block * LENGTH < n:
        block *= 2
    while True:
        ends = np.flatnonzero(roll % np.uint32(block) == block - 1)
        if len(ends) >= LENGTH // 2 or block == LEAST_BLOCK:
            break
        block //= 2
    double = np.flatnonzero(roll % np.uint32(2 * block) == 2 * block - 1)
    return f"{block}:{_signature(ends, n, prefix, down, LENGTH)}:{_signature(double, n, prefix, down, LENGTH // 2)}"


def likeness(left: Column, right: Column) -> Column:
    """0 to 1 for two fingerprint columns: the greater of the likenesses at
    the block sizes that both have; 1 for equal ones; 0 if there is none or a
    side is empty. Null if a side is null."""
    block_l, block_r = (F.split_part(c, F.lit(":"), F.lit(1)).cast("bigint") for c in (left, right))
    one_l, one_r = (F.split_part(c, F.lit(":"), F.lit(2)) for c in (left, right))
    two_l, two_r = (F.split_part(c, F.lit(":"), F.lit(3)) for c in (left, right))

    def near(a: Column, b: Column) -> Column:
        longest = F.greatest(F.length(a), F.length(b))
        return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(1 - F.levenshtein(a, b) / longest)

    return (
        F.when(left == right, 1.0)
        .when(block_l == block_r, F.greatest(near(one_l, one_r), near(two_l, two_r)))
        .when(block_l == 2 * block_r, near(one_l, two_r))
        .when(2 * block_l == block_r, near(two_l, one_r))
        .when(left.isNotNull() & right.isNotNull(), 0.0)
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; a null text is empty.
    Equal texts have equal fingerprints."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in slices(batches, "data", SLICE_BYTES):
            texts = [d or b"" for d in batch.column("data").to_pylist()]
            chars = [len(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(chars, pa.int64()), pa.array([fingerprint(t, powers) for t in texts], pa.string())], names=["doc_id", "n_chars", "fingerprint"]
            )

    return ids_and_bytes(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type}, n_chars bigint, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last ``floor(n / 2)`` characters replaced by the first as many of
    ``following`` (or all of it)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _with_successors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range come in order, its guard row last."""
    powers = _Powers()
    before = None  # part, id, text, fingerprint
    schema = None
    rows: list[tuple] = []

    def pack() -> pa.RecordBatch:
        types = [schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in slices(batches, "data", SLICE_BYTES):
        schema = batch.schema
        for part, guard, doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("part", "guard", "doc_id", "data")), strict=True):
            data = data or b""
            text, own = data.decode("utf-8", "replace"), fingerprint(data, powers)
            if before is not None and before[0] == part:
                _, b_id, b_text, b_own = before
                edited = edited_text(b_text, text).encode()
                rows.append((b_id, len(b_text), hashlib.sha256(edited).hexdigest(), b_own, fingerprint(edited, powers), own))
            before = None if guard else (part, doc_id, text, own)
        if rows:
            yield pack()
            rows = []


def _range_of(value: Column, cuts: list) -> Column:
    """The place of the last of the ascending ``cuts`` that is not above the
    value: looked for among every ``k``-th first, then between two of these."""
    if not cuts:
        return F.lit(-1)
    k = math.isqrt(len(cuts)) + 1
    every, some = (F.array(*map(F.lit, c)) for c in (cuts, cuts[::k]))
    block = F.greatest(F.size(F.filter(some, lambda c: c <= value)), F.lit(1)) - 1
    within = F.size(F.filter(F.slice(every, block * k + 1, F.lit(k)), lambda c: c <= value))
    return F.when(value.isNotNull(), block * k + within - 1)


def compare_with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``, where the edited text has
    its last half replaced by the beginning of the next document by ascending
    id, and ``near_next`` compares with that document. The last document is
    followed by the first; a single one by itself. Ids are of any type with an
    order. Null texts are empty; null ids come first; rows of one id are ordered
    by their text."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    rows = ids_and_bytes(docs, id_col, text_col)
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.count("*")).first()
    parts = min(MOST_RANGES, max(1, -(-(size + 16 * n) // RANGE_BYTES)))
    # Spark's range exchange of the ids alone gives the least id of each range.
    least = rows.where("doc_id is not null").select("doc_id").repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("least"))
    cuts = sorted(r.least for r in least.collect())
    # Range p holds the ids from its least one up to that of the next; null ids
    # are a range of their own, before all others.
    spark_type = rows.schema["doc_id"].dataType
    bounds = spark.createDataFrame([(i, c, cuts[i + 1] if i + 1 < len(cuts) else None) for i, c in enumerate(cuts)], StructType([StructField("range", IntegerType()), StructField("low", spark_type), StructField("high", spark_type)]))
    placed = rows.select(F.coalesce(_range_of(F.col("doc_id"), cuts), F.lit(-1)).cast("int").alias("part"), "doc_id", "data")
    # The first document of each range, the least text of its least id (of null
    # ids the least text), is the guard of the range before it.
    first = placed.join(F.broadcast(bounds), F.col("doc_id") == F.col("low"), "left").where("low is not null or doc_id is null")
    heads = first.groupBy("part").agg(F.min(F.struct(F.coalesce("data", F.lit(b"")).alias("text"), "doc_id", "data")).alias("f"))
    unnamed = rows.where("doc_id is null").limit(1).count()  # whether there is one
    used = [-1] * unnamed + list(range(len(cuts)))
    if not used:
        return spark.createDataFrame([], schema).withColumns({"near_edited": F.lit(0.0), "near_next": F.lit(0.0)}).drop("next_fingerprint")
    before = spark.createDataFrame([(p, used[i - 1]) for i, p in enumerate(used)], "of int, before int")
    guards = heads.join(F.broadcast(before), F.col("part") == F.col("of")).select(F.col("before").alias("part"), "f.doc_id", "f.data")
    both = placed.withColumn("guard", F.lit(False)).unionByName(guards.withColumn("guard", F.lit(True)))
    dealt = both.repartition(len(used), "part").sortWithinPartitions("part", "guard", F.col("doc_id").asc_nulls_first(), F.coalesce("data", F.lit(b"")))
    found = dealt.select("part", "guard", "doc_id", "data").mapInArrow(_with_successors, schema)
    near = {"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"))}
    return found.withColumns(near).drop("next_fingerprint")
