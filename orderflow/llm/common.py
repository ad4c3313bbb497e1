"""Helpers shared by the operators: tables, staging, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from orderflow.session import new_work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    later steps plan against a plain scan, and a lost executor costs a task
    retry instead of a recomputation."""
    spark = df.sparkSession
    path = f"{new_work_dir(spark, label)}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary") if isinstance(col, str) else col.cast("string").cast("binary")) % F.lit(modulus)


def ids_and_bytes(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The two columns an operator works on, under names of its own, so that
    other columns of ``docs`` cannot clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("data"), *more)


def map_whole_rows(
    docs: DataFrame,
    text_col: str,
    function: Callable[[Iterator[tuple[pa.RecordBatch, list[bytes | None]]]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]],
    more: Sequence[StructField] = (),
    limit: int = 1 << 21,
    rows: int = 1 << 30,
) -> DataFrame:
    """Run ``function`` over slices of whole rows and their texts as bytes; it
    yields rows of the slice with the arrays of the ``more`` columns. Columns
    travel by position, so no name of ``docs`` can clash."""
    place = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)] + [StructField(f"m{i}", f.dataType) for i, f in enumerate(more)])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
        for batch in slices(batches, names[place], limit, rows):
            yield batch, batch.column(place).cast(pa.binary()).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in function(pairs(batches)):
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=inner.names)

    done = docs.toDF(*names).mapInArrow(run, inner)
    return done.toDF(*docs.columns, *(f.name for f in more))


class WordCache(dict):
    """``value(word)`` of words, kept between documents; emptied before it
    holds more than ``limit`` bytes."""

    def __init__(self, value: Callable[[bytes], object], limit: int = 24 << 20):
        super().__init__()
        self.value, self.limit, self.held = value, limit, 0

    def __missing__(self, word: bytes) -> object:
        self.held += len(word) + 160  # the word, its value and the entry
        if self.held > self.limit:
            self.clear()
            self.held = len(word) + 160
        value = self[word] = self.value(word)
        return value


def in_blocks(rows: DataFrame, size: Column, block_bytes: int) -> DataFrame:
    """Staged ``rows`` with ``item``, a number for each row, and ``block``:
    rows whose sizes add up to about ``block_bytes`` have the same. Sizes are
    summed within the parts of the rows, so no task sees all of them."""
    numbered = stage(rows.withColumns({"size": F.coalesce(size, F.lit(0)).cast("long") + 16, "item": F.monotonically_increasing_id()}), "items")
    part = F.shiftright("item", 33)
    sums = numbered.groupBy(part.alias("part")).agg(F.sum("size").alias("whole"))
    before = sums.select("part", (F.sum("whole").over(Window.orderBy("part")) - F.col("whole")).alias("before"))
    within = F.sum("size").over(Window.partitionBy("part").orderBy("item"))
    placed = numbered.withColumn("part", part).join(before, "part").withColumn("block", F.floor((F.col("before") + within) / block_bytes))
    return stage(placed.drop("part", "before", "size"), "item_blocks")


def words(data: bytes | None) -> list[bytes]:
    """Lower-case A-Z; words are runs of bytes other than space and
    ``\\x09-\\x0D`` (what ``bytes.split`` and ``bytes.lower`` do)."""
    return data.lower().split() if data else []


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in
    each (one row at least, ``rows`` at most): bounds the memory of vectorised
    work."""
    for batch in batches:
        sizes = batch.column(column)
        lengths = np.nan_to_num(np.asarray(pc.binary_length(sizes).to_numpy(zero_copy_only=False), dtype=float))
        start, held = 0, 0.0
        for i, n in enumerate(lengths):
            if i > start and (held + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0.0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over a uint64 array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
