"""PCA whitening of embeddings with MLlib's BlockMatrix.

Entries are put on a grid of 1/256, so that sums and deviations are exact
integers. The distinct vectors are dealt into blocks of bounded bytes, centred
and numbered: a distributed BlockMatrix. Its transpose times itself is the
scatter matrix (dimension by dimension), whose eigenvectors are found locally;
a second BlockMatrix product with the whitening matrix projects all blocks.
Rows take their projection by a join on the vector, so equal vectors are
projected once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stage

COMPONENTS = 4
#: Steps of the grid in a unit.
GRID = 256
#: Bytes of a centred block at least; blocks grow beyond so many of them, as the
#: driver plans a product by the numbers of all blocks.
BLOCK_BYTES, MOST_BLOCKS = 512 << 10, 1 << 20
#: Blocks of one product that meet in a task.
BLOCKS_A_TASK = 32
#: Eigenvalues below this share of the largest one, times the dimension, are
#: rounding noise of a zero: such a component cannot be scaled.
NOISE = 1e-14
LONG = 1 << 63


def _on_grid(d: int):
    """Vectors as integers, packed at the least width that holds them (equal
    vectors have equal bytes)."""

    def pack(x: np.ndarray) -> bytes:
        most = max(int(x.max()), -int(x.min()) - 1)
        width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
        return x.astype(f"<i{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            x = np.floor(GRID * flat.astype(np.float64)).astype(np.int64).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([pack(v) for v in x], pa.binary())], names=["vec_id", "x"])

    return run


def _opened(packed: list[bytes], d: int) -> np.ndarray:
    return np.array([np.frombuffer(b, f"<i{len(b) // d}") for b in packed], np.int64).reshape(-1, d)


def _blocks(rows: int):
    """Distinct vectors in blocks of at most ``rows``, numbered within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held = TaskContext.get().partitionId(), 0, []

        def block(xs: list[bytes]) -> pa.RecordBatch:
            columns = [pa.array([part], pa.int64()), pa.array([place], pa.int64()), pa.array([xs], pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["part", "place", "xs"])

        for batch in batches:
            held += batch.column("x").to_pylist()
            while len(held) >= rows:
                yield block(held[:rows])
                held, place = held[rows:], place + 1
        if held:
            yield block(held)

    return run


def _sums(d: int):
    """Sums of a task's vectors by dimension; their number at dimension -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64), 0
        for batch in batches:
            for xs in batch.column("xs").to_pylist():
                total += _opened(xs, d).sum(axis=0)
                n += len(xs)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array(np.concatenate(([n], total)))], names=["at", "total"])

    return run


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums of squares of ``n * x - sums`` (null above a long)."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most * most * x.shape[1] < LONG:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return [v if v < LONG else None for v in exact]


def _spread(d: int, n: int, sums: np.ndarray):
    """A row for each distinct vector of a block, with its projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for xs, whitened in zip(batch.column("xs").to_pylist(), batch.column("whitened").to_pylist(), strict=True):
                own = np.frombuffer(whitened, "<f8").reshape(len(xs), -1)
                columns = [
                    pa.array(xs, pa.binary()),
                    pa.array(_deviations(_opened(xs, d), n, sums), pa.int64()),
                    pa.array(list(own), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["x", "deviation", "whitened"])

    return run


def _products(k: int, centre: np.ndarray):
    """Sums of products of the centred projections, by entry (row * k + column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            own = batch.column("whitened").flatten().to_numpy().reshape(-1, k) - centre
            total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], names=["at", "total"])

    return run


def _by_place(df: DataFrame, size: int, kind: type) -> np.ndarray:
    """Partial sums of tasks, added up: ``size`` numbers on the driver."""
    out = np.zeros(size, kind)
    for r in df.groupBy("at").agg(F.sum("total").alias("total")).collect():
        out[r["at"]] = r["total"]
    return out


def _multiply(left: BlockMatrix, right: BlockMatrix, n_blocks: int) -> BlockMatrix:
    """The product, with the inner dimension dealt out so that a task meets
    ``BLOCKS_A_TASK`` blocks of each side."""
    splits = max(1, -(-n_blocks // BLOCKS_A_TASK))
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every row with a whole vector and each of the first ``components``
    principal components.

    Entries become ``floor(256 * entry)``. The fit uses each distinct vector
    once: ``n`` vectors; ``deviation`` is the sum over dimensions of ``(n * x -
    sum of x) ** 2`` (exact; null above a long), ``whitened`` the centred vector's
    projection over the component's standard deviation, ``explained`` the
    component's share of the variance, ``identity_error`` the largest entry
    by which the covariance of ``whitened`` differs from the identity.

    Rows whose vector is null, shorter than the longest one, or holds a null or
    an entry that is not finite are dropped. Ids may be null or repeat; each row
    counts. Components without variance are left out, so one vector alone, or an
    empty table, gives an empty result. Other columns are not read. Sums of a
    dimension must fit a long.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    d = vectors.agg(F.max(F.size(F.col(f"`{vector_col}`")))).first()[0] or 0
    if d < 1:
        return spark.createDataFrame([], schema)
    held = stage(rows.where(F.size("vector") == d).mapInArrow(_on_grid(d), f"vec_id {id_type}, x binary"), "vectors")

    per_block = max(1, BLOCK_BYTES // (8 * d), held.count() // MOST_BLOCKS)
    blocks = stage(held.select("x").distinct().mapInArrow(_blocks(per_block), "part long, place long, xs array<binary>"), "vector_blocks")
    n_blocks, most = blocks.agg(F.count("*"), F.coalesce(F.max("place"), F.lit(0)) + 1).first()
    totals = _by_place(blocks.mapInArrow(_sums(d), "at long, total long").withColumn("at", F.col("at") + 1), d + 1, np.int64)
    n, sums = int(totals[0]), totals[1:]
    if n < 2:
        return spark.createDataFrame([], schema)

    # Numbers of blocks: tasks have at most ``most`` blocks each.
    numbered = blocks.select((F.col("part") * most + F.col("place")).alias("block"), "xs")

    def centred(row):
        x = _opened(row["xs"], d)
        return (int(row["block"]), 0), DenseMatrix(len(x), d, ((n * x - sums) / n).ravel(), True)

    matrix = BlockMatrix(numbered.rdd.map(centred), per_block, d)
    scatter = _multiply(matrix.transpose(), matrix, n_blocks).toLocalMatrix().toArray()
    values, axes = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    order = [c for c in np.argsort(values)[::-1] if values[c] > values.max() * d * NOISE][:components]
    k = len(order)
    if not k:
        return spark.createDataFrame([], schema)
    scale = axes[:, order] / np.sqrt(values[order])
    whitening = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, scale.ravel(order="F")))], 1), d, k)
    projected = matrix.multiply(whitening).blocks.map(lambda b: (int(b[0][0]), bytearray(b[1].toArray().astype("<f8").tobytes())))
    found = spark.createDataFrame(projected, "at long, whitened binary")
    spread = numbered.join(found, F.col("block") == F.col("at")).select("xs", "whitened")
    known = stage(spread.mapInArrow(_spread(d, n, sums), "x binary, deviation long, whitened array<double>"), "projections")

    centre = np.array([known.agg(*(F.avg(F.col("whitened")[c]) for c in range(k))).first()]).reshape(k)
    covariance = _by_place(known.mapInArrow(_products(k, centre), "at long, total double"), k * k, np.float64) / n
    error = float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())
    shares = F.array(*(F.lit(float(values[c] / values.sum())) for c in order))
    return (
        held.join(known, "x")
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("place")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
