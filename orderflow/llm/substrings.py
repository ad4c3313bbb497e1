"""Repeated passages across documents, found behind a count-min sketch.

A window is a run of ``WINDOW`` words. Texts are dealt once into pieces of
bounded bytes and written, bucketed by piece, so that no later step moves a
text again. Three passes read them:

1. Each piece counts its distinct windows in a count-min sketch of two rows.
   Its counters go to shards, which merge the counters of all pieces and
   answer each piece which of its cells hold a count of two or more.
2. A window whose two counters both say so (an overestimate: no repeated
   window is missed) goes, as a 128-bit hash with the least id of its piece,
   to the exact grouping, which answers whether a smaller id starts it.
3. Each piece takes the words of such windows out.

The sketch's width follows the number of windows, so its error does not grow
with the corpus. Pieces send each window once, so a passage of a third of all
documents costs one entry a piece.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import mix64, slices
from orderflow.session import new_work_dir

#: Words in a window.
WINDOW = 13
#: Bytes of text in a piece: bounds a task's memory.
PIECE_BYTES = 12 << 20
#: Bytes of text split into words at a time.
SPLIT_BYTES = 2 << 20
#: Cells of a sketch row for each window of the corpus (rounded up to a power of two).
CELLS_PER_WINDOW = 8
#: Windows whose counters meet in one task, and the least number of shards.
SHARD_WINDOWS = 1 << 21
LEAST_SHARDS = 16
#: A piece has at least so many cells for a shard on average, or shards grow.
LEAST_CELLS = 64
#: The catalog's bound on buckets.
MOST_BUCKETS = 100_000
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the pieces and the rows of each, and count words."""
    piece, held, seq = TaskContext.get().partitionId() << 32, 0, 0
    for batch in slices(batches, "data", SPLIT_BYTES):
        if held and held + batch.nbytes > PIECE_BYTES:
            piece, held, seq = piece + 1, 0, 0
        held += batch.nbytes
        n = batch.num_rows
        words = [len(t.split()) if t else 0 for t in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, piece)), pa.array(np.arange(seq, seq + n)), *batch.columns, pa.array(words, pa.int64())],
            names=["piece", "seq", "doc_id", "data", "n_words"],
        )
        seq += n


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``piece, seq, doc_id, data, n_words`` of every row, written bucketed by
    piece into the checkpoint folder. Nothing stays in the catalog."""
    spark = docs.sparkSession
    data = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), data.alias("data"))
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.count("*")).first()
    buckets = min(MOST_BUCKETS, max(8, 4 * (size + 16 * n) // PIECE_BYTES))
    name = f"pieces_{uuid.uuid4().hex}"
    dealt = rows.mapInArrow(_deal, "piece long, seq long, doc_id long, data binary, n_words long")
    dealt.write.bucketBy(buckets, "piece").option("path", f"{new_work_dir(spark, 'pieces')}/pieces").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _lanes(texts: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of every word, in order."""
    parts, held, size = [np.empty((0, 2), np.uint64)], [], 0

    def flush() -> None:
        words = [w for t in held for w in t.split()]
        if words:
            codes, kinds = pd.factorize(np.array(words, dtype=object))
            digests = b"".join(map(xxhash.xxh3_128_digest, kinds))
            parts.append(np.frombuffer(digests, np.uint64).reshape(-1, 2)[codes])

    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SPLIT_BYTES:
            flush()
            held, size = [], 0
    flush()
    return np.concatenate(parts)


def _hashes(lanes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window that begins at ``starts``."""
    out, last = [], len(lanes) - WINDOW + 1
    for k, multiplier in enumerate(MULTIPLIERS):
        lane = np.ascontiguousarray(lanes[:, k])
        total = np.zeros(max(last, 0), np.uint64)
        for j in range(WINDOW):
            total *= multiplier
            total += lane[j : last + j]
        out.append(mix64(total[starts]))
    return out[0], out[1]


class _Piece:
    """The windows of one piece: ``start`` (its word) and ``doc`` (its row) of
    each, ``of`` its number among the distinct ones; ``high, low`` their
    hashes in ascending order, ``least`` and ``shared``: the least id, and
    whether there is another."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by("seq")
        self.ids = table.column("doc_id")
        self.texts: list[bytes] = table.column("data").to_pylist()
        self.n_words = table.column("n_words").to_numpy()
        known = np.asarray(self.ids.is_valid())
        ids = self.ids.fill_null(0).to_numpy()
        lanes = _lanes(self.texts)
        row = np.repeat(np.arange(len(ids), dtype=np.int32), self.n_words)
        start = np.flatnonzero((row[: len(row) - WINDOW + 1] == row[WINDOW - 1 :]) & known[row[WINDOW - 1 :]]) if len(row) >= WINDOW else np.empty(0, np.int64)
        high, low = _hashes(lanes, start)
        del lanes
        order = np.argsort(high)
        if np.any((high[order][1:] == high[order][:-1]) & (low[order][1:] != low[order][:-1])):
            order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(high), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(new)
        self.start, self.doc_of, self.doc = start, ids, row[start]
        self.of = np.empty(len(high), np.int32)
        self.of[order] = np.cumsum(new, dtype=np.int32) - 1
        own = ids[self.doc[order]]
        self.high, self.low = high[first], low[first]
        self.least = np.minimum.reduceat(own, first) if len(first) else own
        self.shared = (np.maximum.reduceat(own, first) if len(first) else own) > self.least

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct cells of a sketch row in ascending order, and which of
        them each distinct window has."""
        cell = (self.high, self.low)[row] >> np.uint64(64 - bits)
        if row:
            return np.unique(cell, return_inverse=True)
        new = np.ones(len(cell), bool)
        new[1:] = cell[1:] != cell[:-1]
        return cell[new], np.cumsum(new) - 1


def _packed(values: np.ndarray, universe: int) -> bytes:
    """Ascending distinct numbers below ``universe``: low bytes plain, what is
    above them in unary."""
    n = len(values)
    low = min((1, 2, 3, 4), key=lambda b: n * b + (n + (universe >> (8 * b))) / 8)
    lows = values.astype("<u4").view(np.uint8).reshape(n, 4)[:, :low]
    marks = np.zeros(n + (universe >> (8 * low)) + 1, bool)
    marks[(values >> np.uint64(8 * low)).astype(np.int64) + np.arange(n)] = True
    return bytes([low]) + n.to_bytes(4, "little") + lows.tobytes() + np.packbits(marks).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    low, n = blob[0], int.from_bytes(blob[1:5], "little")
    lows = np.zeros((n, 4), np.uint8)
    lows[:, :low] = np.frombuffer(blob, np.uint8, n * low, 5).reshape(n, low)
    marks = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, offset=5 + n * low)))[:n]
    return lows.view("<u4").reshape(n).astype(np.int64) + ((marks - np.arange(n)) << (8 * low))


def _cuts(values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Where the shards (by the top bits of ``bits``) begin in ``values``."""
    bounds = np.arange(1, shards, dtype=np.uint64) << np.uint64(bits - (shards.bit_length() - 1))
    return np.concatenate(([0], np.searchsorted(values, bounds), [len(values)]))


SKETCH = "piece long, line int, shard int, blob binary"
ANSWERS = pa.schema([("piece", pa.int64()), ("line", pa.int32()), ("shard", pa.int32()), ("blob", pa.binary())])


def _answers(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, ANSWERS, strict=True)], schema=ANSWERS)


def _sketch(bits: int, shards: int):
    """The counters of one piece, by sketch row (``line``) and shard. A piece
    counts a window once: a window of several of its documents needs no
    counter, as the piece itself knows that it is repeated."""

    def run(table: pa.Table) -> pa.Table:
        key, piece, universe, rows = table.column("piece")[0].as_py(), _Piece(table), (1 << bits) // shards, []
        for line in range(2):
            cells, _ = piece.cells(line, bits)
            cuts = _cuts(cells, bits, shards)
            for shard in np.flatnonzero(np.diff(cuts)).tolist():
                rows.append((key, line, shard, _packed(cells[cuts[shard] : cuts[shard + 1]] - np.uint64(shard * universe), universe)))
        return _answers(rows)

    return run


def _merge_counters(universe: int):
    """Sum the counters of a shard over all pieces (up to two) and answer
    each piece with a bit for each of its cells."""

    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(universe, np.uint8)
        blobs = table.column("blob").to_pylist()
        for blob in blobs:
            cells = _unpacked(blob)
            counts[cells] = np.minimum(counts[cells] + 1, 2)
        said = [np.packbits(counts[_unpacked(blob)] > 1).tobytes() for blob in blobs]
        return table.set_column(3, "blob", pa.array(said, pa.binary())).cast(ANSWERS)

    return run


def _flags(answers: pa.Table, sizes: dict[int, int]) -> np.ndarray:
    """The bits of all shards in order; ``sizes`` are those of the shards."""
    said = dict(zip(answers.column("shard").to_pylist(), answers.column("blob").to_pylist(), strict=True))
    parts = [np.unpackbits(np.frombuffer(said[s], np.uint8))[:n] for s, n in sizes.items()]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


def _sizes(values: np.ndarray, bits: int, shards: int) -> dict[int, int]:
    n = np.diff(_cuts(values, bits, shards))
    return {s: int(n[s]) for s in np.flatnonzero(n).tolist()}


def _line(table: pa.Table, line: int) -> pa.Table:
    return table.filter(pc.equal(table.column("line"), line))


def _candidates(bits: int, shards: int):
    """Windows estimated repeated, for the exact grouping (line 0), and which
    of the piece's distinct windows they are (line 1, to be passed on)."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _answers([])
        key, piece = table.column("piece")[0].as_py(), _Piece(table)
        repeated = np.ones(len(piece.high), bool)
        for line in range(2):
            cells, of = piece.cells(line, bits)
            repeated &= _flags(_line(answers, line), _sizes(cells, bits, shards))[of]
        repeated |= piece.shared
        rows = [(key, 1, int(key % shards), np.packbits(repeated).tobytes())]
        high, low, least = piece.high[repeated], piece.low[repeated], piece.least[repeated]
        cuts = _cuts(high, 64, shards)
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            ids = least[own]
            kind = "<u4" if ids.min() >= 0 and ids.max() < 1 << 32 else "<i8"
            blob = (len(ids)).to_bytes(4, "little") + high[own].tobytes() + low[own].tobytes() + ids.astype(kind).tobytes()
            rows.append((key, 0, shard, blob))
        return _answers(rows)

    return run


def _group_exactly(table: pa.Table) -> pa.Table:
    """Group the candidates of a shard by their hash; answer each piece with a
    bit for each: whether another piece has a smaller id for it."""
    asked, passed = _line(table, 0), _line(table, 1)
    high, low, least, sizes = [], [], [], []
    for blob in asked.column("blob").to_pylist():
        n = int.from_bytes(blob[:4], "little")
        high.append(np.frombuffer(blob, "<u8", n, 4))
        low.append(np.frombuffer(blob, "<u8", n, 4 + 8 * n))
        least.append(np.frombuffer(blob, "<u4" if len(blob) == 4 + 20 * n else "<i8", n, 4 + 16 * n).astype(np.int64))
        sizes.append(n)
    if not sizes:
        return passed.cast(ANSWERS)
    high, low, least = (np.concatenate(x) for x in (high, low, least))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    lowest = np.minimum.reduceat(least[order], np.flatnonzero(new))
    smaller = np.empty(len(high), bool)
    smaller[order] = lowest[np.cumsum(new) - 1] < least[order]
    said = [np.packbits(x).tobytes() for x in np.split(smaller, np.cumsum(sizes)[:-1])]
    return pa.concat_tables([asked.set_column(3, "blob", pa.array(said, pa.binary())).cast(ANSWERS), passed.cast(ANSWERS)])


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _keep(shards: int):
    """Take out the words of every window that a smaller id starts."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return KEPT.empty_table()
        piece = _Piece(table)
        marks = _line(answers, 1).column("blob")
        asked = np.unpackbits(np.frombuffer(marks[0].as_py(), np.uint8))[: len(piece.high)].astype(bool)
        elsewhere = np.zeros(len(piece.high), bool)
        elsewhere[asked] = _flags(_line(answers, 0), _sizes(piece.high[asked], 64, shards))
        goes = piece.start[elsewhere[piece.of] | (piece.doc_of[piece.doc] > piece.least[piece.of])]
        edges = np.zeros(int(piece.n_words.sum()) + 1, np.int32)
        edges[goes] += 1  # a window begins at a word once
        edges[goes + WINDOW] -= 1
        stays = np.cumsum(edges[:-1]) == 0
        ends = np.cumsum(piece.n_words)
        kept, removed = [], []
        for text, n, end in zip(piece.texts, piece.n_words.tolist(), ends.tolist(), strict=True):
            own = stays[end - n : end]
            gone = n - int(np.count_nonzero(own))
            removed.append(gone)
            kept.append(b" ".join(compress(text.split(), own.tolist()) if gone else text.split()))
        return pa.table([piece.ids, pa.array(piece.n_words), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], schema=KEPT)

    return run


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` (a long), ``n_words``, ``n_removed``
    and ``kept``, the words left over, joined by one space.

    Words are runs of characters other than space and ``\\x09-\\x0D``. A word
    goes if a window of 13 words that covers it also begins in a row with a
    smaller id; windows are judged on the input. Rows with the same id remove
    nothing from each other. A row without an id loses nothing and removes
    nothing. Null and short texts have no window. Other columns are not read.
    An empty table gives an empty result. Equal windows are told by 128 bits of
    hash. A document is held whole by one task.
    """
    texts = _dealt(docs, id_col, text_col)
    windows = F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0))
    total, pieces = texts.agg(F.coalesce(F.sum(windows), F.lit(0)), F.count_distinct("piece")).first()
    bits = max(24, (CELLS_PER_WINDOW * total - 1).bit_length())
    wanted = min(total // SHARD_WINDOWS, total // max(pieces, 1) // LEAST_CELLS)
    shards = max(LEAST_SHARDS, 1 << wanted.bit_length())
    dealt = texts.groupBy("piece")
    counters = dealt.applyInArrow(_sketch(bits, shards), SKETCH)
    merged = counters.groupBy("line", "shard").applyInArrow(_merge_counters((1 << bits) // shards), SKETCH)
    candidates = dealt.cogroup(merged.groupBy("piece")).applyInArrow(_candidates(bits, shards), SKETCH)
    grouped = candidates.groupBy("shard").applyInArrow(_group_exactly, SKETCH)
    return (
        dealt.cogroup(grouped.groupBy("piece"))
        .applyInArrow(_keep(shards), "doc_id long, n_words long, n_removed long, kept binary")
        .withColumn("kept", F.col("kept").cast("string"))
    )
