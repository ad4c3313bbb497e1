"""Benchmark decontamination by the q-gram lemma.

An item of length ``m`` that occurs in a text with at most ``k`` edits shares
at least ``m + 1 - q - k*q`` q-grams with it, all on diagonals that differ by
at most ``k``. The shared q-grams of a text and an item are counted in
overlapping bands of diagonals (width ``2k + 2``, one every ``k + 1``, so that
each set of ``k + 1`` neighbouring diagonals lies whole in one band); bands
that meet the bound are verified by banded alignment of the item with the
region, both lower-cased with white space runs made one space. Items shorter
than a q-gram are found exactly.

The items are a stated query set: Spark folds them and writes them in blocks of
about ``block_bytes`` (one item at least), which are sent to the tasks one after
the other; the documents are never shuffled for the comparison.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import ids_and_bytes, in_blocks, map_whole_rows, slices, stage

Q = 8  # at most 8: one q-gram fills one 64-bit word
ERROR_RATE = 0.08
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 19
_TABLE_BITS = 20
#: Bytes of a text whose hits are counted at a time, and the hits that are
#: listed one by one (beyond it bands look up the places of an item).
WINDOW_BYTES, MOST_HITS = 1 << 17, 1 << 20
#: Bands that are aligned together.
ALIGNED = 512


@dataclass(frozen=True)
class ItemBlock:
    """Prepared items: the ids of each, least first, texts, edit budgets, the shared q-grams these ask for,
    and the sorted q-grams with the item and the place of each."""

    ids: tuple[tuple, ...]
    texts: tuple[bytes, ...]
    budgets: np.ndarray
    needs: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray


def fold(data: bytes | None) -> bytes:
    """Lower-case, words parted by one space."""
    return b" ".join(data.decode("utf-8", "replace").lower().encode().split()) if data else b""


def edit_budget(length: int, q: int = Q, error_rate: float = ERROR_RATE) -> int:
    """Edits allowed in an item: its share, but so few that the lemma still
    asks for at least one common q-gram; -1 for items shorter than ``q``."""
    return min(int(error_rate * length), (length - q) // q) if length >= q else -1


def qgrams(text: bytes, q: int = Q) -> np.ndarray:
    """All q-grams as 64-bit words."""
    n = len(text) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    a = np.frombuffer(text, np.uint8)
    if q == 8:
        out = np.empty(n, np.uint64)
        for i in range(min(8, n)):
            own = out[i::8]
            own[:] = np.frombuffer(text, np.uint64, len(own), i)
        return out
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out = (out << np.uint64(8)) | a[i : n + i]
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


def item_blocks(items: list[tuple[object, bytes | None]], q: int, error_rate: float, block_bytes: int) -> Iterator[ItemBlock]:
    """Items with one folded text are one, with all their ids; empty ones are
    left out."""
    folded: dict[bytes, dict] = {}
    for item_id, data in sorted(items, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0)):
        text = fold(data)
        if text:
            folded.setdefault(text, {})[item_id] = None
    block: list[tuple[tuple, bytes]] = []
    held = 0
    for text, ids in folded.items():
        if block and held + len(text) > block_bytes:
            yield _block(block, q, error_rate)
            block, held = [], 0
        block.append((tuple(ids), text))
        held += len(text)
    if block:
        yield _block(block, q, error_rate)


def _block(items: list[tuple[tuple, bytes]], q: int, error_rate: float) -> ItemBlock:
    per_item = [qgrams(t, q) for _, t in items]
    grams = np.concatenate(per_item)
    item = np.repeat(np.arange(len(items), dtype=np.int64), [len(g) for g in per_item])
    place = np.concatenate([np.arange(len(g), dtype=np.int64) for g in per_item])
    order = np.argsort(grams, kind="stable")
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[_slot(grams)] = True
    lengths = np.array([len(t) for _, t in items])
    budgets = np.array([edit_budget(n, q, error_rate) for n in lengths.tolist()])
    needs = lengths + 1 - q - budgets * q
    return ItemBlock(tuple(i for i, _ in items), tuple(t for _, t in items), budgets, needs, grams[order], item[order], place[order], table)


def banded_alignments(item: bytes, text: bytes, lows: np.ndarray, width: int, budget: int) -> np.ndarray:
    """``(edits, start, end)`` by band: the alignment of the whole item with a
    substring of the text that takes the least edits and stays on the diagonals
    ``low .. low + width - 1`` (text place minus item place), of equal ones
    that with the last start; ``budget + 1`` edits if it takes more."""
    out = np.zeros((len(lows), 3), np.int64)
    out[:, 0] = budget + 1
    size = len(text) + 1
    far = (budget + 2) * size - 1
    pad = len(item) + width + 1
    # Only what the bands touch is widened to 16 bits.
    first, last = max(0, int(lows.min())), max(0, min(len(text), int(lows.max()) + width + len(item)))
    own = np.frombuffer(text, np.uint8)[first:last].astype(np.int16)
    padded = np.concatenate((np.full(pad, -1, np.int16), own, np.full(pad, -1, np.int16)))
    steps = np.arange(width)
    open_, low = np.arange(len(lows)), lows.astype(np.int64)
    # Cell d of row i: item[:i] against a substring that ends at i + low + d:
    # its edits times size, plus how far its start is from the text's end.
    ends = low[:, None] + steps
    row = np.where((ends >= 0) & (ends <= len(text)), len(text) - ends, far)
    for i, c in enumerate(item):
        at = np.clip(low + (i - first + pad), 0, len(padded) - width)
        change = row + size * (padded[at[:, None] + steps] != c)
        best = change
        np.minimum(change[:, :-1], row[:, 1:] + size, out=best[:, :-1])
        ends = low[:, None] + (i + 1 + steps)
        best[(ends < 0) | (ends > len(text))] = far
        # Insertions run along the row: a running minimum of best - d.
        row = np.minimum(np.minimum.accumulate(best - size * steps, axis=1) + size * steps, far)
        if i % 8 == 7:
            going = row.min(axis=1) // size <= budget
            if not going.all():
                row, low, open_ = row[going], low[going], open_[going]
                if not len(low):
                    return out
    d = row.argmin(axis=1)
    edits, back = np.divmod(row[np.arange(len(row)), d], size)
    good = edits <= budget
    out[open_[good]] = np.stack((edits, len(text) - back, low + len(item) + d), axis=1)[good]
    return out


def _listed_bands(at: np.ndarray, lo: np.ndarray, n: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """Items and bands that share enough q-grams; every hit is listed."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    need = np.maximum(block.needs, 1)
    index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    item = block.item[index]
    enough = np.bincount(item, minlength=len(need))[item] >= need[item]  # over all bands
    if not enough.any():
        return none
    item, place, where = item[enough], block.place[index[enough]], np.repeat(at, n)[enough]
    stride = block.budgets[item] + 1
    band = np.floor_divide(where - place, stride)  # a diagonal may be negative
    # Every hit counts in the two bands that overlap on its diagonal; one sort
    # of (item, band, place) in a number brings a band's places together.
    least, most = int(band.min()) - 1, int(place.max()) + 1
    bands = int(band.max()) - least + 1
    both = np.sort(np.concatenate([((item * bands) + (band - less - least)) * most + place for less in (0, 1)]))
    # A q-gram of the item counts once in a band, however often it hits.
    both = both[np.concatenate(([True], both[1:] != both[:-1]))]
    group = both // most
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    shared = np.diff(np.append(first, len(group)))
    item2, band2 = np.divmod(group[first], bands)
    found = shared >= need[item2]
    return item2[found], band2[found] + least


def _looked_up_bands(at: np.ndarray, grams: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts that repeat themselves: each band looks up, for each
    place of the item, whether its q-gram hits within the band."""
    kinds, of, times = np.unique(grams, return_inverse=True, return_counts=True)
    span = int(at.max()) + 2
    key = np.sort(of * span + at)
    spot = np.minimum(np.searchsorted(kinds, block.grams), len(kinds) - 1)
    hit = kinds[spot] == block.grams
    held = np.bincount(block.item[hit], times[spot[hit]], len(block.needs))
    items, bands = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in np.flatnonzero(held >= np.maximum(block.needs, 1)).tolist():
        own = hit & (block.item == i)
        kind, place = spot[own], block.place[own]
        stride = int(block.budgets[i]) + 1
        every = np.arange((int(at.min()) - int(place.max())) // stride - 1, int(at.max()) // stride + 1)
        for some in np.array_split(every, max(1, len(every) * len(place) // MOST_HITS + 1)):
            start = place + some[:, None] * stride
            spots = np.searchsorted(key, kind * span + np.clip(start, 0, span - 1))
            found = key[np.minimum(spots, len(key) - 1)]
            within = (spots < len(key)) & (found < kind * span + np.clip(start + 2 * stride, 0, span - 1))
            good = some[within.sum(axis=1) >= max(int(block.needs[i]), 1)]
            items.append(np.full(len(good), i))
            bands.append(good)
    return np.concatenate(items), np.concatenate(bands)


def _bands(length: int, at: np.ndarray, grams: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """Items and bands that share enough q-grams with the text, window by
    window. A window counts the bands that begin in it and reads on as far as
    a band goes."""
    lo = np.searchsorted(block.grams, grams, "left")
    n = np.searchsorted(block.grams, grams, "right") - lo
    reach = max(len(t) + 2 * (k + 1) for t, k in zip(block.texts, block.budgets.tolist(), strict=True))
    step = max(WINDOW_BYTES, reach)
    items, bands = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin in range(0, max(length, 1), step):
        last = begin + step >= length
        own = slice(np.searchsorted(at, begin), len(at) if last else np.searchsorted(at, begin + step + reach))
        if not n[own].any():
            continue
        if n[own].sum() <= MOST_HITS:
            item, band = _listed_bands(at[own], lo[own], n[own], block)
        else:
            item, band = _looked_up_bands(at[own], grams[own], block)
        low = band * (block.budgets[item] + 1)
        here = ((low >= begin) | (begin == 0)) & ((low < begin + step) | last)
        items.append(item[here])
        bands.append(band[here])
    return np.concatenate(items), np.concatenate(bands)


def matches(text: bytes, block: ItemBlock, q: int = Q, positions: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int, int]]:
    """``(item, start, end, edits)`` of every item found in the folded text,
    one for each verified band, start and end of its alignment; the best of
    those that overlap."""
    if positions is None:
        grams = qgrams(text, q)
        at = np.flatnonzero(block.table[_slot(grams)])
        grams = grams[at]
        hit = block.grams[np.minimum(np.searchsorted(block.grams, grams), len(block.grams) - 1)] == grams if len(block.grams) else np.zeros(len(grams), bool)
        at, grams = at[hit], grams[hit]
    else:
        at, grams = positions
    if not len(at):
        return []
    item, band = _bands(len(text), at, grams, block)
    out = []
    for i in np.unique(item).tolist():
        k = int(block.budgets[i])
        lows = np.sort(band[item == i]) * (k + 1)
        aligned = np.concatenate([banded_alignments(block.texts[i], text, some, 2 * (k + 1), k) for some in np.array_split(lows, -(-len(lows) // ALIGNED))])
        # The best first; of those that overlap one.
        regions = sorted({tuple(r) for r in aligned.tolist() if r[0] <= k})
        starts: list[int] = []
        ends: list[int] = []
        for edits, start, end in regions:
            at_ = bisect_left(starts, end)
            if at_ == 0 or ends[at_ - 1] <= start:
                starts.insert(at_, start)
                ends.insert(at_, end)
                out.append((i, start, end, edits))
    return sorted(out)


def _matches_of_each(data: list[bytes | None], block: ItemBlock, q: int) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
    """The place of every text with :func:`matches` or short items, and these."""
    texts = [fold(d) for d in data]
    short: dict[int, list[tuple[int, int, int, int]]] = {}
    for i in np.flatnonzero(block.budgets < 0).tolist():
        item = block.texts[i]
        for t, text in enumerate(texts):
            at = text.find(item)
            while at >= 0:
                short.setdefault(t, []).append((i, at, at + len(item), 0))
                at = text.find(item, at + len(item))
    flat = b"\n".join(texts)  # a folded text holds no line break, nor does an item
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    grams = qgrams(flat, q)
    at = np.flatnonzero(block.table[_slot(grams)])
    kept = grams[at]
    # The table passes more than the grams of the block: look them up.
    spot = np.minimum(np.searchsorted(block.grams, kept), len(block.grams) - 1)
    true = block.grams[spot] == kept
    at, kept = at[true], kept[true]
    ends = np.searchsorted(at, starts)
    for t in sorted({*np.flatnonzero(ends[1:] > ends[:-1]).tolist(), *short}):
        own = slice(ends[t], ends[t + 1])
        if found := matches(texts[t], block, q, (at[own] - starts[t], kept[own])) + short.get(t, []):
            yield t, found


def _search(block: ItemBlock, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", SLICE_BYTES):
            found = [(t, block.ids[i][0], start, end, edits) for t, rows in _matches_of_each(batch.column("data").to_pylist(), block, q) for i, start, end, edits in rows]
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(columns[0], pa.int64())), *(pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True))],
                names=["doc_id", "item", "region_start", "region_end", "edits"],
            )

    return run


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "data", SLICE_BYTES):
        texts = [fold(d) for d in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(texts, pa.binary())], names=["item_id", "text"])


class _Items:
    """The benchmark folded, each text once, in numbered blocks: written by
    Spark, read one block at a time."""

    def __init__(self, benchmark: DataFrame, item_col: str, item_text_col: str, q: int, error_rate: float, block_bytes: int) -> None:
        self.id_type = "string" if benchmark.schema[item_col].dataType.simpleString() == "string" else "bigint"
        self.q, self.error_rate = q, error_rate
        items = benchmark.select(F.col(f"`{item_col}`").cast(self.id_type).alias("item_id"), F.col(f"`{item_text_col}`").cast("string").cast("binary").alias("data"))
        self.folded = items.mapInArrow(_folded, f"item_id {self.id_type}, text binary").where(F.octet_length("text") > 0)
        once = self.folded.groupBy("text").agg(F.min("item_id").alias("item_id"))
        self.cut = in_blocks(once, F.octet_length("text"), block_bytes)
        self.numbers = sorted(r.block for r in self.cut.select("block").distinct().collect())

    def blocks(self) -> Iterator[ItemBlock]:
        for number in self.numbers:
            rows = self.cut.where(F.col("block") == number).select("item", "text").orderBy("item").toLocalIterator()
            yield _block([((r.item,), bytes(r.text)) for r in rows], self.q, self.error_rate)

    def ids(self, every: bool) -> DataFrame:
        """``item, item_id``: the least id of each text, or all."""
        if not every:
            return self.cut.select("item", "item_id")
        return self.folded.join(self.cut.select("text", "item"), "text").select("item", "item_id").distinct()


def contaminated_regions(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
    all_ids: bool = False,
) -> DataFrame:
    """One row per document, item and region (bytes of the folded text) that
    holds the item within its edit budget: ``doc_id, item_id, region_start,
    region_end, edits``.

    Null or empty texts hold nothing; items of fewer than ``q`` bytes are
    found exactly; items that fold to one text count under the smallest id, or
    with ``all_ids`` under each; of occurrences that overlap the best counts; an
    empty benchmark or document table gives no rows. The driver holds a block
    of items at a time; every block is a scan of ``docs``, and of several blocks
    each one's regions are written before the next.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    items = _Items(benchmark, item_col, item_text_col, q, error_rate, block_bytes)
    rows = ids_and_bytes(docs, id_col, text_col).where("data is not null")
    schema = f"doc_id {id_type}, item bigint, region_start bigint, region_end bigint, edits int"
    parts = []
    for block in items.blocks():
        part = rows.mapInArrow(_search(block, q), schema)
        parts.append(part if len(items.numbers) == 1 else stage(part, "regions"))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema.replace("item bigint", f"item_id {items.id_type}"))
    found = reduce(DataFrame.unionByName, parts)
    return found.join(items.ids(all_ids), "item").select("doc_id", "item_id", "region_start", "region_end", "edits")


def contaminated_ids(regions: DataFrame) -> DataFrame:
    """The distinct ids of documents with at least one region."""
    return regions.where("doc_id is not null").select("doc_id").distinct()


def keep_uncontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` in which :func:`contaminated_regions` finds
    nothing, all columns. Each row is judged by its own text, so ids may be
    null or repeat."""
    items = _Items(benchmark, item_col, item_text_col, q, error_rate, block_bytes)
    for k, block in enumerate(items.blocks()):
        docs = map_whole_rows(docs, text_col, _clean_rows(block, q), limit=SLICE_BYTES)
        if k + 1 < len(items.numbers):
            docs = stage(docs, "uncontaminated")
    return docs


def _clean_rows(block: ItemBlock, q: int):
    def run(parts):
        for batch, data in parts:
            clean = np.ones(len(data), bool)
            clean[[t for t, _ in _matches_of_each(data, block, q)]] = False
            yield batch.filter(pa.array(clean)), []

    return run
