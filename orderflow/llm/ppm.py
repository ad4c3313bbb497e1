"""Language-model scoring by prediction by partial matching.

The text is scored as its words (A-Z lower-cased), parted by one space, and
one end. The model is a byte-context trie of ``max_order`` levels: a byte that
follows its context with count ``c`` has probability ``c / (n + q)``, where
``n`` counts what followed the context and ``q`` how many different bytes did;
the escape to the context one byte shorter has ``q / (n + q)``. Bytes that the
longer context knows are excluded from the shorter one's counts, and below the
empty context the bytes left over are equally likely.

The trie is a table (:func:`train_trie`), counted over all training texts and
as large as they make it; it is never collected or broadcast. Texts are dealt
into blocks of about ``block_bytes``, and a block needs the values of its own
distinct contexts and words only. These go to a superblock of ``RANGE`` blocks
in ``SHARDS`` parts, packed and sorted; there they are merged, so that joins
see each of them once for each superblock, and the values come back the same
way. Every group is of a bounded number of blocks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import mix64, slices, stage, words

MAX_ORDER = 5
BLOCK_BYTES = 16 << 20
RANGE = SHARDS = 64
PACK_BYTES = 24 << 20
CHUNK = 1 << 19
END = b"\n"  # no word holds it
ALPHABET = 256


def _plain(data: pa.ChunkedArray) -> list[bytes]:
    """Each text as its words, parted by one space."""
    return [b" ".join(words(d)) for d in data.to_pylist()]


def _positions(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Context and byte of every scored place as one number (the context's
    ``order`` bytes, the nearest last, then the byte), and its text's index.
    Before its first byte a text has ``order`` ends."""
    pad = END * order
    lengths = np.array([len(t) + order + 1 for t in texts], np.int64)
    flat = np.frombuffer(pad + (END + pad).join(texts) + END, np.uint8)
    starts = np.cumsum(lengths) - lengths
    for low in range(0, len(flat), CHUNK):
        high = min(low + CHUNK, len(flat))
        first = max(low, order)
        if first >= high:
            continue
        gram = np.zeros(high - first, np.int64)
        for back in range(order, -1, -1):
            gram = (gram << 8) | flat[first - back : high - back]
        place = np.arange(first, high)
        text = np.searchsorted(starts, place, "right") - 1
        scored = place - starts[text] >= order
        yield gram[scored], text[scored]


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as source:
        return source.read_all()


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to packed rows, one for each block met in ``PACK_BYTES`` of texts."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        block = table.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        block = block[order]
        first = _runs(block)
        table = table.drop_columns("block").take(order)
        stops = [*first[1:], len(block)]
        blobs = [_packed(table.slice(a, z - a).combine_chunks()) for a, z in zip(first, stops, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array(blobs, pa.binary())], names=["block", "texts"])

    for batch in slices(batches, "data", PACK_BYTES):
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _texts(table: pa.Table) -> pa.Table:
    return pa.concat_tables(map(_unpacked, table.column("texts").to_pylist()))


def _block_counts(order: int):
    """Distinct grams and words of one block with their training counts,
    sorted and packed by shard."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = _texts(table)
        texts = _plain(rows.column("data"))
        train = np.asarray(rows.column("train").to_numpy(zero_copy_only=False), bool)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for gram, text in _positions(texts, order):
            both = np.sort((gram << 1) | train[text])
            gram = both >> 1
            first = _runs(gram)
            parts.append((gram[first], np.add.reduceat(both & 1, first) if len(first) else gram))
        gram, count = _merged(parts)
        seen: Counter[bytes] = Counter()
        known = set()
        for t, own in zip(texts, train, strict=True):
            (seen if own else known).update(t.split())
        by_shard: list[list[bytes]] = [[] for _ in range(SHARDS)]
        for w in {*seen, *known}:
            by_shard[zlib.crc32(w) % SHARDS].append(w)
        # The low bits of a gram are its last byte: mixed, shards are even.
        of = (mix64(gram.view(np.uint64)) % np.uint64(SHARDS)).astype(np.int64)
        order_ = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order_], np.arange(SHARDS + 1))
        pa.default_memory_pool().release_unused()
        grams, names = [], []
        for shard in range(SHARDS):
            own = order_[cuts[shard] : cuts[shard + 1]]
            grams.append(_packed(pa.table({"key": gram[own], "n": count[own]})))
            held = sorted(by_shard[shard])
            names.append(_packed(pa.table({"key": pa.array(held, pa.binary()), "n": pa.array([seen[w] for w in held], pa.int64())})))
        return pa.table(
            {
                "block": pa.array(np.full(SHARDS, block, np.int32)),
                "super": pa.array(np.full(SHARDS, block // RANGE, np.int32)),
                "shard": pa.array(np.arange(SHARDS, dtype=np.int32)),
                "grams": pa.array(grams, pa.binary()),
                "words": pa.array(names, pa.binary()),
            }
        )

    return run


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all parts and their summed counts."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = _runs(key)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _super_counts(table: pa.Table) -> pa.Table:
    """The counts of one shard over all blocks of a superblock."""
    parts = [(t.column("key").to_numpy(), t.column("n").to_numpy()) for t in map(_unpacked, table.column("grams").to_pylist())]
    gram, count = _merged(parts)
    words_ = pa.concat_tables(map(_unpacked, table.column("words").to_pylist())).group_by("key").aggregate([("n", "sum")])
    n, m = len(gram), words_.num_rows
    same = {c: pa.array(np.full(n + m, table.column(c)[0].as_py(), np.int32)) for c in ("super", "shard")}
    return pa.table(
        same
        | {
            "gram": pa.concat_arrays([pa.array(gram), pa.nulls(m, pa.int64())]),
            "word": pa.concat_arrays([pa.nulls(n, pa.binary()), words_.column("key").combine_chunks()]),
            "n": pa.concat_arrays([pa.array(count), words_.column("n_sum").combine_chunks()]),
        }
    )


def _block_values(counts: pa.Table, values: pa.Table) -> pa.Table:
    """For each block of a superblock's shard its keys with their values."""
    is_gram = values.column("gram").is_valid()
    held = values.filter(is_gram)
    gram, value = held.column("gram").to_numpy(), held.column("value").to_numpy()
    order = np.argsort(gram)
    gram, value = gram[order], value[order]
    rest = values.filter(pc.invert(is_gram))
    of_word = dict(zip(rest.column("word").to_pylist(), rest.column("value").to_pylist(), strict=True))
    grams, names = [], []
    for blob_g, blob_w in zip(counts.column("grams").to_pylist(), counts.column("words").to_pylist(), strict=True):
        key = _unpacked(blob_g).column("key").to_numpy()
        grams.append(_packed(pa.table({"key": key, "value": value[np.searchsorted(gram, key)]})))
        own = _unpacked(blob_w).column("key")
        names.append(_packed(pa.table({"key": own, "value": pa.array([int(of_word[w]) for w in own.to_pylist()], pa.int64())})))
    return pa.table({"block": counts.column("block"), "grams": pa.array(grams, pa.binary()), "words": pa.array(names, pa.binary())})


def _mask(level: int) -> int:
    """The last ``level`` bytes of the context and the byte."""
    return (1 << (8 * (level + 1))) - 1


def train_trie(grams: DataFrame, max_order: int = MAX_ORDER) -> list[DataFrame]:
    """Levels of the trie from ``(gram, n)`` training counts: ``level[k]`` has
    ``(gram, n)`` of the ``k``-byte contexts, ``ctx`` and the context's totals
    ``total`` and ``kinds``, and ``below``: the counts that its bytes have one
    level down."""
    levels = []
    counts = grams.where("n > 0").groupBy("gram").agg(F.sum("n").alias("n"))
    for k in range(max_order, -1, -1):
        if k < max_order:
            counts = levels[-1].groupBy(F.col("gram").bitwiseAND(_mask(k)).alias("gram")).agg(F.sum("n").alias("n"))
        levels.append(stage(counts, f"level{k}"))
    return levels[::-1]


def _contexts(levels: list[DataFrame]) -> list[DataFrame]:
    """Totals of every context, by level: ``ctx, total, kinds, below``."""
    out = []
    for k, level in enumerate(levels):
        rows = level.select("gram", "n", F.shiftright("gram", 8).alias("ctx"))
        if k:
            lower = levels[k - 1].select(F.col("gram").alias("low"), F.col("n").alias("m"))
            if k < 3:  # at most 65,536 grams
                lower = F.broadcast(lower)
            rows = rows.join(lower, F.col("gram").bitwiseAND(_mask(k - 1)) == F.col("low"))
        else:
            rows = rows.withColumn("m", F.lit(0).cast("long"))
        out.append(rows.groupBy("ctx").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("below")))
    return out


def code_lengths(asked: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``(gram, logp)``: log10 probability of the byte after its context, for
    every distinct ``gram`` asked."""
    top = len(levels) - 1
    contexts = _contexts(levels)
    # From the longest context on: what is decided, and what has escaped so far.
    state = asked.select("gram", F.lit(0.0).alias("logp"), F.lit(False).alias("found"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("kinds_gone"))
    for k in range(top, -1, -1):
        key = F.col("gram").bitwiseAND(_mask(k))
        node = contexts[k].select(F.col("ctx").alias("at"), "total", "kinds", "below")
        leaf = levels[k].select(F.col("gram").alias("leaf"), F.col("n").alias("c"))
        if k < 2:  # at most 256 contexts and 65,536 grams: a few keys for all rows
            node, leaf = F.broadcast(node), F.broadcast(leaf)
        state = state.join(node, F.shiftright(key, 8) == F.col("at"), "left").join(leaf, key == F.col("leaf"), "left")
        known, left = F.col("total").isNotNull(), F.col("kinds") - F.col("kinds_gone")
        mass = F.col("total") - F.col("gone") + left
        step = (
            F.when(F.col("found") | ~known | (mass == 0), 0.0)
            .when(F.col("c").isNotNull(), F.log10(F.col("c") / mass))
            .otherwise(F.log10(left / mass))
        )
        state = state.select(
            "gram",
            (F.col("logp") + step).alias("logp"),
            (F.col("found") | F.col("c").isNotNull()).alias("found"),
            F.when(known, F.col("below")).otherwise(F.lit(0)).alias("gone"),
            F.when(known, F.col("kinds")).otherwise(F.lit(0)).alias("kinds_gone"),
        )
    rest = -F.log10(F.lit(float(ALPHABET)) - F.col("kinds_gone"))
    return state.select("gram", F.when(F.col("found"), F.col("logp")).otherwise(F.col("logp") + rest).alias("logp"))


def _score_block(order: int, n_train: int, n_kinds: int, end_count: int):
    floor = math.log10(n_train + n_kinds + 1)

    def run(dealt: pa.Table, asked: pa.Table) -> pa.Table:
        texts = _texts(dealt)
        plain = _plain(texts.column("data"))
        parts = pa.concat_tables(map(_unpacked, asked.column("grams").to_pylist()))
        gram, logp = parts.column("key").to_numpy(), parts.column("value").to_numpy()
        order_ = np.argsort(gram)
        gram, logp = gram[order_], logp[order_]
        score = np.zeros(len(plain))
        for g, text in _positions(plain, order):
            # One sort brings equal grams together: each is looked up once.
            if not len(g):
                continue
            low = int(text[0])
            bits = int(text[-1] - low).bit_length()
            if 8 * (order + 1) + bits > 63:
                score += np.bincount(text, logp[np.searchsorted(gram, g)], len(plain))
                continue
            both = np.sort((g << bits) | (text - low))
            g, text = both >> bits, (both & ((1 << bits) - 1)) + low
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            value = np.repeat(logp[np.searchsorted(gram, g[first])], np.diff(np.append(first, len(g))))
            score += np.bincount(text, value, len(plain))
        del parts, gram, logp, order_
        gain: dict[bytes, float] = {}  # log10 of the count and one: above 0 for known words
        for blob in asked.column("words").to_pylist():
            own = _unpacked(blob)
            gain.update(zip(own.column("key").to_pylist(), np.log10(own.column("value").to_numpy() + 1.0).tolist(), strict=True))
        end_gain = math.log10(end_count + 1)
        n, known, base = [], [], []
        for t in plain:
            gains = [*map(gain.__getitem__, t.split()), end_gain]
            n.append(len(gains))
            known.append(len(gains) - gains.count(0.0))
            base.append(math.fsum(gains) - n[-1] * floor)
        pa.default_memory_pool().release_unused()
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": pc.invert(texts.column("train")),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([n_train] * len(n), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score),
                "n_bytes": pa.array([len(t) + 1 for t in plain], pa.int64()),
            }
        )

    return run


def score_documents(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_order: int = MAX_ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, n_bytes``. The model learns from the rows
    where ``train`` holds (a null counts as true); ``score`` is its log10
    probability of the whole text, ``base_score`` that of a unigram model of
    words, ``n_bytes`` the scored bytes.

    A null text is empty: one end. Ids may be null or repeat; each row counts.
    Without a training row every byte is one of 256 and every word unknown. An
    empty table gives an empty result. ``max_order`` is at most 6.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    data = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), data.alias("data"), F.coalesce(train, F.lit(True)).alias("train"))
    size, n_rows, n_texts = rows.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.count("*"), F.count_if("train")).first()
    n_blocks = max(1, math.ceil(size / block_bytes), math.ceil(n_rows / (block_bytes >> 4)))
    block = F.pmod(F.xxhash64("doc_id", "data"), F.lit(n_blocks)).cast("int")
    dealt = rows.withColumn("block", block).mapInArrow(_deal, "block int, texts binary")
    counts = stage(
        dealt.groupBy("block").applyInArrow(_block_counts(max_order), "block int, super int, shard int, grams binary, words binary"), "block_counts"
    )
    merged = stage(counts.groupBy("super", "shard").applyInArrow(_super_counts, "super int, shard int, gram bigint, word binary, n bigint"), "super_counts")
    grams, names = merged.where("gram is not null"), merged.where("gram is null")
    levels = train_trie(grams.select("gram", "n"), max_order)
    codes = code_lengths(grams.select("gram").distinct(), levels)
    known = stage(names.groupBy(F.col("word").alias("w")).agg(F.sum("n").alias("total")), "words")
    n_words, n_kinds = known.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count_if(F.col("total") > 0)).first()
    of_grams = grams.join(codes, "gram").select("super", "shard", "gram", "word", F.col("logp").alias("value"))
    of_words = names.join(known, F.col("word") == F.col("w")).select("super", "shard", "gram", "word", F.col("total").cast("double").alias("value"))
    values = of_grams.unionByName(of_words)
    back = counts.groupBy("super", "shard").cogroup(values.groupBy("super", "shard")).applyInArrow(_block_values, "block int, grams binary, words binary")
    scored = _score_block(max_order, n_words + n_texts, n_kinds + (n_texts > 0), n_texts)
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        scored,
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint",
    )
