"""SentencePiece encoding and decoding by batched Viterbi.

The best segmentation of a text maximises the summed piece scores. A piece
never runs over the start of a word (a run of ``▁`` and what follows), so the
best path of a text is that of its words, and each distinct word is solved
once. Words advance together, the longest first, so that the first columns
are those that go on: for every start and piece length the 64-bit hashes of
all their substrings probe the sorted piece hashes, and vectorised maxima
store the backpointers. Characters without a piece are spelled in byte pieces,
as is a literal ``▁``, so decoding is exact.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField

from orderflow.llm.common import ids_and_bytes, map_whole_rows, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
LONG_WORD = 48
BATCH_CELLS = 1 << 16
#: Bytes of solved words and their ids that are kept between texts.
CACHE_BYTES = 24 << 20
#: Bytes of text split into words at a time: the words take many times that.
SLICE_BYTES = 1 << 19
_FILTER_BITS = 18
_FILTER_SHIFT = np.uint64(64 - _FILTER_BITS)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = regex.compile(r" *[^ ]+| +")
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # piece types of the model format


def read_model(data: bytes) -> list[tuple[str, float, int]]:
    """``(piece, score, type)`` by id from a serialised model: field 1 of the
    message repeats pieces, whose fields 1, 2, 3 are text, score and type."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value, at
            shift += 7

    def fields(at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        while at < end:
            key, at = varint(at)
            kind = key & 7
            if kind == 0:
                _, nxt = varint(at)
            elif kind == 2:
                size, at = varint(at)
                nxt = at + size
            else:
                nxt = at + (8 if kind == 1 else 4)
            yield key >> 3, kind, at, nxt
            at = nxt

    pieces = []
    for number, kind, start, end in fields(0, len(data)):
        if number == 1 and kind == 2:
            text, score, type_ = "", 0.0, NORMAL
            for n, _, s, e in fields(start, end):
                if n == 1:
                    text = data[s:e].decode()
                elif n == 2:
                    score = struct.unpack("<f", data[s:e])[0]
                elif n == 3:
                    type_ = varint(s)[0]
            pieces.append((text, score, type_))
    return pieces


def _step(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Substring hashes, one character longer."""
    h = (h + points + np.uint64(1)) * _BASE
    return h ^ (h >> np.uint64(29))


def _hash(points: np.ndarray) -> np.ndarray:
    """Hashes of the columns of a code point matrix."""
    out = np.zeros(points.shape[1], np.uint64)
    for row in points:
        out = _step(out, row)
    return out


class Pieces:
    """Pieces by id, and their sorted hashes by length in characters."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        surface = [b""] * len(pieces)
        self.byte_id: dict[int, int] = {}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        by_length: dict[int, list[tuple[str, float, int]]] = {}
        least = 0.0
        for i, (text, score, type_) in enumerate(pieces):
            if type_ in (NORMAL, USER):
                by_length.setdefault(len(text), []).append((text, score, i))
                surface[i] = text.replace(MARK, " ").encode()
                least = min(least, score)
            elif type_ == BYTE:
                value = int(text[3:5], 16)
                self.byte_id[value] = i
                surface[i] = bytes([value])
        self.surface = pa.array(surface, pa.binary())
        self.fallback = least - UNKNOWN_PENALTY  # a byte costs more than any piece
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, group in by_length.items():
            keys = _hash(np.array([[ord(c) for c in t] for t, _, _ in group], np.uint64).T)
            order = np.argsort(keys)
            held = np.zeros(1 << _FILTER_BITS, bool)
            held[keys >> _FILTER_SHIFT] = True
            self.tables[n] = (held, keys[order], np.array([g[1] for g in group])[order], np.array([g[2] for g in group], np.int32)[order])
        self.longest = max(self.tables, default=0)
        self.solved: dict[str, bytes] = {}
        self._held = 0

    def spell(self, char: str) -> list[int]:
        """Byte pieces of a character (``unknown`` where the model has none)."""
        return [self.byte_id.get(b, self.unknown) for b in char.encode()]

    def _probe(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the hashes are pieces, with the scores and ids there."""
        held, keys, scores, ids = self.tables[length]
        at = np.flatnonzero(held[hashes >> _FILTER_SHIFT])
        spot = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
        true = keys[spot] == hashes[at]
        at, spot = at[true], spot[true]
        return at, scores[spot], ids[spot]

    def _fallbacks(self, points: np.ndarray) -> np.ndarray:
        """Cost of spelling each code point in bytes."""
        size = 1 + (points > 0x7F) + (points > 0x7FF) + ((points > 0xFFFF) & (points < 0x110000))
        return size * self.fallback

    def viterbi(self, points: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best last piece of every prefix of the columns, longest first: its
        length and id, ``(length + 1, words)`` each; id -1 is a spelled
        character. Equal scores: the longer last piece."""
        size, n = points.shape
        reach = np.searchsorted(-lengths, -np.arange(size + 1), side="right").tolist()  # words of that length at least
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        back = np.ones((size + 1, n), np.int32)
        piece = np.full((size + 1, n), -1, np.int32)
        spelled = self._fallbacks(points)
        for start in range(size):
            base = best[start]  # earlier starts, so longer pieces, came before
            n = reach[start + 1]
            alone = base[:n] + spelled[start, :n]
            better = np.flatnonzero(alone > best[start + 1, :n])
            best[start + 1][better], back[start + 1][better], piece[start + 1][better] = alone[better], 1, -1
            h = np.zeros(n, np.uint64)
            for width in range(1, min(self.longest, size - start) + 1):
                n = reach[start + width]
                h = _step(h[:n], points[start + width - 1, :n])
                if width not in self.tables:
                    continue
                at, score, ids = self._probe(width, h)
                total = base[at] + score
                end = start + width
                better = total > best[end][at]
                at = at[better]
                best[end][at], back[end][at], piece[end][at] = total[better], width, ids[better]
        return back, piece

    def _long(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word: all substrings probe at once, then one
        pass over the ends."""
        size = len(points)
        found: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
        h = np.zeros(size, np.uint64)
        for width in range(1, min(self.longest, size) + 1):
            h = _step(h[: size - width + 1], points[width - 1 :])
            if width in self.tables:
                for at, score, ident in zip(*(x.tolist() for x in self._probe(width, h)), strict=True):
                    found[at + width].append((width, score, ident))
        best = [0.0] * (size + 1)
        back, piece = [1] * (size + 1), [-1] * (size + 1)
        spelled = self._fallbacks(points).tolist()
        for end in range(1, size + 1):
            top = -np.inf
            for width, score, ident in reversed(found[end]):
                if best[end - width] + score > top:
                    top, back[end], piece[end] = best[end - width] + score, width, ident
            if best[end - 1] + spelled[end - 1] > top:
                top, back[end], piece[end] = best[end - 1] + spelled[end - 1], 1, -1
            best[end] = top
        return np.array(back, np.int32), np.array(piece, np.int32)

    def _trace(self, word: str, back: np.ndarray, piece: np.ndarray) -> bytes:
        ids: list[list[int]] = []
        end = len(word)
        while end:
            ids.append([int(piece[end])] if piece[end] >= 0 else self.spell(word[end - 1]))
            end -= int(back[end])
        flat = [i for part in reversed(ids) for i in part]
        return struct.pack(f"<{len(flat)}i", *flat)

    def solve(self, new: set[str]) -> None:
        """Segment the words (``▁`` for a space) not yet solved."""
        group = sorted(new, key=len, reverse=True)
        start = 0
        while start < len(group):
            size = len(group[start])
            part = group[start : start + (1 if size > LONG_WORD else BATCH_CELLS // size)]
            start += len(part)
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            points = _points(part, lengths)
            if size > LONG_WORD:
                self.solved[part[0]] = self._trace(part[0], *self._long(points[:, 0]))
            else:
                self._trace_all(part, lengths, *self.viterbi(points, lengths))

    def _trace_all(self, part: list[str], lengths: np.ndarray, back: np.ndarray, piece: np.ndarray) -> None:
        """Follow the backpointers of all words at once."""
        n, size = len(part), back.shape[0] - 1
        chosen = np.full((n, size), -1, np.int32)
        used = np.zeros((n, size), bool)
        end = lengths.copy()
        row = np.arange(n)
        spelled = np.zeros(n, bool)
        while len(row):
            at = end[row]
            ident = piece[at, row]
            chosen[row, at - 1], used[row, at - 1] = ident, True
            spelled[row[ident < 0]] = True
            end[row] = at - back[at, row]
            row = row[end[row] > 0]
        flat, counts = chosen[used], used.sum(axis=1)
        data, stops = flat.astype("<i4").tobytes(), (np.cumsum(counts) * 4).tolist()
        start = 0
        for i, (w, stop) in enumerate(zip(part, stops, strict=True)):
            self.solved[w] = self._trace(w, back[:, i], piece[:, i]) if spelled[i] else data[start:stop]
            start = stop

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text (null: null; empty: none). One mark is put before
        the text, and every space becomes one."""
        split = [None if t is None else _split(t) if t else [] for t in texts]
        words = set().union(*(s for s in split if s))
        new = words.difference(self.solved)
        if new:
            if self._held > CACHE_BYTES:
                self.solved.clear()
                self._held, new = 0, words
            self.solve(new)
        get = self.solved.__getitem__
        self._held += 160 * len(new) + 4 * sum(map(len, new)) + sum(map(len, map(get, new)))
        return [None if s is None else np.frombuffer(b"".join(map(get, s)), "<i4") for s in split]

    def decode(self, ids: np.ndarray | None) -> str | None:
        """The text of the ids: ids outside the model and control pieces say
        nothing; the mark put before the text goes."""
        if ids is None:
            return None
        known = self.surface.take(pa.array(ids[(ids >= 0) & (ids < len(self.surface))]))
        data = pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), b"")[0].as_py()
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _split(text: str) -> list[str]:
    """The words of a text with a space put before it."""
    parts = text.split(" ")
    return _WORD.findall(" " + text) if "" in parts else [" " + p for p in parts]


def _points(group: list[str], lengths: np.ndarray) -> np.ndarray:
    """Code points in columns (0 after the end), a space as the mark, a literal mark as one that no piece has."""
    flat = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).astype(np.uint64)
    literal = flat == 0x2581
    flat[flat == 0x20] = 0x2581
    flat[literal] = 0x3FFF2581  # as long in bytes as it, but no character
    points = np.zeros((len(group), int(lengths.max())), np.uint64)
    points[np.arange(points.shape[1]) < lengths[:, None]] = flat
    return np.ascontiguousarray(points.T)


def load_model(path: str) -> bytes:
    """The serialised model (a tokenizer file of a fixed, small size)."""
    with open(path, "rb") as f:
        return f.read()


def _id_lists(ids: list[np.ndarray | None]) -> tuple[pa.Array, np.ndarray]:
    """The ids as an array of lists, and the number of ids (null: -1)."""
    sizes = np.array([-1 if i is None else len(i) for i in ids], np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0)))).astype(np.int32)
    some = [i for i in ids if i is not None and len(i)]
    values = pa.array(np.concatenate(some) if some else np.empty(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(sizes < 0)), sizes


def _encode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(read_model(model))
        for batch in slices(batches, "data", SLICE_BYTES):
            texts = [None if d is None else d.decode("utf-8", "replace") for d in batch.column("data").to_pylist()]
            ids = pieces.encode(texts)
            lists, sizes = _id_lists(ids)
            same = pa.array([None if t is None else pieces.decode(i) == t for t, i in zip(texts, ids, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(np.maximum(sizes, 0)), same], names=["doc_id", "token_ids", "n_tokens", "round_trip"]
            )

    return run


def encode_documents(docs: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``token_ids``, ``n_tokens``,
    ``round_trip`` (decoding gives the text back). A null text has null ids,
    no tokens and a null ``round_trip``; an empty one has no ids. Ids may be
    null or repeat; an empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, token_ids array<int>, n_tokens bigint, round_trip boolean"
    return ids_and_bytes(docs, id_col, text_col).mapInArrow(_encode(load_model(model_path)), schema)


def with_token_ids(docs: DataFrame, model_path: str = MODEL_PATH, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` (one of the name ``out_col`` is replaced) and
    the ids of the text."""
    model = load_model(model_path)

    def run(parts):
        pieces = Pieces(read_model(model))
        for batch, texts in parts:
            yield batch, [_id_lists(pieces.encode([None if d is None else d.decode("utf-8", "replace") for d in texts]))[0]]

    return map_whole_rows(docs.drop(out_col), text_col, run, [StructField(out_col, ArrayType(IntegerType()))], SLICE_BYTES)


def decode_documents(encoded: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """``doc_id`` and the decoded ``text`` of each row; null ids: null text."""
    model = load_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(read_model(model))
        for batch in batches:
            texts = [pieces.decode(None if i is None else np.array(i, np.int32)) for i in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("token_ids"))
    return rows.mapInArrow(run, f"doc_id {encoded.schema[id_col].dataType.simpleString()}, text string")
