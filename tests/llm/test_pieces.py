"""Viterbi segmentation against a plain one, and exact round trips."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import pieces as module
from orderflow.llm.pieces import BYTE, MODEL_PATH, NORMAL, USER, Pieces, decode_documents, encode_documents, load_model, read_model, with_token_ids

from .helpers import docs


@pytest.fixture(scope="module")
def model():
    return read_model(load_model(MODEL_PATH))


def plain(text, model, fallback):
    """Best ids of a text by one Viterbi pass over its characters."""
    if not text:
        return []
    score = {t: (s, i) for i, (t, s, kind) in enumerate(model) if kind in (NORMAL, USER)}
    byte = {int(t[3:5], 16): i for i, (t, _, kind) in enumerate(model) if kind == BYTE}
    chars = ["▁", *("\0mark" if c == "▁" else "▁" if c == " " else c for c in text)]
    best, back = [0.0] + [-math.inf] * len(chars), [None] * (len(chars) + 1)
    for end in range(1, len(chars) + 1):
        spelled = ("▁" if chars[end - 1] == "\0mark" else chars[end - 1]).encode()
        best[end], back[end] = best[end - 1] + fallback * len(spelled), (1, [byte[b] for b in spelled])
        for width in range(1, min(end, 16) + 1):
            piece = "".join(chars[end - width : end])
            if piece in score and best[end - width] + score[piece][0] >= best[end]:
                best[end], back[end] = best[end - width] + score[piece][0], (width, [score[piece][1]])
    out, end = [], len(chars)
    while end:
        out.append(back[end][1])
        end -= back[end][0]
    return [i for part in reversed(out) for i in part]


CASES = ["", " ", "  a  b ", "▁x ▁▁ y", "日本語テキスト 🙂 ok", "\n\n\tfoo\x00bar", "é" * 300 + " " + "abc" * 200, "the cat sat on the mat."]


def test_matches_a_plain_viterbi(model):
    pieces = Pieces(model)
    for text, ids in zip(CASES, pieces.encode(CASES), strict=True):
        assert list(ids) == plain(text, model, pieces.fallback)
        assert pieces.decode(ids) == text


def mixed_words(count, seed):
    """``count`` words of every length up to 47 characters."""
    rng = random.Random(seed)
    return ["".join(rng.choices("etaonisthréñ日▁\n🙂", k=n)) for n in range(1, 48) for _ in range(count)]


def test_words_of_unequal_length_are_solved_together(model, monkeypatch):
    calls, solve = [], Pieces.viterbi
    monkeypatch.setattr(Pieces, "viterbi", lambda self, points, *more: calls.append(points.shape[1]) or solve(self, points, *more))
    words = mixed_words(4, 1)
    random.Random(2).shuffle(words)
    text = " ".join(words)
    pieces = Pieces(model)
    (ids,) = pieces.encode([text])
    assert list(ids) == plain(text, model, pieces.fallback)
    assert pieces.decode(ids) == text
    assert sum(calls) == len(set(words)) and len(calls) == 1  # one for each length took most of the time


def test_an_emptied_cache_changes_nothing(model, monkeypatch):
    texts = [" ".join(mixed_words(1, i)) + " the  same words " for i in range(4)]
    whole = Pieces(model).encode(texts)
    monkeypatch.setattr(module, "CACHE_BYTES", 1 << 10)
    pieces = Pieces(model)
    assert [list(pieces.encode([t])[0]) for t in texts] == [list(i) for i in whole]


def test_ids_outside_the_model_say_nothing(model):
    pieces = Pieces(model)
    (ids,) = pieces.encode(["a cat"])
    assert pieces.decode(np.concatenate(([-1, 1, 1 << 30], ids, [len(model)])).astype(np.int32)) == "a cat"
    assert pieces.decode(np.empty(0, np.int32)) == "" and pieces.decode(None) is None


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=40, deadline=None)
def test_any_text_round_trips(texts):
    pieces = Pieces(read_model(load_model(MODEL_PATH)))
    assert [pieces.decode(i) for i in pieces.encode(texts)] == texts


def test_documents(spark):
    rows = [*enumerate(CASES), (50, None), (None, "x"), (1, "again"), (60, "long word" + "z" * 60_000)]
    frame = docs(spark, rows)
    got = encode_documents(frame).collect()
    assert len(got) == len(rows)
    assert all(r.round_trip for r in got if r.doc_id != 50)
    null = next(r for r in got if r.doc_id == 50)
    assert null.token_ids is None and null.n_tokens == 0 and null.round_trip is None
    whole = with_token_ids(frame)
    assert whole.columns == [*frame.columns, "token_ids"]
    back = decode_documents(whole).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in back) == sorted((i if i is not None and i != 0 else -1, t or "") for i, t in rows)
    assert with_token_ids(whole).columns == whole.columns
    assert encode_documents(docs(spark, [])).count() == 0
