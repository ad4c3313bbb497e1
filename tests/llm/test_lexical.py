"""Ranked search against a plain version in whole numbers."""

import math
import random
import re
from collections import Counter

import numpy as np

from orderflow.llm import lexical
from orderflow.llm.lexical import EXACT, Tile, rank_documents, terms

from .helpers import docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(rows, items, top=10):
    found = [(i, Counter(plain_terms(t))) for i, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 10 + 90 * c.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(plain_terms(text)) if c[w])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def ranked(spark, rows, items, **more):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    got = rank_documents(docs(spark, rows).repartition(4), frame, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    pool = ["Alpha", "beta", "été", "x1", "GAMMA", "delta", "日本", "é", "n0", "omega", *(f"w{k}" for k in range(40))]
    return [(r.randrange(n), r.choice([" ", ", ", "-", "\n"]).join(r.choices(pool, k=r.randrange(1, 60)))) for _ in range(n)]


def test_terms():
    text = "Ab_c-9x É z K[Q] \x7f~a"
    assert [t.decode() for t in terms(text.encode())] == plain_terms(text)
    assert terms(None) == terms(b"") == terms(b" .,") == []


def test_ties_copies_and_odd_rows(spark):
    rows = [*corpus(1, 200), (900, None), (901, ""), (902, "..."), (None, "alpha beta"), (None, "alpha beta"), (5, "alpha"), (5, "alpha")]
    rows += [(1000 + k, "alpha omega w1") for k in range(40)]  # more ties than places
    items = [(1, "alpha omega"), (2, "alpha ALPHA, Été"), (2, "日本 w3"), (3, None), (4, ""), (5, "unseen words"), (None, "w7"), (7, "unseen beta")]
    assert ranked(spark, rows, items) == plain(rows, items)


def test_blocks_and_tiles_give_the_same(spark, monkeypatch):
    rows, items = corpus(2, 150), [(i, t) for i, (_, t) in enumerate(corpus(3, 30))]
    want = plain(rows, items, 3)
    monkeypatch.setattr(lexical, "TILE_ITEMS", 4)
    monkeypatch.setattr(lexical, "TILE_DOCS", 7)
    monkeypatch.setattr(lexical, "HELD_TERMS", 5)
    assert ranked(spark, rows, items, top=3, block_bytes=900) == want


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "alpha")]) == ranked(spark, [(1, "alpha")], []) == ranked(spark, [], []) == []


def test_partial_sums_stay_exact():
    """Weights whose products would pass 2^53 are cut into several products."""
    big = EXACT // 3_000_000
    names = [b"%04d" % k for k in range(20)]
    tile = Tile([0], {0: dict.fromkeys(names, big)})
    assert len(tile.cuts) > 5
    impacts = np.full((1, 20), 999_999.0)
    assert tile.scores(impacts).tolist() == [[20 * 999_999 * big]]
