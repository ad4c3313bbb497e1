"""Removal of repeated passages against a plain version."""

import random

import numpy as np
import pytest

from orderflow.llm import substrings
from orderflow.llm.substrings import _packed, _unpacked, remove_repeated_passages

from .helpers import docs


def plain(rows):
    """Brute force over ``(id, text)`` rows."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for s in range(len(w) - 12):
            if i is not None:
                key = tuple(w[s : s + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - 12):
            if i is not None and first[tuple(w[s : s + 13])] < i:
                gone.update(range(s, s + 13))
        out.append((i, len(w), len(gone), " ".join(x.decode() for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def removed(spark, rows):
    got = remove_repeated_passages(docs(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    return sorted(map(tuple, got.collect()), key=str)


def passage(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdé", k=3)) for _ in range(n))


def test_passages_copies_and_odd_rows(spark):
    shared, other = passage(1, 60), passage(2, 14)
    rows = [
        (1, passage(3, 30) + " " + shared),
        (2, shared + "\n" + passage(4, 30)),
        (3, passage(5, 5) + "\t" + other + " " + passage(6, 40) + " " + other),
        (4, other),
        (5, other[: other.rindex(" ")]),  # 13 words: one window
        (6, " ".join(other.split()[:12])),  # no window
        (7, None),
        (8, ""),
        (9, " \n "),
        (10, shared),
        (10, shared),  # repeats an id
        (11, shared + " " + shared),
        (None, shared),
        (None, other),
        (-5, passage(7, 13)),
        (12, passage(7, 13) + " tail"),
        (13, "a " * 40),
        (14, "a " * 40),
        (1 << 40, other),
    ]
    assert removed(spark, rows) == plain(rows)


def test_many_pieces_give_the_same(spark, monkeypatch):
    """Pieces of a few texts, hot passages, and a sketch full of collisions."""
    r = random.Random(5)
    pool = [passage(100 + i, r.randrange(10, 40)) for i in range(12)]
    rows = [(r.randrange(400), " ".join(r.choice(pool) if r.random() < 0.4 else passage(i * 7 + j, 20) for j in range(r.randrange(6)))) for i in range(300)]
    want = plain(rows)
    assert sum(x[2] for x in want) > 3000
    monkeypatch.setattr(substrings, "PIECE_BYTES", 4000)
    monkeypatch.setattr(substrings, "SPLIT_BYTES", 500)
    assert removed(spark, rows) == want
    monkeypatch.setattr(substrings, "CELLS_PER_WINDOW", 1)
    assert removed(spark, rows) == want


def test_no_rows(spark):
    assert removed(spark, []) == []


def test_texts_are_not_shuffled(spark):
    plan = remove_repeated_passages(docs(spark, [(1, passage(1, 20))]))._jdf.queryExecution().executedPlan().toString()
    sides = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(sides) == 4 and not any("data" in line for line in sides)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pieces_")]


@pytest.mark.parametrize("universe,n", [(1 << 20, 5), (1 << 24, 3000), (1 << 31, 50), (64, 64), (1 << 20, 0)])
def test_packed_cells_come_back(universe, n):
    values = np.sort(np.random.default_rng(n).choice(universe, n, replace=False)) if universe < 1 << 25 else np.unique(np.random.default_rng(n).integers(0, universe, n))
    assert _unpacked(_packed(values.astype(np.uint64), universe)).tolist() == values.tolist()
