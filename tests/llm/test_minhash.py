"""Near-duplicate components against all-pairs brute force."""

import itertools
import random

import pytest

from orderflow.llm.components import connected_components
from orderflow.llm.minhash import keep_one_of_each, near_duplicates

from .helpers import by_id, docs


def brute(rows, pct=75):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= pct * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of"]) if rng.random() < 0.3 else "".join(rng.choice("abcdef") for _ in range(5))
    rows, passage = [], " ".join(word() for _ in range(55))
    for i in range(40):
        rows.append((i, " ".join(word() for _ in range(rng.randint(1, 80)))))
    hot = [word() for _ in range(120)]
    for i in range(60):  # a large group of near copies, most of them in different places
        copy = hot[:]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((100 + i, " ".join(copy)))
    for i in range(40):  # a passage shared by short documents: links only for the shortest
        rows.append((200 + i, " ".join([passage, *(word() for _ in range(rng.randint(0, 30)))])))
    rows += [(300 + i, "One  two\tthree FOUR") for i in range(30)] + [(400, "one two three four"), (401, None), (402, ""), (403, " \n"), (404, "long " * 9000), (405, "LONG " * 8000)]
    return rows


def test_components_match_brute_force(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs(spark, corpus)).collect()}
    assert got == brute(corpus)


def test_kept_rows_nulls_and_repeats(spark, corpus):
    rows = [*corpus, (None, "one two three four"), (None, None), (5, dict(corpus)[5])]
    frame = docs(spark, rows)
    result = near_duplicates(frame)
    assert result.count() == len(rows)
    assert all(r.kept and r.component_id is None for r in result.where("doc_id is null").collect())
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {i for i, (_, c) in brute(corpus).items() if i == c}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = by_id(connected_components(spark.createDataFrame(edges, "a long, b long")), "node")
    assert {n: r.root for n, r in got.items()} == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in range(101, 150)}}


def kept_texts(frame):
    return sorted(((r.doc_id, r.text) for r in keep_one_of_each(frame).collect()), key=str)


def test_texts_of_a_repeated_id_are_judged_each(spark):
    """A text that is like no other stays, whatever rows share its id."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    near = a.replace("a29", "a29 more")
    rows = [(3, a), (7, a), (7, b), (9, c), (9, near), (2, near), (4, None), (4, None), (4, " "), (5, c), (5, c), (None, a), (None, a)]
    frame = docs(spark, rows)
    for parts in (1, 4):
        assert kept_texts(frame.repartition(parts)) == sorted([(2, near), (7, b), (5, c), (4, None), (4, None), (4, " "), (None, a), (None, a)], key=str)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame).collect()), key=str)
    assert found == sorted(
        [(3, 26, 2, False), (7, 26, 2, False), (7, 26, 7, True), (9, 26, 5, False), (9, 27, 2, False), (2, 27, 2, True)]
        + [(4, 0, 4, True)] * 3
        + [(5, 26, 5, True)] * 2
        + [(None, 26, None, True)] * 2,
        key=str,
    )


def test_different_texts_of_one_id_all_stay(spark):
    texts = [f"{c} is a text of its own {c * 3}" for c in "dbca"]
    for rows in ([(1, t) for t in texts] + [(1, None), (2, "x")], [(2, "x"), (1, None)] + [(1, t) for t in reversed(texts)]):
        assert kept_texts(docs(spark, rows)) == sorted(rows, key=str)


def test_near_texts_of_one_id_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text + " end", 2, "a", 1, 5), (1, text, 1, "b", 1, 5), (1, text, 1, "a", 1, 5), (2, text, 0, "z", 1, 5), (8, "other", 0, "z", 1, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, __gone int, __rank string, key int, again int")
    for one in (frame, frame.where("doc_id <> 1")):  # ids repeat, and do not
        kept = keep_one_of_each(one)
        assert kept.columns == frame.columns
        got = sorted(tuple(r)[:4] for r in kept.collect())
        assert len(got) == 2 and got[1][0] == 8 and got[0][0] == one.agg({"doc_id": "min"}).first()[0]
        if got[0][0] == 1:  # of equal rows the least, of linked texts one
            assert got[0] in ((1, text, 1, "a"), (1, text + " end", 2, "a"))
