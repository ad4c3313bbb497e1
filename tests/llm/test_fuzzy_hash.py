"""Fingerprints against a plain rolling hash, successors against a sort."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from orderflow.llm import fuzzy_hash
from orderflow.llm.fuzzy_hash import _Powers, compare_with_successors, edited_text, fingerprint, fingerprints, likeness, rolling_hash

from .helpers import docs


def test_rolling_hash_matches_a_plain_one():
    data = bytes(random.Random(1).randrange(256) for _ in range(200))
    for at, got in enumerate(rolling_hash(np.frombuffer(data, np.uint8))):
        last = [data[at - b] if at >= b else 0 for b in range(7)]
        mixed = 0
        for b, c in enumerate(last):
            mixed ^= (c << 5 * b) & 0xFFFFFFFF if 5 * b < 32 else 0
        assert int(got) == (sum(c * (8 - b) for b, c in enumerate(last)) + mixed) & 0xFFFFFFFF


def test_a_small_edit_changes_few_characters(spark):
    rng = random.Random(2)
    powers = _Powers()
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    other = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    prints = [fingerprint(t.encode(), powers) for t in (text, text[:700] + "inserted" + text[700:], other, text * 2, "")]
    row = spark.createDataFrame([tuple(prints)], "a string, b string, c string, d string, e string")
    near = row.select(*[likeness(F.col("a"), F.col(c)) for c in "abcde"]).first()
    assert near[0] == 1 and near[1] > 0.8 and near[2] < 0.3 and near[4] == 0
    assert near[3] > near[2]  # its block size is twice as large
    assert fingerprint(b"", powers) == "3::" and all(len(p) == 3 for p in (q.split(":") for q in prints))


def test_successors_match_a_sort(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(10**9), "".join(rng.choice("abc é\n") for _ in range(rng.randint(0, 300)))) for _ in range(120)]
    rows += [(10**10, None), (-5, ""), (10**10, "tie"), (None, "first"), (7, "x" * 100_000)]
    powers = _Powers()
    ordered = sorted(((i is not None, i or 0, t or "") for i, t in rows), key=lambda r: (r[0], r[1], r[2].encode()))
    want = []
    for k, (named, i, t) in enumerate(ordered):
        edited = edited_text(t, ordered[(k + 1) % len(ordered)][2]).encode()
        want.append((i if named else None, len(t), hashlib.sha256(edited).hexdigest(), fingerprint(t.encode(), powers), fingerprint(edited, powers)))
    got = compare_with_successors(docs(spark, rows)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_row_no_row_and_the_plain_operator(spark):
    one = compare_with_successors(docs(spark, [(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
    none = compare_with_successors(docs(spark, []))
    assert none.count() == 0 and none.columns == compare_with_successors(docs(spark, [(1, "a")])).columns
    got = fingerprints(docs(spark, [(1, "é"), (2, "é"), (3, None)])).collect()
    assert len({r.fingerprint for r in got}) == 2 and {r.n_chars for r in got} == {0, 1}


def test_text_ids_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_hash, "RANGE_BYTES", 400)
    rng = random.Random(6)
    rows = [(f"d{rng.randrange(10**6):06d}", "".join(rng.choice("abc é") for _ in range(rng.randint(0, 60)))) for _ in range(200)] + [(None, "x"), (None, "a"), ("d9", "last")]
    ordered = sorted(((i is not None, i or "", t) for i, t in rows), key=lambda r: (r[0], r[1].encode(), r[2].encode()))
    want = sorted(hashlib.sha256(edited_text(t, ordered[(k + 1) % len(ordered)][2]).encode()).hexdigest() for k, (_, _, t) in enumerate(ordered))
    for frame in (spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(rows, "doc_id string, text string").where("doc_id is null")):
        got = sorted(r.edited_sha256 for r in compare_with_successors(frame.repartition(3)).collect())
        assert got == want if len(got) > 2 else len(got) == 2


def plain_fingerprint(data):
    """Byte by byte, with whole numbers."""
    if not data:
        return "3::"
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    step, roll = 0x9E3779B97F4A7C15, []
    for i in range(len(data)):
        last = [data[j] if j >= 0 else 0 for j in range(i, i - 7, -1)]
        mixed = 0
        for b, c in enumerate(last):
            mixed ^= (c << 5 * b) & 0xFFFFFFFF if 5 * b < 32 else 0
        roll.append((sum(c * (8 - b) for b, c in enumerate(last)) + mixed) & 0xFFFFFFFF)

    def signature(block, longest):
        out, begin = "", 0
        for i in range(len(data)):
            ends = roll[i] % block == block - 1 and len(out) < longest - 1
            if ends or i == len(data) - 1:
                value = sum((c + 1) * pow(step, k, 1 << 64) for k, c in enumerate(data[begin : i + 1])) % (1 << 64)
                value = (value ^ (value >> 32)) * step % (1 << 64)
                out, begin = out + digits[value >> 58], i + 1
        return out

    block = 3
    while block * 64 < len(data):
        block *= 2
    while sum(r % block == block - 1 for r in roll) < 32 and block > 3:
        block //= 2
    return f"{block}:{signature(block, 64)}:{signature(2 * block, 32)}"


def plain_likeness(a, b):
    def near(x, y):
        if not x or not y:
            return 0.0
        row = list(range(len(y) + 1))
        for i, c in enumerate(x):
            new = [i + 1]
            for j, d in enumerate(y):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        return 1 - row[-1] / max(len(x), len(y))

    if a == b:
        return 1.0
    (n, one, two), (m, uno, duo) = ((int(p.split(":")[0]), *p.split(":")[1:]) for p in (a, b))
    if n == m:
        return max(near(one, uno), near(two, duo))
    return near(one, duo) if n == 2 * m else near(two, uno) if 2 * n == m else 0.0


def test_fingerprints_and_likeness_match_plain_versions(spark):
    rng, powers = random.Random(9), _Powers()
    texts = [bytes(rng.choice(b"abcdefgh ij") for _ in range(rng.choice([0, 1, 5, 50, 190, 700, 3000]))) for _ in range(40)]
    texts += [t[: len(t) // 2] + b"##" + t[len(t) // 2 :] for t in texts[:20]]
    prints = [fingerprint(t, powers) for t in texts]
    assert prints == [plain_fingerprint(t) for t in texts]
    pairs = [(a, b) for a in prints for b in prints[::7]] + list(zip(prints[:20], prints[40:], strict=True))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", likeness(F.col("a"), F.col("b")).alias("l")).collect()
    assert all(abs(r.l - plain_likeness(r.a, r.b)) < 1e-12 for r in rows) and len({round(r.l, 3) for r in rows}) > 5
