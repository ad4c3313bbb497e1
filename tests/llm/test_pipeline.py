"""The five stages against a brute-force version, on rows of all odd kinds."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm.common import table
from orderflow.llm.decontaminate import edit_budget, fold
from orderflow.llm.langid import fit_languages, gram_counts, letters_only, unit_vectors
from orderflow.llm.pieces import MODEL_PATH, Pieces, load_model, read_model
from orderflow.llm.severity import fit_severity, label_grades, word_features

from .helpers import SF


def toxic(model, text):
    words = {bytes(w) for w in (text or "").lower().encode().translate(bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))).split()}
    return sum(model.weights.get(f, 0.0) for w in words for f in word_features(w)) >= model.cut


def unrecognised(model, text):
    letters = letters_only((text or "").encode())
    if not letters:
        return True
    cosines = (unit_vectors(gram_counts([letters], len(model.idf)), model.idf) @ model.centroids)[0]
    return cosines.max() < model.radius[cosines.argmax()] * (0.5 + min(len(letters), 200) / 400)


def survivors(rows):
    """Of each group of near-duplicates the least id (then digest of the text);
    rows that are equal in both: the least other columns."""
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    for members in groups.values():
        least = min((m[0] for m in members if m[0] is not None), default=None)
        yield [m for m in members if m[0] == least]


def edits(item, text):
    """Least edits between the item and a substring of the text."""
    t = np.frombuffer(text, np.uint8)
    row, steps = np.zeros(len(t) + 1, int), np.arange(len(t) + 1)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (t != c), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    bench = [r.text for r in table(spark, SF, "benchmark").collect() if r.text][:8]
    some = [r for r in docs.orderBy("doc_id").limit(60).collect() if len(r.text or "") < 3000][:30]
    labelled = docs.join(table(spark, SF, "labels").where("toxic = 1").select("doc_id"), "doc_id").limit(3).collect()
    base = [(r.doc_id, r.text) for r in [*some, *labelled]]
    text = next(t for _, t in base if len(t) > 400)
    words = text.split()
    near = " ".join([*words[:-1], "another"])
    rows = base + [
        (None, None), (None, text), (None, text), (5000, None), (5000, ""), (5001, "12 34"),
        (5002, text), (5002, near), (5002, "the of and to the in that is was for it with as on " * 3),
        (5003, "the of and to the in that is was for it with as on " * 3), (5003, next(t for _, t in base[5:] if len(t) > 300)),
        (5004, "the " + bench[0] + " and"), (5004, bench[1][: len(bench[1]) // 2]), (None, bench[2].upper()), (5005, bench[3].replace("e", "a", 3)),
    ]
    frame = spark.createDataFrame([(i, t, "en", "web", n % 3, "x", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, __gone int, __rank string, n_chars long")
    severity = fit_severity(docs, label_grades(table(spark, SF, "labels")))
    languages = fit_languages(docs)
    items = [fold(r.text.encode()) for r in table(spark, SF, "benchmark").collect() if r.text]
    pieces = Pieces(read_model(load_model(MODEL_PATH)))
    want = [tuple(r) for r in frame.collect()]
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF).cache()
        got = [tuple(r) for r in frame.collect()]
        if name == "toxicity":
            want = [r for r in want if not toxic(severity, r[1])]
        elif name == "language_id":
            want = [r for r in want if not unrecognised(languages, r[1])]
        elif name == "minhash_near_dedup":
            # Of texts of the least id that are linked one is left, by digest.
            groups = list(survivors(want))
            for members in groups:
                kept = [r for r in got if r in members]
                assert len(kept) == (len(members) if members[0][0] is None else 1), members
            assert len(got) == sum(len(m) if m[0][0] is None else 1 for m in groups)
            want = got
        elif name == "benchmark_decontamination":
            folded = {r: fold((r[1] or "").encode()) for r in want}
            want = [r for r in want if not any(edits(i, folded[r]) <= max(edit_budget(len(i)), 0) for i in items)]
        else:
            assert [pieces.decode(np.array(r[-1], np.int32)) for r in got] == [r[1] for r in got]
            got = [r[:-1] for r in got]
        assert sorted(got, key=str) == sorted(want, key=str), name
    assert 10 < len(want) < len(rows) - 8
    assert frame.select(F.max(F.size("token_ids"))).first()[0] > 0
