"""What a task of the pipeline holds at a time is bounded in bytes."""

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc

from orderflow.llm import langid, pieces, severity


def batch(texts, **more):
    columns = {"doc_id": pa.array(range(len(texts)), pa.int64()), "data": pa.array([t.encode() for t in texts], pa.binary())}
    return pa.RecordBatch.from_pydict(columns | more)


def test_feature_counts_come_in_parts():
    texts = [" ".join(f"word{i:06d}x" for i in range(at, at + 2_000)) for at in range(0, 80_000, 1_000)]
    rows = batch(texts, grade=pa.array([i % 3 for i in range(len(texts))], pa.int32()))
    parts = list(severity._feature_counts(iter([rows])))
    # A part ends with the text that fills it: at most four features a word.
    assert max(p.num_rows for p in parts) < severity.MOST_COUNTED + 4 * 2_000
    found, graded, wanted, wanted_graded = Counter(), Counter(), Counter(), Counter()
    for p in parts:
        for f, n, high in zip(*(c.to_pylist() for c in p.columns), strict=True):
            found[f] += n
            graded[f] += high
    for i, text in enumerate(texts):
        own = {f for w in text.encode().split() for f in severity.word_features(w)}
        wanted.update(own)
        wanted_graded.update(own if i % 3 else ())
    assert found == wanted and +graded == wanted_graded


def test_words_are_split_half_a_megabyte_at_a_time():
    rows = batch(["a few words again " * 12_000] * 6)
    parts = list(pieces._encode(pieces.load_model(pieces.MODEL_PATH))(iter([rows])))
    assert max(sum(pc.binary_length(rows.column("data").take(p.column("doc_id"))).to_pylist()) for p in parts) <= 1 << 19
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == list(range(6))
    assert all(p.column("round_trip").to_pylist() == [True] * p.num_rows for p in parts)


def test_word_weights_are_cached_in_twelve_megabytes():
    model = severity.SeverityModel({severity.word_features(b"awful")[0]: 2.0}, (1.0,))
    scores = severity.word_scores(model)
    for i in range(100_000):
        assert scores[b"%09d" % i] == 0.0
    assert len(scores) * 169 <= 12 << 20
    assert scores[b"awful"] == 2.0


def test_small_tables_need_no_python_workers(spark, monkeypatch):
    """A table of Python rows starts a second set of workers on each executor
    that never work again; one of Arrow starts none."""
    made, make = [], type(spark).createDataFrame

    def recorded(self, data, *args, **kwargs):
        made.append(data)
        return make(self, data, *args, **kwargs)

    rows = [(i, f"awful words number {i}" if i % 4 == 0 else f"plain words number {i}", "en", int(i % 4 == 0)) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, grade int").cache()
    table.count()
    monkeypatch.setattr(type(spark), "createDataFrame", recorded)
    found = severity.fit_severity(table.drop("grade", "lang"), table.select("doc_id", "grade"))
    assert severity.word_scores(found)[b"awful"] > 0
    assert langid.fit_languages(table).langs
    assert len(made) == 2 and all(isinstance(m, pa.Table) for m in made)
