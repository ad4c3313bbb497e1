"""The order library stays on the DataFrame API: no driver collects, no RDDs,
no Python UDFs, no local checkpoints, no row caps or sampling. (The optional
training-data operators have other rules and tests of their own.)"""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "orderflow"

FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "collect to driver": r"\.collect\(\)|\.toPandas\(\)|\.toLocalIterator\(",
    "RDD API": r"\.rdd\b|mapPartitions|parallelize\(",
    "Python UDF": r"\budf\(|pandas_udf|applyInPandas|mapInPandas",
    "cross join": r"crossJoin|how=\"cross\"",
    "row cap or sample": r"\.limit\(|\.sample\(|\.take\(|\.head\(",
    "broadcast hint": r"F\.broadcast\(|\.hint\(\"broadcast",
}


def test_library_source_is_clean():
    hits = []
    for path in sorted(p for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts):
        for n, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            for label, pattern in FORBIDDEN.items():
                if re.search(pattern, code):
                    hits.append(f"{path.relative_to(LIB)}:{n}: {label}: {line.strip()}")
    assert not hits, "\n".join(hits)
