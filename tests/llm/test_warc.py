"""Archives: salvage of damaged bytes, revisits, exact round trip."""

import base64
import gzip
import hashlib
import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from orderflow.llm.warc import SLICE_BYTES, _members, _urn, archive_round_trip, read_archives, record_bytes, revisit_plan, salvage, sha1_base32, write_archives
from orderflow.session import new_work_dir


def member(data):
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


RECORDS = [record_bytes(str(i), "response", "http://x/", None, b"payload %d " % i * 50, sha1_base32(b"payload %d " % i * 50)) for i in range(5)]


def seen(data):
    return [(kind, start, end, found if kind == "gap" else found.headers["warc-record-id"]) for kind, start, end, found in salvage(data)]


def test_members_after_damage_are_recovered():
    m = [member(r) for r in RECORDS]
    bad = bytearray(m[2])
    bad[len(bad) // 2] ^= 0xFF
    data = m[0] + b"\0" + m[1] + bytes(bad) + b"junk\x1f\x8b\x08zzz" + m[3] + m[4][:-5]
    got = seen(data)
    assert [g[0] for g in got] == ["record", "record", "gap", "record", "gap"]
    assert [g[3] for g in got if g[0] == "record"] == [f"<urn:page:{i}>" for i in (0, 1, 3)]
    assert got[2][1] == len(m[0]) + 1 + len(m[1]) and got[2][2] == got[3][1] and got[4][2] == len(data)


def test_plain_records_after_damage_are_recovered():
    flipped = RECORDS[2].replace(b"payload 2 payload", b"payload 2 pay1oad", 1)
    data = b"xx" + RECORDS[0] + RECORDS[1][:60] + flipped + RECORDS[3]
    assert [(g[0], g[3]) for g in seen(data)] == [
        ("gap", "no version line"),
        ("record", "<urn:page:0>"),
        ("gap", "bad header line"),
        ("record", "<urn:page:3>"),
    ]
    assert seen(b"") == [] and seen(b"\0\0") == [] and seen(b"nothing here")[0][0] == "gap"


def test_a_record_cut_at_any_byte_is_a_gap_and_costs_no_other():
    for n in range(1, len(RECORDS[1])):
        data = RECORDS[0] + RECORDS[1][:n] + RECORDS[2] + RECORDS[3]
        a, z = len(RECORDS[0]), len(RECORDS[0]) + n
        got = seen(data)
        assert [(k, s, e) for k, s, e, _ in got][:2] == [("record", 0, a), ("gap", a, z)], n
        assert [w for *_, w in got[2:]] == ["<urn:page:2>", "<urn:page:3>"]
        inside = gzip.compress(data)
        assert [k if k == "gap" else w.headers["warc-record-id"] for k, _, _, w in salvage(inside)] == ["<urn:page:0>", "gap", "<urn:page:2>", "<urn:page:3>"]


def test_a_record_cut_at_the_front_is_a_gap():
    for n in range(1, len(RECORDS[1])):
        data = RECORDS[0] + RECORDS[1][n:] + RECORDS[2]
        got = seen(data)
        assert [k for k, *_ in got] == ["record", "gap", "record"], n
        assert got[1][1:3] == (len(RECORDS[0]), len(data) - len(RECORDS[2]))


def test_round_trip_of_odd_pages(spark):
    rows = [(5, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "u v\nw", "<p>é</p>"), (9, "x", "<p>é</p>"), (3, "", None), (4, "b", ""), (None, "c", "solo"), (None, "c", "<p>é</p>"), (7, "d", "WARC/1.1\r\n\r\n" * 100), (8, "e", "z" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, kind string, first int")
    got = sorted(((r.page_id if r.page_id is not None else -1), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive_round_trip(pages).collect())
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        other = first.get(h or "")
        again = i is not None and i > other
        want.append((-1 if i is None else i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", other if again else None))
    assert got == sorted(want, key=lambda r: r[:4])
    assert archive_round_trip(pages.limit(0)).count() == 0


def test_uris_payloads_and_gap_rows(spark):
    pages = spark.createDataFrame([(1, "http://a/b c", "one"), (2, "http://z", "two")], "page_id long, url string, html string")
    path = f"{new_work_dir(spark, 'test-warc')}/w"
    write_archives(revisit_plan(pages).coalesce(1), path)
    rows = read_archives(spark, path).collect()
    assert sorted((r.kind, r.record_id, r.uri, bytes(r.payload)) for r in rows) == [("record", "1", "http://a/b c", b"one"), ("record", "2", "http://z", b"two")]
    small = revisit_plan(spark.createDataFrame([(1, "", "x"), (2, "", "x")], "page_id long, url string, html string"), min_bytes=2)
    assert {r.refers_to for r in small.collect()} == {None}


def test_archives_are_bounded_in_bytes_and_records(spark):
    noise = random.Random(1)
    pages = spark.createDataFrame([(i, "u", noise.randbytes(10_000 if i != 7 else 90_000).hex()) for i in range(60)], "page_id long, url string, html string")
    path = f"{new_work_dir(spark, 'test-warc')}/w"
    write_archives(revisit_plan(pages).coalesce(1), path, max_records=9, max_bytes=60_000)
    sizes = [(r.length, r.n) for r in spark.read.format("binaryFile").load(path).selectExpr("path", "length").join(read_archives(spark, path).groupBy("path").agg(F.count("*").alias("n")), "path").collect()]
    assert sum(n for _, n in sizes) == 60 and all(n <= 9 and (length <= 60_000 + n or n == 1) for length, n in sizes)
    assert sorted(r.record_id for r in read_archives(spark, path).collect()) == sorted(map(str, range(60)))
    write_archives(revisit_plan(pages).coalesce(1), path + "2", max_records=9)
    assert spark.read.format("binaryFile").load(path + "2").count() == 7


def test_member_of_several_records_and_ids_with_colons():
    parts = [record_bytes(f"a:b:{i}", "response", None, None, b"payload %d" % i, sha1_base32(b"payload %d" % i)) for i in range(4)]
    whole = gzip.compress(b"".join(parts))
    found = list(salvage(whole))
    assert [(kind, start, end, r.payload) for kind, start, end, r in found] == [("record", 0, len(whole), b"payload %d" % i) for i in range(4)]
    assert [_urn(r.headers["warc-record-id"]) for *_, r in found] == [f"a:b:{i}" for i in range(4)]
    assert _urn("<urn:uuid:1-2>") == "1-2" and _urn(None) is None
    broken = gzip.compress(b"junk" + parts[0] + parts[1].replace(b"payload 1", b"payload x") + parts[2] + b"WARC/1.1 tail")
    kinds = [(kind, r if kind == "gap" else r.payload) for kind, _, _, r in salvage(broken + whole)]
    assert kinds[:5] == [("gap", "no version line"), ("record", b"payload 0"), ("gap", "payload digest differs"), ("record", b"payload 2"), ("gap", "no version line")]
    assert [k for k, _ in kinds[5:]] == ["record"] * 4
    nothing = gzip.compress(b"no record here")
    assert [(k, a, b) for k, a, b, _ in salvage(nothing)] == [("gap", 0, len(nothing))]


def test_members_are_made_of_slices_of_a_batch():
    noise = random.Random(2)
    data = [noise.randbytes(300_000) for _ in range(40)]
    sha1 = [hashlib.sha1(d).hexdigest() for d in data]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["u"] * 40), pa.array(data, pa.binary()), pa.array(sha1), pa.array([None] * 40, pa.int64())], names=["page_id", "uri", "data", "sha1", "refers_to"])
    out = list(_members(iter([batch]), 1_000_000))
    assert max(b.nbytes for b in out) < SLICE_BYTES + 400_000
    members = [m for b in out for m in b.column("member").to_pylist()]
    assert [next(salvage(m))[3].payload for m in members] == data
    assert [v for b in out for v in b.column("volume").to_pylist()] == [i // 3 for i in range(40)]
