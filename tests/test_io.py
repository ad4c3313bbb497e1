"""CSV scan behaviour, CSV round trip, Parquet overwrite, zones."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from orderflow.session import new_work_dir
from orderflow.sources import io


def _tmp():
    return tempfile.mkdtemp(prefix="orderflow-io-")


def test_csv_scan_semantics(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as fh:
        fh.write('a,b,c\n1,,x\n2,""\n\n3,y,z,extra\n" 4 ",  sp  ,"q,uo""te"\n')
    rows = io.read_csv(spark, d).collect()
    assert [r.asDict() for r in rows] == [
        {"a": "1", "b": None, "c": "x"},
        {"a": "2", "b": None, "c": None},
        {"a": "3", "b": "y", "c": "z"},
        {"a": " 4 ", "b": "  sp  ", "c": '"q,uo""te"'},  # kept as written: the escape is a backslash
    ]
    assert dict(io.read_csv(spark, d).dtypes) == {"a": "string", "b": "string", "c": "string"}


def test_csv_write_keeps_blanks(spark):
    d = _tmp() + "/out"
    df = spark.createDataFrame([(" a ", "$1,234.00", None)], "x string, y string, z string")
    io.write_csv(df, d)
    assert io.read_csv(spark, d).collect()[0].asDict() == {"x": " a ", "y": "$1,234.00", "z": None}


def test_parquet_overwrite_replaces(spark):
    d = _tmp() + "/p"
    io.write_parquet(spark.range(10), d)
    io.write_parquet(spark.range(3), d)
    assert io.read_parquet(spark, d).count() == 3


def test_published_folders_read_alone(spark, ws):
    valid = ws.valid("customers")
    assert valid.columns[-2:] == ["record_status", "error_reason"]
    assert {r[0] for r in valid.select("record_status").distinct().collect()} == {"Valid"}
    assert spark.read.parquet(ws.zones.valid("customers")).columns == valid.columns


def test_retype_is_a_no_op_on_processed_parquet(ws):
    assert dict(ws.valid("orders").dtypes)["order_date_cleaned"] == "date"
    assert dict(ws.valid("products").dtypes)["price_cleaned"] == "decimal(12,2)"


def test_zones_layout():
    z = io.Zones("s3a://bucket/run")
    assert z.processed("orders") == "s3a://bucket/run/processed/orders"
    assert z.orphans("customers") == "s3a://bucket/run/processed/quarantine/orphan_customers"
    assert z.curated("fact_orders") == "s3a://bucket/run/curated/fact_orders"


def test_zones_with_one_root_per_zone():
    z = io.Zones(raw_root="s3a://raw", processed_root="s3a://processed/", curated_root="s3a://curated")
    assert z.raw("orders") == "s3a://raw/orders"
    assert z.validation_summary == "s3a://processed/validation-summary"
    assert z.curated("dim_products") == "s3a://curated/dim_products"


def _lines(spark, text):
    path = f"{new_work_dir(spark, 'lines')}/t"
    spark.createDataFrame([(line,) for line in text], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_lines_are_marked_counted_and_told_apart(spark):
    path = _lines(spark, ["a,b,c", "1,2,3", "4,5", '"x,y",2,"z,"', "1,2,3,4", "1,2,3,", "", '"q', ",,", "7"])
    plain = io.read_csv(spark, path)
    marked = io.read_csv(spark, path, mark_malformed=True)
    assert marked.columns == ["a", "b", "c", io.MALFORMED]
    assert sorted(map(str, marked.drop(io.MALFORMED).collect())) == sorted(map(str, plain.collect()))  # padded and cut as before
    got = sorted((r.line, r.n_fields, r.error) for r in io.malformed_lines(marked).collect())
    assert got == [('"q', 1, "TOO_FEW_FIELDS"), ("1,2,3,", 4, "TOO_MANY_FIELDS"), ("1,2,3,4", 4, "TOO_MANY_FIELDS"), ("4,5", 2, "TOO_FEW_FIELDS"), ("7", 1, "TOO_FEW_FIELDS")]
    assert marked.select("a").where(F.col(io.MALFORMED).isNotNull()).count() == 5  # whatever columns are read


def test_a_folder_that_lacks_a_column_is_an_error(spark):
    one, two = _lines(spark, ["a,b", "1,2"]), _lines(spark, ["B", "2"])
    with pytest.raises(ValueError, match=r"missing in .*: \['a'\]"):
        io.read_csv(spark, [one, two])
    three = _lines(spark, ["B,A", "4,3"])
    assert sorted(map(tuple, io.read_csv(spark, [one, three]).collect())) == [("1", "2"), ("3", "4")]
