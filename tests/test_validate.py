"""Row verdicts, code order, column layout and edge cases of V1-V18."""

from pyspark.sql import functions as F

from orderflow.operators.validate import invalid_rows, standardize, valid_rows, validate
from orderflow.specs import CUSTOMERS, ORDERS, PRODUCTS

CUSTOMER_SCHEMA = "customer_id string, customer_name string, email string, country string, lifetime_value string, signup_date string"


def test_codes_in_rule_order_and_status(spark):
    rows = [
        (" c0001 ", " Ann ", " Ann@X.COM ", " usa ", "$1,000.50", "01/02/2020"),
        (None, "NA", "na", "na", "-5", "2020-02-01"),
        ("X0001", "", None, "", "abc", "31/02/2024"),
    ]
    out = validate(spark.createDataFrame(rows, CUSTOMER_SCHEMA), CUSTOMERS).collect()
    assert out[0]["record_status"] == "Valid" and out[0]["error_reason"] is None
    assert out[0]["customer_id"] == "C0001" and out[0]["email"] == "ann@x.com" and out[0]["country"] == "United States"
    assert out[1]["error_reason"] == "CUSTOMER_ID_MISSING;CUSTOMER_NAME_MISSING;EMAIL_INCORRECT_FORMAT;NEGATIVE_LIFETIME;MISSING_OR_INVALID_SIGNUP_DATE"
    assert out[1]["country"] == "Na"  # sentinels compared after casing
    assert out[2]["error_reason"] == (
        "CUSTOMER_ID_INVALID_FORMAT;CUSTOMER_NAME_MISSING;EMAIL_MISSING;COUNTRY_MISSING;MISSING_LIFETIME;MISSING_OR_INVALID_SIGNUP_DATE"
    )
    assert {r["record_status"] for r in out[1:]} == {"Invalid"}


def test_processed_column_layout_and_extra_columns(spark):
    df = spark.createDataFrame([("1", "P001", "x", "Book", "1.00", "3")], "extra string, product_id string, product_name string, category string, price string, stock_qty string")
    v = validate(df, PRODUCTS)
    assert v.columns == ["extra", "product_id", "product_name", "category", "price", "stock_qty", "price_cleaned", "record_status", "error_reason"]
    assert dict(v.dtypes)["stock_qty"] == "int" and dict(v.dtypes)["price_cleaned"] == "decimal(12,2)"
    r = v.first()
    assert r["category"] == "Books" and r["extra"] == "1" and r["record_status"] == "Valid"


def test_order_status_rules(spark):
    rows = [
        ("O00001", "C0001", "P001", "2", "01/01/2020", " canceled "),
        ("O00002", "C0001", "P001", "0", "01-01-2020", "lost"),
        ("O00003", "C0001", "P001", "two", " 01/01/2020", None),
    ]
    schema = "order_id string, customer_id string, product_id string, quantity string, order_date string, order_status string"
    out = validate(spark.createDataFrame(rows, schema), ORDERS).orderBy("order_id").collect()
    assert out[0]["order_status"] == "Cancelled" and out[0]["record_status"] == "Valid"
    assert out[1]["error_reason"] == "INVALID_QUANTITY;INVALID_ORDER_STATUS"
    assert out[2]["error_reason"] == "MISSING_QUANTITY;MISSING_ORDER_STATUS"


def test_status_iff_reason_and_split_is_partition(spark, ws):
    for entity in ("customers", "products", "orders"):
        v = ws.validated(entity)
        bad = v.where((F.col("record_status") == "Invalid") != F.col("error_reason").isNotNull()).count()
        assert bad == 0
        assert valid_rows(v).count() + invalid_rows(v).count() == v.count()


def test_empty_table(spark):
    df = spark.createDataFrame([], CUSTOMER_SCHEMA)
    v = validate(df, CUSTOMERS)
    assert v.count() == 0 and "record_status" in v.columns


def test_missing_required_column_is_an_error(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "customer_id string")
    with pytest.raises(ValueError, match="missing required"):
        standardize(df, CUSTOMERS)


def test_all_28_codes_fire_at_sf0001(ws):
    seen = set()
    for entity in ("customers", "products", "orders"):
        rows = ws.validated(entity).select(F.explode(F.split("error_reason", ";")).alias("c")).distinct().collect()
        seen |= {(entity, r["c"]) for r in rows}
    assert len(seen) == 28


def test_existing_derived_columns_are_replaced_in_place(spark):
    df = spark.createDataFrame(
        [("Invalid", "P001", "x", "Book", "$5", "3", "99.99")],
        "record_status string, product_id string, product_name string, category string, price string, stock_qty string, price_cleaned string",
    )
    v = validate(df, PRODUCTS)
    assert v.columns == ["record_status", "product_id", "product_name", "category", "price", "stock_qty", "price_cleaned", "error_reason"]
    r = v.first()
    assert r["record_status"] == "Valid" and str(r["price_cleaned"]) == "5.00"
