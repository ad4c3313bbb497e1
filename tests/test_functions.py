"""Unit tables for the Column standardisers (probed Spark behaviour)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.functions import standardize as S
from orderflow.specs import CUSTOMERS, DATE_FORMATS, EMAIL_PATTERN, MONEY_REMOVE, PRICE_REMOVE, PRODUCTS


def _apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_parse_date_accepts_and_rejects(spark):
    accept = ["31/12/2023", "31-12-2023", " 05/06/2022 ", "29/02/2024"]
    reject = ["1/2/2024", "2024-01-15", "31/02/2024", "12/31/2023", "01/01/24", "01-01/2024", "01/01/2024 10:00", ""]
    got = _apply(spark, accept + reject, lambda c: S.parse_date(c, DATE_FORMATS))
    assert got[: len(accept)] == [dt.date(2023, 12, 31), dt.date(2023, 12, 31), dt.date(2022, 6, 5), dt.date(2024, 2, 29)]
    assert got[len(accept) :] == [None] * len(reject)


def test_parse_money(spark):
    cases = {
        "$1,234.565": Decimal("1234.57"),
        "-5.005": Decimal("-5.01"),
        "$ 12": Decimal("12.00"),
        "1e3": Decimal("1000.00"),
        "+7": Decimal("7.00"),
        ".5": Decimal("0.50"),
        "5.": Decimal("5.00"),
        "-$5": Decimal("-5.00"),
        "9999999999.99": Decimal("9999999999.99"),
        "12 USD": None,
        "USD 12": None,
        "(5)": None,
        "9999999999.995": None,
        "NaN": None,
        "1d": None,
        "abc": None,
        "": None,
    }
    got = _apply(spark, list(cases), lambda c: S.parse_decimal(c, remove=MONEY_REMOVE))
    assert got == list(cases.values())


def test_parse_price_strips_usd_suffix_only(spark):
    cases = {"12 USD": Decimal("12.00"), "12USD  ": Decimal("12.00"), "12 $ USD": Decimal("12.00"), "12 usd": None, "USD 12": None}
    got = _apply(spark, list(cases), lambda c: S.parse_decimal(c, remove=PRICE_REMOVE))
    assert got == list(cases.values())


def test_parse_int(spark):
    cases = {"12": 12, " 12 ": 12, "-1": -1, "+3": 3, "12.0": None, "12.7": None, "1e2": None, "1,000": None, "12L": None, "2147483648": None, "": None}
    assert _apply(spark, list(cases), S.parse_int) == list(cases.values())


def test_email_pattern(spark):
    ok = ["a_b@x.co", "a@b..com", "a@-x.com", ".@x.com"]
    bad = ["a@b", "a@b.c", "a b@c.com", "é@x.com", "na"]
    got = _apply(spark, ok + bad, lambda c: c.rlike(EMAIL_PATTERN))
    assert got == [True] * len(ok) + [False] * len(bad)


def test_title_case(spark):
    cases = {"HOME & KITCHEN": "Home & Kitchen", "u.s.a": "U.s.a", "o'neil-smith": "O'neil-smith", "united  states": "United  States", "  N/A ": "N/a"}
    assert _apply(spark, list(cases), S.title_case) == list(cases.values())


def test_trim_keeps_tabs(spark):
    assert _apply(spark, ["\tx ", "  y  "], S.trim_text) == ["\tx", "y"]


def test_country_synonyms_after_title_case(spark):
    f = CUSTOMERS.field("country")
    cases = {"in": "India", " usa ": "United States", "U.S.A": "United States", "great britain": "United Kingdom", "es": "Spain", "na": "Na", "": None, "france": "France"}
    assert _apply(spark, list(cases), lambda c: f.expr(c=c)) == list(cases.values())


def test_category_synonyms_exact_after_title_case(spark):
    f = PRODUCTS.field("category")
    cases = {"electronic": "Electronics", "SPORT": "Sports", " home ": "Home & Kitchen", "home & kitchen": "Home & Kitchen", "N/A": "N/a", None: None}
    assert _apply(spark, list(cases), lambda c: f.expr(c=c)) == list(cases.values())


@pytest.mark.parametrize("value,expected", [("NA", None), ("N/A", None), ("NULL", None), ("NAN", None), ("", None), ("na", "na"), ("x", "x")])
def test_null_sentinels_exact_case(spark, value, expected):
    assert _apply(spark, [value], lambda c: S.null_sentinels(c, ("NA", "N/A", "NULL", "NAN"))) == [expected]


def test_date_guard_never_changes_the_result(spark):
    """The separator guard only skips text the parser would reject."""
    import random

    rng = random.Random(7)
    alphabet = "0123456789/- :T+"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    def width(usual: int) -> int:
        return usual if rng.random() < 0.8 else rng.randint(1, usual + 1)

    for _ in range(4000):  # mostly real dates, with near-misses of every part
        d, m = rng.randint(0, 32), rng.randint(0, 13)
        y = rng.randint(1000, 9999) if rng.random() < 0.8 else rng.randint(0, 99999)
        sep1 = rng.choice("/-")
        sep2 = sep1 if rng.random() < 0.8 else rng.choice("/-")
        pad = " " * rng.randint(0, 1)
        samples.append(f"{pad}{d:0{width(2)}d}{sep1}{m:0{width(2)}d}{sep2}{y:0{width(4)}d}{pad}")
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    trimmed = F.trim(F.col("x"))
    plain = F.coalesce(*[F.try_to_date(trimmed, f) for f in DATE_FORMATS])
    bad = df.where(~S.parse_date(F.col("x"), DATE_FORMATS).eqNullSafe(plain)).count()
    assert bad == 0
    assert df.where(plain.isNotNull()).count() > 500  # the sample does exercise the parser


def test_fixed_prefix_literals():
    from orderflow.functions.standardize import _fixed_prefix_literals

    assert _fixed_prefix_literals("dd/MM/yyyy") == [(3, "/"), (6, "/")]
    assert _fixed_prefix_literals("yyyy-MM-dd") == []
    assert _fixed_prefix_literals("dd'T'MM") == []
