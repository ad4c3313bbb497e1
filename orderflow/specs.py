"""Declarative entity specs: columns, standardisers, ordered rules, keys.

Specs are data. Adding an entity (or changing a rule) means editing a spec,
not writing a new column chain. Standardising and validating an entity is then
a few fused projections (see :mod:`orderflow.operators.validate`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.functions import standardize as S
from orderflow.functions.rules import Rule, below, missing, not_in, not_matching

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced, so they are
# stated here plainly and together.
# ---------------------------------------------------------------------------
SENTINELS = ("NA", "N/A", "NULL", "NAN")
DATE_FORMATS = ("dd/MM/yyyy", "dd-MM-yyyy")
CUSTOMER_ID_PATTERN = r"^C\d{4}$"
PRODUCT_ID_PATTERN = r"^P\d{3}$"
ORDER_ID_PATTERN = r"^O\d{5}$"
EMAIL_PATTERN = r"^[A-Za-z0-9.\_%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
MONEY_REMOVE = (r"\$", ",")
PRICE_REMOVE = (r"\$", ",", r"\s*USD\s*$")
COUNTRY_SYNONYMS = {
    "India": ("IN", "BHARAT", "INDIA"),
    "United States": ("US", "USA", "U.S.A", "UNITED STATES"),
    "United Kingdom": ("UK", "U.K", "UNITED KINGDOM", "GREAT BRITAIN"),
    "Spain": ("ES", "SPAIN"),
}
CATEGORY_SYNONYMS = {
    "Electronics": ("Electronic",),
    "Sports": ("Sport",),
    "Clothing": ("Clothes",),
    "Books": ("Book",),
    "Home & Kitchen": ("Home",),
}
ORDER_STATUS_SYNONYMS = {"Cancelled": ("canceled",)}
ORDER_STATUSES = ("Shipped", "Completed", "Returned", "Cancelled", "Pending")
RECOGNISED_STATUSES = ("Completed", "Shipped")
RETURNED_STATUS = "Returned"
CANCELLED_STATUS = "Cancelled"
VALID = "Valid"
INVALID = "Invalid"
# Columns of the curated tables, in output order.
ENRICHED_COLUMNS = (
    "order_id", "customer_id", "customer_name", "email", "country", "product_id", "product_name", "category",
    "price_cleaned", "quantity", "order_date_cleaned", "order_status",
)
FACT_COLUMNS = ("order_id", "customer_id", "product_id", "order_date_cleaned", "order_status", "quantity")
DIM_CUSTOMER_COLUMNS = ("customer_id", "customer_name", "email", "country", "signup_date_cleaned", "lifetime_value_cleaned")
DIM_PRODUCT_COLUMNS = ("product_id", "product_name", "category", "price_cleaned", "stock_qty")
# The error codes, rule order and raw columns of the entity specs below are
# fixed values as well.
# ---------------------------------------------------------------------------

STATUS_COLUMN = "record_status"
REASON_COLUMN = "error_reason"


@dataclass(frozen=True)
class Field:
    """One standardised column.

    ``source`` is the raw column read; when it equals ``name`` the column is
    replaced in place (keeping its position), otherwise ``name`` is appended.
    The value is built in three steps: ``normalize`` -> ``synonyms`` ->
    sentinel nulling, and each step can be evaluated on its own.
    """

    name: str
    source: str | None = None
    normalize: Callable[[Column], Column] | None = None
    synonyms: Mapping[str, tuple[str, ...]] | None = None
    synonym_key: Callable[[Column], Column] | None = None
    sentinels: tuple[str, ...] | None = None
    dtype: str = "string"

    @property
    def raw(self) -> str:
        return self.source or self.name

    def expr(self, upto: str = "sentinels", c: Column | None = None) -> Column:
        """The standardised value, stopping after step ``upto``
        (``normalize`` | ``synonyms`` | ``sentinels``)."""
        out = F.col(self.raw) if c is None else c
        if self.normalize is not None:
            out = self.normalize(out)
        if upto == "normalize":
            return out
        if self.synonyms:
            out = S.map_values(out, self.synonyms, key=self.synonym_key)
        if upto == "synonyms":
            return out
        if self.sentinels is not None:
            out = S.null_sentinels(out, self.sentinels)
        return out


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    raw_columns: tuple[str, ...]
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...]
    # Survivor order for duplicate keys (ascending, nulls first); every other
    # column follows as a tie-break so the order is total.
    dedup_order: tuple[str, ...] = field(default_factory=tuple)

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def rule(self, name: str) -> Rule:
        for r in self.rules:
            if r.name == name:
                return r
        raise KeyError(name)

    @property
    def typed_columns(self) -> dict[str, str]:
        """Columns whose processed type is not string."""
        return {f.name: f.dtype for f in self.fields if f.dtype != "string"}

    def processed_ddl(self) -> str:
        """Processed columns (for raw input with exactly ``raw_columns``):
        raw columns in order, derived fields appended, then the verdict."""
        typed = self.typed_columns
        derived = [f.name for f in self.fields if f.raw != f.name]
        cols = [*self.raw_columns, *derived]
        parts = [f"`{c}` {typed.get(c, 'string')}" for c in cols]
        return ", ".join([*parts, f"`{STATUS_COLUMN}` string", f"`{REASON_COLUMN}` string"])


_money = partial(S.parse_decimal, remove=MONEY_REMOVE)
_price = partial(S.parse_decimal, remove=PRICE_REMOVE)
_date = partial(S.parse_date, formats=DATE_FORMATS)


CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    raw_columns=("customer_id", "customer_name", "email", "country", "lifetime_value", "signup_date"),
    fields=(
        Field("customer_id", normalize=S.normalize_id, sentinels=SENTINELS),
        Field("customer_name", normalize=S.trim_text, sentinels=SENTINELS),
        Field("email", normalize=S.normalize_email, sentinels=SENTINELS),
        Field(
            "country",
            normalize=S.title_case,
            synonyms=COUNTRY_SYNONYMS,
            synonym_key=F.upper,
            sentinels=SENTINELS,
        ),
        Field("lifetime_value_cleaned", source="lifetime_value", normalize=_money, dtype="decimal(12,2)"),
        Field("signup_date_cleaned", source="signup_date", normalize=_date, dtype="date"),
    ),
    rules=(
        Rule(
            "rule_customer_id",
            "customer_id",
            (
                missing("CUSTOMER_ID_MISSING"),
                not_matching("CUSTOMER_ID_INVALID_FORMAT", CUSTOMER_ID_PATTERN),
            ),
        ),
        Rule("rule_customer_name", "customer_name", (missing("CUSTOMER_NAME_MISSING"),)),
        Rule(
            "rule_email",
            "email",
            (missing("EMAIL_MISSING"), not_matching("EMAIL_INCORRECT_FORMAT", EMAIL_PATTERN)),
        ),
        Rule("rule_country", "country", (missing("COUNTRY_MISSING"),)),
        Rule(
            "rule_lifetime_value",
            "lifetime_value_cleaned",
            (missing("MISSING_LIFETIME"), below("NEGATIVE_LIFETIME", 0)),
        ),
        Rule(
            "rule_signup_date",
            "signup_date_cleaned",
            (missing("MISSING_OR_INVALID_SIGNUP_DATE"),),
        ),
    ),
    dedup_order=("customer_name", "email", "country", "lifetime_value_cleaned", "signup_date_cleaned"),
)

PRODUCTS = EntitySpec(
    name="products",
    key="product_id",
    raw_columns=("product_id", "product_name", "category", "price", "stock_qty"),
    fields=(
        Field("product_id", normalize=S.normalize_id, sentinels=SENTINELS),
        Field("product_name", normalize=S.trim_text, sentinels=SENTINELS),
        Field("category", normalize=S.title_case, synonyms=CATEGORY_SYNONYMS, sentinels=SENTINELS),
        Field("price_cleaned", source="price", normalize=_price, dtype="decimal(12,2)"),
        Field("stock_qty", normalize=S.parse_int, dtype="int"),
    ),
    rules=(
        Rule(
            "rule_product_id",
            "product_id",
            (missing("MISSING_PRODUCT_ID"), not_matching("PRODUCT_ID_INCORRECT_FORMAT", PRODUCT_ID_PATTERN)),
        ),
        Rule("rule_product_name", "product_name", (missing("MISSING_PRODUCT_NAME"),)),
        Rule("rule_category", "category", (missing("MISSING_CATEGORY"),)),
        Rule("rule_price", "price_cleaned", (missing("MISSING_PRICE"), below("NEGATIVE_PRICE", 0))),
        Rule(
            "rule_stock_qty",
            "stock_qty",
            (missing("MISSING_STOCK_QUANTITY"), below("NEGATIVE_STOCK_QUANTITY", 0)),
        ),
    ),
    dedup_order=("product_name", "category", "price_cleaned", "stock_qty"),
)

ORDERS = EntitySpec(
    name="orders",
    key="order_id",
    raw_columns=("order_id", "customer_id", "product_id", "quantity", "order_date", "order_status"),
    fields=(
        Field("order_id", normalize=S.normalize_id, sentinels=SENTINELS),
        Field("customer_id", normalize=S.normalize_id, sentinels=SENTINELS),
        Field("product_id", normalize=S.normalize_id, sentinels=SENTINELS),
        Field("quantity", normalize=S.parse_int, dtype="int"),
        Field(
            "order_status",
            normalize=S.title_case,
            synonyms=ORDER_STATUS_SYNONYMS,
            synonym_key=F.lower,
            sentinels=SENTINELS,
        ),
        Field("order_date_cleaned", source="order_date", normalize=_date, dtype="date"),
    ),
    rules=(
        Rule(
            "rule_order_id",
            "order_id",
            (missing("MISSING_ORDER_ID"), not_matching("ORDER_ID_INCORRECT_FORMAT", ORDER_ID_PATTERN)),
        ),
        Rule(
            "rule_order_customer_id",
            "customer_id",
            (missing("MISSING_CUSTOMER_ID"), not_matching("CUSTOMER_ID_INCORRECT_FORMAT", CUSTOMER_ID_PATTERN)),
        ),
        Rule(
            "rule_order_product_id",
            "product_id",
            (missing("MISSING_PRODUCT_ID"), not_matching("PRODUCT_ID_INCORRECT_FORMAT", PRODUCT_ID_PATTERN)),
        ),
        Rule("rule_quantity", "quantity", (missing("MISSING_QUANTITY"), below("INVALID_QUANTITY", 1))),
        Rule("rule_order_date", "order_date_cleaned", (missing("MISSING_OR_INVALID_ORDER_DATE"),)),
        Rule(
            "rule_order_status",
            "order_status",
            (missing("MISSING_ORDER_STATUS"), not_in("INVALID_ORDER_STATUS", ORDER_STATUSES)),
        ),
    ),
    dedup_order=("customer_id", "product_id", "quantity", "order_date_cleaned", "order_status"),
)

ENTITIES: dict[str, EntitySpec] = {s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS)}


def wide_entities(digits: int = 12) -> dict[str, EntitySpec]:
    """The same entities for id spaces of ``digits`` digits: only the id
    patterns differ."""
    wide = {
        CUSTOMER_ID_PATTERN: rf"^C\d{{{digits}}}$",
        PRODUCT_ID_PATTERN: rf"^P\d{{{digits}}}$",
        ORDER_ID_PATTERN: rf"^O\d{{{digits}}}$",
    }

    def widened(rule: Rule) -> Rule:
        return replace(rule, checks=tuple(replace(c, arg=wide.get(c.arg, c.arg)) if c.kind == "pattern" else c for c in rule.checks))

    return {n: replace(s, rules=tuple(map(widened, s.rules))) for n, s in ENTITIES.items()}
