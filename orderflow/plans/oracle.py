"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written by hand from the documented semantics, not generated from the
specs, so that a wrong spec shows up as a mismatch. DuckDB differs from
Spark in a few lenient parsers; the expressions below pin Spark's behaviour:

* ``try_cast(x as int)`` in Spark rejects ``12.7`` / ``1e2``: guard with a
  full-match regex before DuckDB's cast.
* ``try_to_date(x, 'dd/MM/yyyy')`` needs exactly two-digit day and month and
  a four-digit year: guard ``try_strptime`` the same way.
* no ``initcap``: split on blanks, capitalise, re-join.
* ``rlike('^...$')`` -> ``regexp_full_match``.
* decimals and integer sums are cast to the types Spark produces.
"""

from __future__ import annotations

from orderflow.sources.fixtures import oracle_sql as _fixture

SENT = "('NA','N/A','NULL','NAN')"


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _sentinel(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' OR {x} IN {SENT} THEN NULL ELSE {x} END"


def _money(x: str, usd: bool = False) -> str:
    t = f"replace(replace(trim({x}), '$', ''), ',', '')"
    if usd:
        t = f"regexp_replace({t}, '\\s*USD\\s*$', '', 'g')"
    return f"try_cast({t} AS DECIMAL(12,2))"


def _int(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS INTEGER) END"


def _date(x: str) -> str:
    t = f"trim({x})"
    slash = f"CASE WHEN regexp_full_match({t}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) END"
    dash = f"CASE WHEN regexp_full_match({t}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') THEN CAST(try_strptime({t}, '%d-%m-%Y') AS DATE) END"
    return f"coalesce({slash}, {dash})"


def _country(x: str) -> str:
    u = f"upper({x})"
    return (
        f"CASE WHEN {u} IN ('IN','BHARAT','INDIA') THEN 'India' "
        f"WHEN {u} IN ('US','USA','U.S.A','UNITED STATES') THEN 'United States' "
        f"WHEN {u} IN ('UK','U.K','UNITED KINGDOM','GREAT BRITAIN') THEN 'United Kingdom' "
        f"WHEN {u} IN ('ES','SPAIN') THEN 'Spain' ELSE {x} END"
    )


def _category(x: str) -> str:
    return (
        f"CASE WHEN {x} = 'Electronic' THEN 'Electronics' WHEN {x} = 'Sport' THEN 'Sports' "
        f"WHEN {x} = 'Clothes' THEN 'Clothing' WHEN {x} = 'Book' THEN 'Books' "
        f"WHEN {x} = 'Home' THEN 'Home & Kitchen' ELSE {x} END"
    )


def _status(x: str) -> str:
    return f"CASE WHEN lower({x}) = 'canceled' THEN 'Cancelled' ELSE {x} END"


def _verdict(codes: list[str]) -> str:
    reason = f"nullif(concat_ws(';', {', '.join(codes)}), '')"
    return f"CASE WHEN {reason} IS NULL THEN 'Valid' ELSE 'Invalid' END AS record_status, {reason} AS error_reason"


CUSTOMER_CODES = {
    "rule_customer_id": "CASE WHEN customer_id IS NULL THEN 'CUSTOMER_ID_MISSING' WHEN NOT regexp_full_match(customer_id, 'C[0-9]{4}') THEN 'CUSTOMER_ID_INVALID_FORMAT' END",
    "rule_customer_name": "CASE WHEN customer_name IS NULL THEN 'CUSTOMER_NAME_MISSING' END",
    "rule_email": "CASE WHEN email IS NULL THEN 'EMAIL_MISSING' WHEN NOT regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}') THEN 'EMAIL_INCORRECT_FORMAT' END",
    "rule_country": "CASE WHEN country IS NULL THEN 'COUNTRY_MISSING' END",
    "rule_lifetime_value": "CASE WHEN lifetime_value_cleaned IS NULL THEN 'MISSING_LIFETIME' WHEN lifetime_value_cleaned < 0 THEN 'NEGATIVE_LIFETIME' END",
    "rule_signup_date": "CASE WHEN signup_date_cleaned IS NULL THEN 'MISSING_OR_INVALID_SIGNUP_DATE' END",
}
PRODUCT_CODES = {
    "rule_product_id": "CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID' WHEN NOT regexp_full_match(product_id, 'P[0-9]{3}') THEN 'PRODUCT_ID_INCORRECT_FORMAT' END",
    "rule_product_name": "CASE WHEN product_name IS NULL THEN 'MISSING_PRODUCT_NAME' END",
    "rule_category": "CASE WHEN category IS NULL THEN 'MISSING_CATEGORY' END",
    "rule_price": "CASE WHEN price_cleaned IS NULL THEN 'MISSING_PRICE' WHEN price_cleaned < 0 THEN 'NEGATIVE_PRICE' END",
    "rule_stock_qty": "CASE WHEN stock_qty IS NULL THEN 'MISSING_STOCK_QUANTITY' WHEN stock_qty < 0 THEN 'NEGATIVE_STOCK_QUANTITY' END",
}
ORDER_CODES = {
    "rule_order_id": "CASE WHEN order_id IS NULL THEN 'MISSING_ORDER_ID' WHEN NOT regexp_full_match(order_id, 'O[0-9]{5}') THEN 'ORDER_ID_INCORRECT_FORMAT' END",
    "rule_order_customer_id": "CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN NOT regexp_full_match(customer_id, 'C[0-9]{4}') THEN 'CUSTOMER_ID_INCORRECT_FORMAT' END",
    "rule_order_product_id": "CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID' WHEN NOT regexp_full_match(product_id, 'P[0-9]{3}') THEN 'PRODUCT_ID_INCORRECT_FORMAT' END",
    "rule_quantity": "CASE WHEN quantity IS NULL THEN 'MISSING_QUANTITY' WHEN quantity < 1 THEN 'INVALID_QUANTITY' END",
    "rule_order_date": "CASE WHEN order_date_cleaned IS NULL THEN 'MISSING_OR_INVALID_ORDER_DATE' END",
    "rule_order_status": "CASE WHEN order_status IS NULL THEN 'MISSING_ORDER_STATUS' WHEN order_status NOT IN ('Shipped','Completed','Returned','Cancelled','Pending') THEN 'INVALID_ORDER_STATUS' END",
}
RULE_ENTITY = {
    **{k: "customers" for k in CUSTOMER_CODES},
    **{k: "products" for k in PRODUCT_CODES},
    **{k: "orders" for k in ORDER_CODES},
}
RULE_COLUMN = {
    "rule_customer_id": "customer_id",
    "rule_customer_name": "customer_name",
    "rule_email": "email",
    "rule_country": "country",
    "rule_lifetime_value": "lifetime_value_cleaned",
    "rule_signup_date": "signup_date_cleaned",
    "rule_product_id": "product_id",
    "rule_product_name": "product_name",
    "rule_category": "category",
    "rule_price": "price_cleaned",
    "rule_stock_qty": "stock_qty",
    "rule_order_id": "order_id",
    "rule_order_customer_id": "customer_id",
    "rule_order_product_id": "product_id",
    "rule_quantity": "quantity",
    "rule_order_date": "order_date_cleaned",
    "rule_order_status": "order_status",
}
RULE_CODES = {**CUSTOMER_CODES, **PRODUCT_CODES, **ORDER_CODES}

CUSTOMER_COLS = "customer_id, customer_name, email, country, lifetime_value, signup_date, lifetime_value_cleaned, signup_date_cleaned, record_status, error_reason"
PRODUCT_COLS = "product_id, product_name, category, price, stock_qty, price_cleaned, record_status, error_reason"
ORDER_COLS = "order_id, customer_id, product_id, quantity, order_date, order_status, order_date_cleaned, record_status, error_reason"

# Survivor order: the spec order, then every other column in schema order.
CUSTOMER_DEDUP_ORDER = "customer_name, email, country, lifetime_value_cleaned, signup_date_cleaned, lifetime_value, signup_date, record_status, error_reason"
PRODUCT_DEDUP_ORDER = "product_name, category, price_cleaned, stock_qty, price, record_status, error_reason"
ORDER_DEDUP_ORDER = "customer_id, product_id, quantity, order_date_cleaned, order_status, order_date, record_status, error_reason"


def _nulls_first(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(","))


def _dedup(src: str, key: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {_nulls_first(order)}) AS rn FROM {src}) WHERE rn = 1"
    )


CTES = f"""
raw_customers AS ({_fixture("customers")}),
raw_products AS ({_fixture("products")}),
raw_orders AS ({_fixture("orders")}),
std_customers AS (
  SELECT {_sentinel("cid")} AS customer_id, {_sentinel("cname")} AS customer_name,
         {_sentinel("cemail")} AS email, {_sentinel("ccountry")} AS country,
         lifetime_value, signup_date,
         {_money("lifetime_value")} AS lifetime_value_cleaned,
         {_date("signup_date")} AS signup_date_cleaned
  FROM (SELECT *, upper(trim(customer_id)) AS cid, trim(customer_name) AS cname,
               lower(trim(email)) AS cemail, {_country(_initcap("trim(country)"))} AS ccountry
        FROM raw_customers)
),
std_products AS (
  SELECT {_sentinel("pid")} AS product_id, {_sentinel("pname")} AS product_name,
         {_sentinel("pcat")} AS category, price, {_int("stock_qty")} AS stock_qty,
         {_money("price", usd=True)} AS price_cleaned
  FROM (SELECT *, upper(trim(product_id)) AS pid, trim(product_name) AS pname,
               {_category(_initcap("trim(category)"))} AS pcat
        FROM raw_products)
),
std_orders AS (
  SELECT {_sentinel("oid")} AS order_id, {_sentinel("ocid")} AS customer_id,
         {_sentinel("opid")} AS product_id, {_int("quantity")} AS quantity,
         order_date, {_sentinel("ostatus")} AS order_status,
         {_date("order_date")} AS order_date_cleaned
  FROM (SELECT *, upper(trim(order_id)) AS oid, upper(trim(customer_id)) AS ocid,
               upper(trim(product_id)) AS opid, {_status(_initcap("trim(order_status)"))} AS ostatus
        FROM raw_orders)
),
val_customers AS (SELECT *, {_verdict(list(CUSTOMER_CODES.values()))} FROM std_customers),
val_products AS (SELECT *, {_verdict(list(PRODUCT_CODES.values()))} FROM std_products),
val_orders AS (SELECT *, {_verdict(list(ORDER_CODES.values()))} FROM std_orders),
valid_customers AS (SELECT * FROM val_customers WHERE record_status = 'Valid'),
valid_products AS (SELECT * FROM val_products WHERE record_status = 'Valid'),
valid_orders AS (SELECT * FROM val_orders WHERE record_status = 'Valid'),
dd_customers AS ({_dedup("valid_customers", "customer_id", CUSTOMER_DEDUP_ORDER)}),
dd_products AS ({_dedup("valid_products", "product_id", PRODUCT_DEDUP_ORDER)}),
dd_orders AS ({_dedup("valid_orders", "order_id", ORDER_DEDUP_ORDER)}),
orphan_c AS (
  SELECT customer_id, order_id, product_id, quantity, order_date, order_status, order_date_cleaned, record_status, error_reason
  FROM dd_orders o WHERE NOT EXISTS (SELECT 1 FROM dd_customers c WHERE c.customer_id = o.customer_id)
),
orphan_p AS (
  SELECT product_id, order_id, customer_id, quantity, order_date, order_status, order_date_cleaned, record_status, error_reason
  FROM dd_orders o WHERE NOT EXISTS (SELECT 1 FROM dd_products p WHERE p.product_id = o.product_id)
),
with_c AS (
  SELECT customer_id, order_id, product_id, quantity, order_date, order_status, order_date_cleaned, record_status, error_reason
  FROM dd_orders o WHERE EXISTS (SELECT 1 FROM dd_customers c WHERE c.customer_id = o.customer_id)
),
with_cp AS (
  SELECT product_id, customer_id, order_id, quantity, order_date, order_status, order_date_cleaned, record_status, error_reason
  FROM with_c o WHERE EXISTS (SELECT 1 FROM dd_products p WHERE p.product_id = o.product_id)
),
enriched AS (
  SELECT o.order_id, o.customer_id, c.customer_name, c.email, c.country, o.product_id,
         p.product_name, p.category, p.price_cleaned, o.quantity, o.order_date_cleaned, o.order_status
  FROM with_cp o JOIN dd_customers c ON c.customer_id = o.customer_id
                 JOIN dd_products p ON p.product_id = o.product_id
),
measured AS (
  SELECT *, CAST(quantity * price_cleaned AS DECIMAL(23,2)) AS order_amount,
         CAST(quantity * price_cleaned AS DECIMAL(23,2)) AS gross_order_amount,
         CAST(CASE WHEN order_status IN ('Completed','Shipped') THEN quantity * price_cleaned ELSE 0 END AS DECIMAL(23,2)) AS recognized_sales,
         CAST(CASE WHEN order_status = 'Returned' THEN quantity * price_cleaned ELSE 0 END AS DECIMAL(23,2)) AS returned_amount
  FROM enriched
),
customer_metrics AS (
  SELECT customer_id, customer_name, country, count(*) AS total_orders,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(order_amount) AS DECIMAL(33,2)) AS total_spend,
         min(order_date_cleaned) AS first_order_date, max(order_date_cleaned) AS last_order_date
  FROM measured GROUP BY customer_id, customer_name, country
),
product_metrics AS (
  SELECT product_id, product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         CAST(sum(order_amount) AS DECIMAL(33,2)) AS total_sales, count(DISTINCT order_id) AS number_of_orders
  FROM measured GROUP BY product_id, product_name, category
),
sales_summary AS (
  SELECT order_date_cleaned, country, category, count(DISTINCT order_id) AS total_orders,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(recognized_sales) AS DECIMAL(33,2)) AS total_sales,
         CAST(sum(CASE WHEN order_status IN ('Completed','Shipped') THEN 1 ELSE 0 END) AS BIGINT) AS completed_orders,
         CAST(sum(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END) AS BIGINT) AS returned_orders,
         CAST(sum(CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_orders
  FROM measured GROUP BY order_date_cleaned, country, category
),
fact_orders AS (
  SELECT order_id, customer_id, product_id, order_date_cleaned, order_status, quantity,
         price_cleaned AS unit_price, order_amount
  FROM measured
),
dim_customers AS (
  SELECT customer_id, customer_name, email, country, signup_date_cleaned, lifetime_value_cleaned FROM dd_customers
),
dim_products AS (
  SELECT product_id, product_name, category, price_cleaned, stock_qty FROM dd_products
),
validation_summary AS (
  SELECT entity AS "Dataset", count(*) AS "Total_count",
         count(*) FILTER (WHERE record_status = 'Valid') AS "Valid_count",
         count(*) FILTER (WHERE record_status = 'Invalid') AS "Invalid_count",
         CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE record_status = 'Invalid') AS DOUBLE) * 100.0 / count(*) ELSE 0.0 END AS "Invalid_percentage"
  FROM (SELECT 'customers' AS entity, record_status FROM val_customers
        UNION ALL SELECT 'products', record_status FROM val_products
        UNION ALL SELECT 'orders', record_status FROM val_orders)
  GROUP BY entity
)
"""


def _with(select: str) -> str:
    return f"WITH {CTES}\n{select}"


def _dup_summary(tables: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{name}' AS dataset, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_count, "
        f"count(k) AS distinct_id_count, count(*) FILTER (WHERE n > 1) AS duplicate_id_count "
        f"FROM (SELECT {key} AS k, count(*) AS n FROM {src} GROUP BY {key})"
        for name, src, key in tables
    ]
    return " UNION ALL ".join(parts)


def _long(targets: list[tuple[str, str, str, str]]) -> str:
    """(entity, column_name, raw_value, std_value) over raw tables."""
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{column}' AS column_name, {column_raw} AS raw_value, {expr} AS std_value FROM raw_{entity}"
        for entity, column, column_raw, expr in targets
    )


_SENT_COLUMNS = {
    "customers": ["customer_id", "customer_name", "email", "country"],
    "products": ["product_id", "product_name", "category"],
    "orders": ["order_id", "customer_id", "product_id", "order_status"],
}


def _sentinel_query(entity: str) -> str:
    cols = _SENT_COLUMNS[entity]
    exprs = {
        "customers": {
            "customer_id": _sentinel("upper(trim(customer_id))"),
            "customer_name": _sentinel("trim(customer_name)"),
            "email": _sentinel("lower(trim(email))"),
            "country": _sentinel(_country(_initcap("trim(country)"))),
        },
        "products": {
            "product_id": _sentinel("upper(trim(product_id))"),
            "product_name": _sentinel("trim(product_name)"),
            "category": _sentinel(_category(_initcap("trim(category)"))),
        },
        "orders": {
            "order_id": _sentinel("upper(trim(order_id))"),
            "customer_id": _sentinel("upper(trim(customer_id))"),
            "product_id": _sentinel("upper(trim(product_id))"),
            "order_status": _sentinel(_status(_initcap("trim(order_status)"))),
        },
    }[entity]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS raw_value, {exprs[c]} AS std_value FROM raw_{entity}" for c in cols
    )


def _rule_query(rule: str) -> str:
    entity = RULE_ENTITY[rule]
    return f"SELECT {RULE_COLUMN[rule]}, {RULE_CODES[rule]} AS error_code FROM std_{entity}"


def _csv(entity: str, cols: list[str]) -> str:
    return "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in cols) + f" FROM raw_{entity}"


_RAW_COLS = {
    "customers": ["customer_id", "customer_name", "email", "country", "lifetime_value", "signup_date"],
    "products": ["product_id", "product_name", "category", "price", "stock_qty"],
    "orders": ["order_id", "customer_id", "product_id", "quantity", "order_date", "order_status"],
}

_ETL_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {src}{where}"
    for name, src, where in [
        ("valid_customers", "val_customers", " WHERE record_status = 'Valid'"),
        ("invalid_customers", "val_customers", " WHERE record_status = 'Invalid'"),
        ("valid_products", "val_products", " WHERE record_status = 'Valid'"),
        ("invalid_products", "val_products", " WHERE record_status = 'Invalid'"),
        ("valid_orders", "val_orders", " WHERE record_status = 'Valid'"),
        ("invalid_orders", "val_orders", " WHERE record_status = 'Invalid'"),
        ("validation_summary", "validation_summary", ""),
        ("orphan_customers", "orphan_c", ""),
        ("orphan_products", "orphan_p", ""),
        ("customer_metrics", "customer_metrics", ""),
        ("product_metrics", "product_metrics", ""),
        ("sales_summary", "sales_summary", ""),
        ("dim_customers", "dim_customers", ""),
        ("dim_products", "dim_products", ""),
        ("fact_orders", "fact_orders", ""),
    ]
)

_IDS = [
    ("customers", "customer_id", "customer_id", "upper(trim(customer_id))"),
    ("products", "product_id", "product_id", "upper(trim(product_id))"),
    ("orders", "order_id", "order_id", "upper(trim(order_id))"),
    ("orders", "customer_id", "customer_id", "upper(trim(customer_id))"),
    ("orders", "product_id", "product_id", "upper(trim(product_id))"),
]


# Lines with a field too few and too many, by conditions on the raw columns.
_MALFORMED = {
    "customers": ("country = 'uk'", "country = 'es'"),
    "products": ("category = 'book'", "category = 'clothes'"),
    "orders": ("order_status = 'pending '", "order_status = 'lost'"),
}


def _malformed_lines(entity: str) -> str:
    cols = _RAW_COLS[entity]
    quoted = [f"'\"' || coalesce({c}, '') || '\"'" for c in cols]
    few, many = _MALFORMED[entity]
    return (
        f"SELECT concat_ws(',', {', '.join(quoted[:-1])}) AS line, CAST({len(cols) - 1} AS INTEGER) AS n_fields, 'TOO_FEW_FIELDS' AS error FROM raw_{entity} WHERE {few} "
        f"UNION ALL SELECT concat_ws(',', {', '.join(quoted)}, 'more'), {len(cols) + 1}, 'TOO_MANY_FIELDS' FROM raw_{entity} WHERE {many}"
    )


def _well_formed(entity: str, cols: str) -> str:
    few, many = _MALFORMED[entity]
    raw = f"raw_{entity} AS ({_fixture(entity)})"
    rest = f"raw_{entity} AS (SELECT * FROM ({_fixture(entity)}) WHERE NOT coalesce({few}, false) AND NOT coalesce({many}, false))"
    assert raw in CTES
    return f"WITH {CTES.replace(raw, rest)}\nSELECT {cols} FROM val_{entity}"


ORACLE: dict[str, str] = {
    # S1-S8
    "csv_roundtrip_customers": _with(_csv("customers", _RAW_COLS["customers"])),
    "csv_roundtrip_products": _with(_csv("products", _RAW_COLS["products"])),
    "csv_roundtrip_orders": _with(_csv("orders", _RAW_COLS["orders"])),
    "parquet_scan": _with(
        " UNION ALL ".join(
            f"SELECT '{e}' AS dataset, record_status, count(*) AS row_count FROM val_{e} GROUP BY record_status"
            for e in ("customers", "products", "orders")
        )
    ),
    "parquet_roundtrip": _with(f"SELECT {CUSTOMER_COLS} FROM val_customers"),
    "parquet_roundtrip_products": _with(f"SELECT {PRODUCT_COLS} FROM val_products"),
    "parquet_roundtrip_orders": _with(f"SELECT {ORDER_COLS} FROM val_orders"),
    "quarantine_customers": _with(f"SELECT {CUSTOMER_COLS} FROM val_customers WHERE record_status = 'Invalid'"),
    "quarantine_products": _with(f"SELECT {PRODUCT_COLS} FROM val_products WHERE record_status = 'Invalid'"),
    "quarantine_orders": _with(f"SELECT {ORDER_COLS} FROM val_orders WHERE record_status = 'Invalid'"),
    "etl_output_counts": _with(_ETL_COUNTS),
    "pipeline_output_counts": _with(_ETL_COUNTS),
    "etl_orphan_customers": _with("SELECT * FROM orphan_c"),
    "etl_orphan_products": _with("SELECT * FROM orphan_p"),
    **{
        f"etl_{t}": _with(f"SELECT * FROM {t}")
        for t in ("customer_metrics", "product_metrics", "sales_summary", "dim_customers", "dim_products", "fact_orders")
    },
    **{
        f"published_{kind}_{e}": _with(f"SELECT {cols} FROM val_{e} WHERE record_status = '{kind.title()}'")
        for kind in ("valid", "invalid")
        for e, cols in (("customers", CUSTOMER_COLS), ("products", PRODUCT_COLS), ("orders", ORDER_COLS))
    },
    **{
        f"release_{t}": _with(f"SELECT * FROM {src}")
        for t, src in (
            ("orphan_customers", "orphan_c"),
            ("orphan_products", "orphan_p"),
            *((t, t) for t in ("customer_metrics", "product_metrics", "sales_summary", "dim_customers", "dim_products", "fact_orders", "validation_summary")),
        )
    },
    "csv_malformed_lines": _with(_malformed_lines("orders")),
    "csv_malformed_lines_customers": _with(_malformed_lines("customers")),
    "csv_malformed_lines_products": _with(_malformed_lines("products")),
    **{
        f"csv_well_formed_{e}": _well_formed(e, cols) for e, cols in (("customers", CUSTOMER_COLS), ("products", PRODUCT_COLS), ("orders", ORDER_COLS))
    },
    "malformed_summary": _with(
        " UNION ALL ".join(f"SELECT '{e}' AS dataset, count(*) AS malformed_count FROM raw_{e} WHERE {few} OR {many}" for e, (few, many) in _MALFORMED.items())
    ),
    "curate_plain_processed": _with("SELECT * FROM sales_summary"),
    "csv_mixed_headers": _with(f"SELECT {CUSTOMER_COLS} FROM val_customers"),
    "csv_mixed_headers_products": _with(f"SELECT {PRODUCT_COLS} FROM val_products"),
    "csv_mixed_headers_orders": _with(f"SELECT {ORDER_COLS} FROM val_orders"),
    # P1-P13
    "std_ids": _with(_long(_IDS)),
    "std_names": _with(
        _long(
            [
                ("customers", "customer_name", "customer_name", "trim(customer_name)"),
                ("products", "product_name", "product_name", "trim(product_name)"),
            ]
        )
    ),
    "std_email": _with(_long([("customers", "email", "email", "lower(trim(email))")])),
    "std_title_case": _with(
        _long(
            [
                ("customers", "country", "country", _initcap("trim(country)")),
                ("products", "category", "category", _initcap("trim(category)")),
                ("orders", "order_status", "order_status", _initcap("trim(order_status)")),
            ]
        )
    ),
    "parse_lifetime_value": _with(
        f"SELECT lifetime_value AS raw_value, {_money('lifetime_value')} AS parsed_value FROM raw_customers"
    ),
    "parse_price": _with(f"SELECT price AS raw_value, {_money('price', usd=True)} AS parsed_value FROM raw_products"),
    "parse_stock_qty": _with(f"SELECT stock_qty AS raw_value, {_int('stock_qty')} AS parsed_value FROM raw_products"),
    "parse_quantity": _with(f"SELECT quantity AS raw_value, {_int('quantity')} AS parsed_value FROM raw_orders"),
    "parse_signup_date": _with(f"SELECT signup_date AS raw_value, {_date('signup_date')} AS parsed_value FROM raw_customers"),
    "parse_order_date": _with(f"SELECT order_date AS raw_value, {_date('order_date')} AS parsed_value FROM raw_orders"),
    "map_country": _with(_long([("customers", "country", "country", _country(_initcap("trim(country)")))])),
    "map_category": _with(_long([("products", "category", "category", _category(_initcap("trim(category)")))])),
    "map_order_status": _with(
        _long([("orders", "order_status", "order_status", _status(_initcap("trim(order_status)")))])
    ),
    "null_sentinels_customers": _with(_sentinel_query("customers")),
    "null_sentinels_products": _with(_sentinel_query("products")),
    "null_sentinels_orders": _with(_sentinel_query("orders")),
    "retype_processed": _with(f"SELECT {ORDER_COLS} FROM valid_orders"),
    "retype_customers": _with(f"SELECT {CUSTOMER_COLS} FROM valid_customers"),
    "retype_products": _with(f"SELECT {PRODUCT_COLS} FROM valid_products"),
    # V1-V18, F1
    **{rule: _with(_rule_query(rule)) for rule in RULE_CODES},
    "validate_customers": _with(f"SELECT {CUSTOMER_COLS} FROM val_customers"),
    "validate_products": _with(f"SELECT {PRODUCT_COLS} FROM val_products"),
    "validate_orders": _with(f"SELECT {ORDER_COLS} FROM val_orders"),
    "valid_customers": _with(f"SELECT {CUSTOMER_COLS} FROM valid_customers"),
    "valid_products": _with(f"SELECT {PRODUCT_COLS} FROM valid_products"),
    "valid_orders": _with(f"SELECT {ORDER_COLS} FROM valid_orders"),
    # A1-A5, U1-U2
    "validation_summary": _with("SELECT * FROM validation_summary"),
    "table_counts": _with(
        " UNION ALL ".join(f"SELECT '{e}' AS dataset, count(*) AS row_count FROM raw_{e}" for e in ("customers", "products", "orders"))
    ),
    "distinct_key_counts": _with(
        " UNION ALL ".join(
            f"SELECT '{e}' AS dataset, count(DISTINCT {k}) AS distinct_id_count FROM valid_{e}"
            for e, k in (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id"))
        )
    ),
    "duplicate_keys": _with(
        " UNION ALL ".join(
            f"SELECT '{e}' AS dataset, {k} AS key_value, count(*) AS row_count FROM valid_{e} GROUP BY {k} HAVING count(*) > 1"
            for e, k in (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id"))
        )
    ),
    "duplicate_summary_before": _with(
        _dup_summary(
            [
                ("customers", "valid_customers", "customer_id"),
                ("products", "valid_products", "product_id"),
                ("orders", "valid_orders", "order_id"),
            ]
        )
    ),
    "duplicate_summary_after": _with(
        _dup_summary(
            [
                ("customers", "dd_customers", "customer_id"),
                ("products", "dd_products", "product_id"),
                ("orders", "dd_orders", "order_id"),
            ]
        )
    ),
    # D1
    "dedup_customers": _with(f"SELECT {CUSTOMER_COLS} FROM dd_customers"),
    "dedup_products": _with(f"SELECT {PRODUCT_COLS} FROM dd_products"),
    "dedup_orders": _with(f"SELECT {ORDER_COLS} FROM dd_orders"),
    # J1-J6
    "orphan_customer_orders": _with("SELECT * FROM orphan_c"),
    "orphan_product_orders": _with("SELECT * FROM orphan_p"),
    "orders_with_customer": _with("SELECT * FROM with_c"),
    "referentially_valid_orders": _with("SELECT * FROM with_cp"),
    "enriched_orders": _with("SELECT * FROM enriched"),
    # M1-M4, K1-K4, A6-A9
    "order_amounts": _with("SELECT * FROM measured"),
    "customer_metrics": _with("SELECT * FROM customer_metrics"),
    "product_metrics": _with("SELECT * FROM product_metrics"),
    "sales_summary": _with("SELECT * FROM sales_summary"),
    "status_counts": _with(
        "SELECT count(*) AS total_orders, "
        "count(*) FILTER (WHERE order_status IN ('Completed','Shipped')) AS completed_orders, "
        "count(*) FILTER (WHERE order_status = 'Returned') AS returned_orders, "
        "count(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled_orders FROM measured"
    ),
    "fact_orders": _with("SELECT * FROM fact_orders"),
    "dim_customers": _with("SELECT * FROM dim_customers"),
    "dim_products": _with("SELECT * FROM dim_products"),
}

# The same tables after two batches as after one run.
ORACLE.update({f"batches_{q[4:]}": ORACLE[q] for q in list(ORACLE) if q.startswith("etl_") and q != "etl_output_counts"})

# The same results with the synonyms in a table.
ORACLE.update({f"{q}_table": ORACLE[q] for q in ("map_country", "map_category", "map_order_status", "validate_customers", "validate_products", "validate_orders")})


def _wide(query: str) -> str:
    """A query over the raw tables with ids of 12 digits."""
    for e in ("customers", "products", "orders"):
        query = query.replace(_fixture(e), _fixture(e, True))
    for prefix, digits in (("C", 4), ("P", 3), ("O", 5)):
        query = query.replace(f"'{prefix}[0-9]{{{digits}}}'", f"'{prefix}[0-9]{{12}}'")
    return query


ORACLE.update(
    {
        f"wide_{q}": _wide(ORACLE[o])
        for q, o in (
            ("duplicate_summary", "duplicate_summary_before"),
            *((q, q) for q in ("validation_summary", "orphan_customer_orders", "customer_metrics", "product_metrics", "sales_summary", "fact_orders")),
        )
    }
)
