"""Messy raw inputs derived from the test tables.

The reproduced jobs read three untyped CSV tables (customers, products,
orders). No sample data exists for them, so the raw tables are derived from
the TPC-H-like test tables by portable SQL that plants every kind of defect
the rules look for (blanks, sentinels, bad formats, negative values,
duplicate keys, orphan references). The same text runs in Spark SQL (over
the parquet files, passed as DataFrame parameters, so no temp view is
registered) and in DuckDB (as a CTE of the oracle), which keeps the inputs of
both engines identical.

Every raw column is a string, as if read from CSV with ``inferSchema=False``.
The derivation is a projection of ``customer``/``part`` and one equi-join
``lineitem`` x ``orders`` on the order key, so it grows linearly with the
scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Placeholders in braces name the source tables.
RAW_CUSTOMERS_SQL = """
select
 case when k%29=0 then null when k%31=0 then 'n/a' when k%37=0 then 'X'||lpad(cast(ek % 10000 as string),4,'0') when k%5=0 then ' c'||lpad(cast(ek % 10000 as string),4,'0')||' ' else 'C'||lpad(cast(ek % 10000 as string),4,'0') end as customer_id,
 case when k%41=0 then 'NA' when k%43=0 then '' when k%7=0 then '  '||nm||' ' else nm end as customer_name,
 case when k%47=0 then null when k%53=0 then 'NA' when k%59=0 then 'user'||cast(k as string)||'.mail.com' else ' User_'||cast(k as string)||'@Mail.COM' end as email,
 case when k%61=0 then null when k%10=0 then 'in' when k%10=1 then 'BHARAT' when k%10=2 then ' usa ' when k%10=3 then 'U.S.A' when k%10=4 then 'uk' when k%10=5 then 'great britain' when k%10=6 then 'es' when k%10=7 then 'na' else nation end as country,
 case when k%67=0 then 'abc' when k%3=0 and bal>=1000 then '$'||substr(b,1,length(b)-6)||','||substr(b,length(b)-5) when k%3=1 then ' $'||b else b end as lifetime_value,
 case when k%71=0 then '2024-01-15' when k%73=0 then '31/02/2024' when k%2=0 then lpad(cast(1+k%28 as string),2,'0')||'-'||lpad(cast(1+k%12 as string),2,'0')||'-'||cast(2018+k%6 as string) else lpad(cast(1+k%28 as string),2,'0')||'/'||lpad(cast(1+k%12 as string),2,'0')||'/'||cast(2018+k%6 as string) end as signup_date
 from (select c_custkey as k, case when c_custkey%23=1 and c_custkey>1 then c_custkey-1 else c_custkey end as ek, c_name as nm, n_name as nation, c_acctbal as bal, cast(cast(c_acctbal as decimal(12,2)) as string) as b from {customer} join {nation} on c_nationkey=n_nationkey) t
"""

RAW_PRODUCTS_SQL = """
select
 case when k%83=0 then null when k%89=0 then 'Q'||lpad(cast(ek % 1000 as string),3,'0') when k%5=0 then ' p'||lpad(cast(ek % 1000 as string),3,'0')||' ' else 'P'||lpad(cast(ek % 1000 as string),3,'0') end as product_id,
 case when k%79=0 then 'N/A' when k%7=0 then ' '||nm else nm end as product_name,
 case when k%73=0 then null when k%8=0 then 'electronic' when k%8=1 then 'SPORT' when k%8=2 then 'clothes' when k%8=3 then 'book' when k%8=4 then ' home ' when k%8=5 then 'home & kitchen' when k%8=6 then 'na' else ty end as category,
 case when k%71=0 then 'abc' when k%67=0 then '-'||b when k%4=0 then '$'||b when k%4=1 then b||' USD' when k%4=2 then '$1,'||lpad(b,6,'0')||'USD ' else b end as price,
 case when k%61=0 then null when k%59=0 then '-3' when k%53=0 then '12L' else cast(sz as string) end as stock_qty
 from (select p_partkey as k, case when p_partkey%23=1 and p_partkey>1 then p_partkey-1 else p_partkey end as ek, p_name as nm, p_type as ty, p_size as sz, cast(cast(p_retailprice as decimal(12,2)) as string) as b from {part}) t
"""

RAW_ORDERS_SQL = """
select
 case when k%103=0 then null when k%107=0 then 'Z'||lpad(cast(k % 100000 as string),5,'0') when k%5=0 then ' o'||lpad(cast(k % 100000 as string),5,'0') else 'O'||lpad(cast(k % 100000 as string),5,'0') end as order_id,
 case when k%109=0 then 'NULL' when k%113=0 then 'C99' when k%127=0 then 'C9999' else 'C'||lpad(cast(ck % 10000 as string),4,'0') end as customer_id,
 case when pk%131=0 then '' when pk%137=0 then 'PX12' else ' p'||lpad(cast(pk % 1000 as string),3,'0') end as product_id,
 case when (k+ln)%101=0 then null when (k+ln)%97=0 then '0' when (k+ln)%89=0 then 'two' else cast(cast(q as int) as string) end as quantity,
 case when k%83=0 then substr(od,1,10) when ln%2=0 then substr(od,9,2)||'-'||substr(od,6,2)||'-'||substr(od,1,4) else ' '||substr(od,9,2)||'/'||substr(od,6,2)||'/'||substr(od,1,4) end as order_date,
 case when (k+pk)%79=0 then null when (k+pk)%73=0 then 'na' when (k+pk)%71=0 then 'lost' when rf='R' then 'RETURNED' when rf='A' and ls='F' then ' shipped' when rf='A' then 'canceled' when ls='F' then 'pending ' else 'completed' end as order_status
 from (select l_orderkey as k, l_linenumber as ln, l_partkey as pk, o_custkey as ck, l_quantity as q, l_returnflag as rf, l_linestatus as ls, cast(cast(o_orderdate as date) as string) as od from {lineitem} join {orders} on l_orderkey=o_orderkey) t
"""

RAW_SQL = {
    "customers": (RAW_CUSTOMERS_SQL, ("customer", "nation")),
    "products": (RAW_PRODUCTS_SQL, ("part",)),
    "orders": (RAW_ORDERS_SQL, ("lineitem", "orders")),
}

#: How ids wrap in the tables above, and the same ids in 12 digits that do not:
#: every order line of every order is then an order of its own key.
WIDE_IDS = {
    "lpad(cast(ek % 10000 as string),4,'0')": "lpad(cast(ek as string),12,'0')",
    "lpad(cast(ek % 1000 as string),3,'0')": "lpad(cast(ek as string),12,'0')",
    "lpad(cast(k % 100000 as string),5,'0')": "lpad(cast(k * 8 + ln as string),12,'0')",
    "lpad(cast(ck % 10000 as string),4,'0')": "lpad(cast(ck as string),12,'0')",
    "lpad(cast(pk % 1000 as string),3,'0')": "lpad(cast(pk as string),12,'0')",
    "'C9999'": "'C999999999999'",
}

#: Rows whose CSV line lacks its last field, and rows whose line has one more
#: (portable conditions on the raw columns).
MALFORMED_SQL = {
    "customers": ("coalesce(country = 'uk', false)", "coalesce(country = 'es', false)"),
    "products": ("coalesce(category = 'book', false)", "coalesce(category = 'clothes', false)"),
    "orders": ("coalesce(order_status = 'pending ', false)", "coalesce(order_status = 'lost', false)"),
}

# Columns each source table contributes (so the parquet scan reads only them).
_SOURCE_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
    "nation": ("n_nationkey", "n_name"),
    "part": ("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"),
    "lineitem": ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
}

#: The tables that the raw ones grow with (one file may be one row group, which
#: one task reads) are dealt out by these keys before anything is derived: their
#: few columns take less than the text made of them, and the lines come dealt as
#: their join needs them.
_DEALT_BY = {"customer": "c_custkey", "part": "p_partkey", "lineitem": "l_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql(entity: str, wide: bool) -> str:
    sql = RAW_SQL[entity][0]
    for narrow, own in WIDE_IDS.items() if wide else ():
        sql = sql.replace(narrow, own)
    return sql


def raw_table(spark: SparkSession, sf_dir: str, entity: str, wide: bool = False) -> DataFrame:
    """The messy all-string raw table for ``entity``; ``wide``: with ids of 12
    digits that do not wrap."""
    sql, sources = _sql(entity, wide), RAW_SQL[entity][1]
    frames = {s: table(spark, sf_dir, s).select(*_SOURCE_COLUMNS[s]) for s in sources}
    dealt = {s: df.hint("rebalance", _DEALT_BY[s]) if s in _DEALT_BY else df for s, df in frames.items()}
    return spark.sql(sql, **dealt)


def oracle_sql(entity: str, wide: bool = False) -> str:
    """The same derivation for DuckDB over the pre-registered views."""
    sql, sources = _sql(entity, wide), RAW_SQL[entity][1]
    return sql.format(**{s: s for s in sources})
