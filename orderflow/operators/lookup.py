"""P9-P11 from a table: value maps of any size.

A handful of synonyms is a CASE expression (``standardize.map_values``). A map
that is a table itself is joined. Up to a bound on its measured size Spark may
broadcast it (by ``autoBroadcastJoinThreshold``, like any dimension); beyond it
the join is a sort-merge join on the value whatever the estimates say, in which
AQE splits a frequent value (or the nulls) across tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VARIANT, CANONICAL = "variant", "canonical"
#: Measured bytes up to which a lookup table may be broadcast.
MAX_BROADCAST_BYTES = 64 << 20
#: What a row of a broadcast table takes besides its text.
ROW_BYTES = 64
_KEY, _VALUE, _TO = "__lookup_key", "__lookup_value", "__lookup_to"


def lookup_table(spark: SparkSession, synonyms: Mapping[str, Iterable[str]]) -> DataFrame:
    """``variant, canonical`` rows of a synonym map. They are expressions: Spark
    knows that they are few, whereas it has no estimate for a table made of
    driver rows and would shuffle the other side by its few values first."""
    rows = [F.struct(F.lit(variant).alias(VARIANT), F.lit(canonical).alias(CANONICAL)) for canonical, variants in synonyms.items() for variant in variants]
    if not rows:
        return spark.createDataFrame([], f"{VARIANT} string, {CANONICAL} string")
    return spark.range(1).select(F.inline(F.array(*rows)))


def measured_bytes(lookup: DataFrame) -> int:
    """Size of a lookup table in memory, computed from its rows."""
    text = F.octet_length(VARIANT) + F.coalesce(F.octet_length(CANONICAL), F.lit(0))
    return lookup.agg(F.coalesce(F.sum(text + F.lit(ROW_BYTES)), F.lit(0))).first()[0]


def map_from_table(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    *,
    key: Callable[[Column], Column] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the values of ``column`` replaced by the ``canonical`` of the
    ``variant`` they equal (after ``key``, e.g. ``F.upper``); other values and
    nulls pass through, and columns keep their order.

    Of several rows for a variant the least canonical counts; a null variant
    matches nothing, a null canonical changes nothing."""
    pairs = lookup.where(F.col(VARIANT).isNotNull() & F.col(CANONICAL).isNotNull())
    pairs = pairs.groupBy(VARIANT).agg(F.min(CANONICAL).alias(CANONICAL))
    small = measured_bytes(pairs) <= max_broadcast_bytes
    right = pairs.select(F.col(VARIANT).alias(_VALUE), F.col(CANONICAL).alias(_TO))
    right = right if small else right.hint("merge")
    value = F.col(f"`{column}`")
    keyed = df.withColumn(_KEY, key(value) if key is not None else value)
    joined = keyed.join(right, F.col(_KEY) == F.col(_VALUE), "left")
    return joined.select(*[F.coalesce(F.col(_TO), value).alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])
