"""Single-pass summaries.

Each summary is an aggregate DataFrame: per-table aggregates are global (one
partial aggregate per task, one tiny merge) and the per-table rows are
combined with ``unionByName``. The one exception is
``validation_summary_from_counts``: stage 1 observes its counts while
writing, so it only turns those three bounded sets of counts into rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.specs import INVALID, STATUS_COLUMN, VALID


def union_all(frames: list[DataFrame]) -> DataFrame:
    """``unionByName`` of several frames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def status_counts_exprs() -> list[Column]:
    """Total / valid / invalid counts of a validated table."""
    status = F.col(STATUS_COLUMN)
    return [
        F.count(F.lit(1)).alias("Total_count"),
        F.count_if(status == VALID).alias("Valid_count"),
        F.count_if(status == INVALID).alias("Invalid_count"),
    ]


def invalid_percentage(total: Column, invalid: Column) -> Column:
    """``invalid * 100 / total`` as a double, 0.0 for an empty table."""
    return F.when(total > 0, invalid.cast("double") * F.lit(100.0) / total).otherwise(F.lit(0.0))


def validation_summary(validated: Mapping[str, DataFrame]) -> DataFrame:
    """Dataset, Total_count, Valid_count, Invalid_count,
    Invalid_percentage; one row per entity."""
    rows = []
    for name, df in validated.items():
        counts = df.agg(*status_counts_exprs())
        rows.append(
            counts.select(
                F.lit(name).alias("Dataset"),
                "Total_count",
                "Valid_count",
                "Invalid_count",
                invalid_percentage(F.col("Total_count"), F.col("Invalid_count")).alias("Invalid_percentage"),
            )
        )
    return union_all(rows)


def validation_summary_from_counts(spark, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """A1 from counts observed while writing (three rows, built on the driver
    from bounded scalars)."""
    data = []
    for name, c in counts.items():
        total, invalid = int(c["Total_count"]), int(c["Invalid_count"])
        pct = invalid * 100.0 / total if total else 0.0
        data.append((name, total, int(c["Valid_count"]), invalid, pct))
    schema = "Dataset string, Total_count bigint, Valid_count bigint, Invalid_count bigint, Invalid_percentage double"
    return spark.createDataFrame(data, schema)


def duplicate_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Dataset, total_count, distinct_id_count, duplicate_id_count.

    One ``groupBy(key)`` per table (partial aggregation before the shuffle),
    then a global aggregate over the per-key counts. ``distinct_id_count``
    ignores a null key; ``duplicate_id_count`` counts keys (a null key is one
    group) that occur more than once.
    """
    rows = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        rows.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_count"),
                F.count(key).alias("distinct_id_count"),
                F.count_if(F.col("n") > 1).alias("duplicate_id_count"),
            ).select(F.lit(name).alias("dataset"), "total_count", "distinct_id_count", "duplicate_id_count")
        )
    return union_all(rows)


def duplicate_summaries_from_marks(tables: Mapping[str, tuple[DataFrame, str, int]], mark: str) -> tuple[DataFrame, DataFrame]:
    """A4/U2 before and after deduplication, from ``(marked rows, key, rows
    before)`` of each table: unmarked rows are its distinct keys, marked ones
    its repeated keys (``dedup.dedup_marked``)."""
    rows = []
    for name, (df, key, total) in tables.items():
        first = ~F.col(mark)
        counts = df.agg(
            F.count_if(first & F.col(key).isNotNull()).alias("distinct_id_count"), F.count_if(F.col(mark)).alias("duplicate_id_count"), F.count_if(first).alias("survivors")
        )
        rows.append(counts.select(F.lit(name).alias("dataset"), F.lit(total).cast("bigint").alias("total_count"), "distinct_id_count", "duplicate_id_count", "survivors"))
    both = union_all(rows)
    after = both.select("dataset", F.col("survivors").alias("total_count"), "distinct_id_count", F.lit(0).cast("bigint").alias("duplicate_id_count"))
    return both.drop("survivors"), after


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2: dataset, row_count."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("dataset"), "row_count") for n, df in tables.items()]
    )


def distinct_key_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """A3: dataset, distinct_id_count (nulls not counted)."""
    return union_all(
        [
            df.agg(F.count_distinct(key).alias("distinct_id_count")).select(F.lit(n).alias("dataset"), "distinct_id_count")
            for n, (df, key) in tables.items()
        ]
    )


def duplicate_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """A5/F2: dataset, key_value, row_count for every key seen more than once."""
    return union_all(
        [
            df.groupBy(df[key].alias("key_value"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1)
            .select(F.lit(n).alias("dataset"), "key_value", "row_count")
            for n, (df, key) in tables.items()
        ]
    )
