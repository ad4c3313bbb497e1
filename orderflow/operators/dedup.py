"""Keep exactly one row per business key, deterministically.

The survivor is the smallest row under a total order: the caller's columns
first (ascending, nulls first), then every remaining column in schema order
as a tie-break, so equal inputs always give equal outputs whatever the
partitioning.

Plan: ``row_number() = 1`` over the key. Spark limits each group to its first
row in every map task before the shuffle, so a hot key holding a third of all
rows costs one row per task instead of one reducer sorting all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.specs import REASON_COLUMN, STATUS_COLUMN, VALID, EntitySpec

_RANK = "__rank"
#: Marks the second row of a key (``dedup_marked``).
AGAIN = "__again"


def _order_columns(df: DataFrame, key: str, order: Sequence[str]) -> list[str]:
    unknown = [c for c in (key, *order) if c not in df.columns]
    if unknown:
        raise ValueError(f"dedup: unknown column(s) {unknown}")
    rest = [c for c in df.columns if c != key and c not in order]
    return [*order, *rest]


def dedup(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``key`` (a null key forms one group): the first in
    ``order`` (ascending, nulls first), then by all other columns.

    For ``row_number() = 1`` Spark keeps one row per key in each map task
    before the shuffle (``WindowGroupLimit``), so a hot key is no hot
    partition. Measured against a grouped minimum of the whole row, this form
    """
    return _ranked(df, key, order).where(F.col(_RANK) == 1).drop(_RANK)


def _ranked(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    fields = _order_columns(df, key, order)
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in fields])
    return df.withColumn(_RANK, F.row_number().over(w))


def dedup_marked(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`dedup` (``__again`` false), and of every key that has
    more than one row the second (``__again`` true). The rows without the mark
    are the distinct keys and those with it the repeated ones, so one pass
    gives the survivors and the duplicate summary; a key still sends two rows
    a map task at most."""
    kept = _ranked(df, key, order).where(F.col(_RANK) <= 2)
    return kept.withColumn(AGAIN, F.col(_RANK) == 2).drop(_RANK)


def dedup_valid_marked(valid: DataFrame, spec: EntitySpec) -> DataFrame:
    """:func:`dedup_marked` for the valid rows of a processed table, without the
    two verdict columns (constant on valid rows)."""
    present = [c for c in (STATUS_COLUMN, REASON_COLUMN) if c in valid.columns]
    return dedup_marked(valid.drop(*present), spec.key, spec.dedup_order)


def dedup_valid(valid: DataFrame, spec: EntitySpec) -> DataFrame:
    """D1 for the valid rows of a processed table.

    ``record_status`` is ``Valid`` and ``error_reason`` null on every such
    row, so they cannot change the survivor: they are left out of the
    shuffle (smaller rows on the largest exchange of stage 2) and put back
    as constants afterwards.
    """
    constants = {STATUS_COLUMN: F.lit(VALID), REASON_COLUMN: F.lit(None).cast("string")}
    present = [c for c in constants if c in valid.columns]
    survivors = dedup(valid.drop(*present), spec.key, spec.dedup_order)
    return survivors.select(*[constants[c].alias(c) if c in present else F.col(c) for c in valid.columns])
