"""Referential integrity.

``orphans`` / ``with_parent`` are the plain anti / semi joins. ``tag_parents``
answers all of them with one left join per parent: each parent is projected
to its key (plus any attributes wanted downstream) and a presence flag, so
orders are joined once per parent instead of once per question (the four
anti/semi joins plus two enrichment joins collapse into two joins).

Parents must be unique on their key (they are deduplicated first), so a left
join never multiplies order rows. No broadcast is forced: Spark broadcasts a
parent only when its measured size is under ``autoBroadcastJoinThreshold``
(statically, or at runtime with AQE), otherwise it shuffles both sides on the
key, and AQE splits a skewed order partition (a hot customer) across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose ``key`` has no parent (key column first)."""
    return child.join(parent.select(key), on=key, how="left_anti")


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose ``key`` has a parent (key column first)."""
    return child.join(parent.select(key), on=key, how="left_semi")


def presence_flag(key: str) -> str:
    return f"has_{key}"


def tag_parents(child: DataFrame, parents: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left-join each ``(parent, key, attrs)`` once; adds ``attrs`` and a
    boolean ``has_<key>``. Child columns keep their order."""
    out = child
    flags = []
    for parent, key, attrs in parents:
        flag = presence_flag(key)
        right = parent.select(F.col(key), *[F.col(a) for a in attrs], F.lit(True).alias(flag))
        out = out.join(right, on=key, how="left")
        flags.append(flag)
    attr_cols = [a for _, _, attrs in parents for a in attrs]
    return out.select(
        *[F.col(c) for c in child.columns],
        *[F.col(a) for a in attr_cols],
        *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags],
    )


def key_first(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The column order a USING join gives: ``key`` then the others."""
    return df.select(key, *[c for c in columns if c != key])
