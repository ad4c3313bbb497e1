"""Standardise + validate an entity.

``standardize`` is a short chain of projections (one per step of the
fields) and ``validate`` adds the verdict: every rule contributes a nullable
code, the codes are joined with ``;`` in rule order, and ``record_status``
follows from whether any code fired. All of it is narrow (no shuffle) and
row-wise, so it pipelines with the scan inside one whole-stage-codegen stage
and works on streaming DataFrames as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions import standardize as S
from orderflow.operators.lookup import map_from_table
from orderflow.specs import INVALID, REASON_COLUMN, STATUS_COLUMN, VALID, EntitySpec


def _name_key(df: DataFrame) -> Callable[[str], str]:
    """How the session compares column names."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda name: name) if sensitive else str.lower


def _check_columns(df: DataFrame, spec: EntitySpec) -> None:
    key = _name_key(df)
    present = {key(c) for c in df.columns}
    missing = [c for c in spec.raw_columns if key(c) not in present]
    if missing:
        raise ValueError(f"{spec.name}: missing required column(s) {missing}; got {df.columns}")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def standardize(df: DataFrame, spec: EntitySpec, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Apply every field of ``spec``. ``lookups`` gives synonyms of a field as
    a table (``lookup.map_from_table``) in place of those of the spec; this
    joins, so it is for tables that a CASE expression cannot hold.

    In-place fields keep their position; derived fields are appended in spec
    order; columns the spec does not mention pass through unchanged.

    The three steps of a field (normalise, synonyms, sentinels) are separate
    projections over named intermediates: a later step refers to the value
    several times, and Catalyst keeps a non-trivial intermediate in its own
    projection (computed once per row) instead of inlining it at every
    reference. The projections still fuse into one codegen stage.
    """
    _check_columns(df, spec)
    lookups = lookups or {}
    if unknown := sorted(set(lookups) - {f.name for f in spec.fields}):
        raise ValueError(f"{spec.name}: lookups for unknown field(s) {unknown}")
    tmp = {f.name: f"__std_{i}" for i, f in enumerate(spec.fields)}
    passthrough = [_col(c) for c in df.columns]
    step = df.select(*passthrough, *[f.expr("normalize", _col(f.raw)).alias(tmp[f.name]) for f in spec.fields])
    step = step.select(
        *passthrough,
        *[
            (S.map_values(_col(tmp[f.name]), f.synonyms, key=f.synonym_key) if f.synonyms and f.name not in lookups else _col(tmp[f.name])).alias(tmp[f.name])
            for f in spec.fields
        ],
    )
    for f in spec.fields:
        if f.name in lookups:
            step = map_from_table(step, tmp[f.name], lookups[f.name], key=f.synonym_key)
    step = step.select(
        *passthrough,
        *[(S.null_sentinels(_col(tmp[f.name]), f.sentinels) if f.sentinels is not None else _col(tmp[f.name])).alias(tmp[f.name]) for f in spec.fields],
    )
    # Like withColumn: a field replaces a same-named column where it stands,
    # otherwise it is appended.
    key = _name_key(df)
    by_name = {key(f.name): f for f in spec.fields}
    cols: list[Column] = []
    for c in df.columns:
        f = by_name.get(key(c))
        cols.append(_col(tmp[f.name]).cast(f.dtype).alias(f.name) if f else _col(c))
    present = {key(c) for c in df.columns}
    cols.extend(_col(tmp[f.name]).cast(f.dtype).alias(f.name) for f in spec.fields if key(f.name) not in present)
    return step.select(*cols)


def error_reason(spec: EntitySpec) -> Column:
    """``;``-joined codes of every violated rule in rule order, or null."""
    joined = F.concat_ws(";", *[r.code() for r in spec.rules])
    return F.nullif(joined, F.lit(""))


def validate_standardized(df: DataFrame, spec: EntitySpec) -> DataFrame:
    reason_tmp = "__error_reason"
    with_reason = df.select("*", error_reason(spec).alias(reason_tmp))
    reason = F.col(reason_tmp)
    verdict = {
        STATUS_COLUMN: F.when(reason.isNull(), F.lit(VALID)).otherwise(F.lit(INVALID)).alias(STATUS_COLUMN),
        REASON_COLUMN: reason.alias(REASON_COLUMN),
    }
    # Like withColumn: an existing record_status / error_reason is replaced
    # where it stands; otherwise both are appended.
    key = _name_key(df)
    out_cols = [verdict.get(key(c), _col(c)) for c in df.columns]
    present = {key(c) for c in df.columns}
    out_cols.extend(verdict[c] for c in (STATUS_COLUMN, REASON_COLUMN) if c not in present)
    return with_reason.select(*out_cols)


def validate(df: DataFrame, spec: EntitySpec, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Raw all-string rows -> standardised rows + ``record_status`` +
    ``error_reason``. ``lookups``: see :func:`standardize`."""
    return validate_standardized(standardize(df, spec, lookups), spec)


def rule_codes(df: DataFrame, spec: EntitySpec, rule_name: str) -> DataFrame:
    """V1-V17 one at a time: the rule's column and its code (null = passes)."""
    rule = spec.rule(rule_name)
    return standardize(df, spec).select(F.col(rule.column), rule.code().alias("error_code"))


def valid_rows(validated: DataFrame) -> DataFrame:
    """rows every rule accepted."""
    return validated.where(F.col(STATUS_COLUMN) == VALID)


def invalid_rows(validated: DataFrame) -> DataFrame:
    """rows at least one rule rejected (the quarantine)."""
    return validated.where(F.col(STATUS_COLUMN) == INVALID)
