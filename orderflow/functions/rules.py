"""Validation checks (V1-V17) as data, compiled to Column expressions.

A :class:`Rule` owns one column and an ordered list of checks; the first
violated check names the row's error code for that rule (the checks of one
rule are mutually exclusive). A row may collect one code per rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named violation predicate on one column."""

    code: str
    kind: str
    arg: object = None

    def violated(self, c: Column) -> Column:
        if self.kind == "missing":
            return c.isNull()
        if self.kind == "pattern":
            return ~c.rlike(str(self.arg))
        if self.kind == "below":
            return c < F.lit(self.arg)
        if self.kind == "not_in":
            return ~c.isin(*list(self.arg))  # type: ignore[arg-type]
        raise ValueError(f"unknown check kind {self.kind!r}")


def missing(code: str) -> Check:
    return Check(code, "missing")


def not_matching(code: str, regex: str) -> Check:
    """Violated when the Java regex finds no match (anchor it to match all)."""
    return Check(code, "pattern", regex)


def below(code: str, bound: int) -> Check:
    return Check(code, "below", bound)


def not_in(code: str, allowed: tuple[str, ...]) -> Check:
    return Check(code, "not_in", allowed)


@dataclass(frozen=True)
class Rule:
    """Ordered checks on one column; ``name`` is the rule's query key."""

    name: str
    column: str
    checks: tuple[Check, ...] = field(default_factory=tuple)

    def code(self, c: Column | None = None) -> Column:
        """The first violated check's code, or null when the value passes."""
        target = F.col(self.column) if c is None else c
        out = None
        for chk in self.checks:
            cond = chk.violated(target)
            out = F.when(cond, F.lit(chk.code)) if out is None else out.when(cond, F.lit(chk.code))
        return out if out is not None else F.lit(None).cast("string")

    @property
    def codes(self) -> tuple[str, ...]:
        return tuple(c.code for c in self.checks)

