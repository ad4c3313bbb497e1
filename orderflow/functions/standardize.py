"""Column -> Column standardisers.

Every function here builds a Catalyst expression from built-in functions, so
it stays inside whole-stage codegen and works unchanged on batch and streaming
DataFrames. Nothing is evaluated in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnFn = Callable[[Column], Column]


def normalize_id(c: Column) -> Column:
    """Business ids are compared trimmed and upper case."""
    return F.upper(F.trim(c))


def trim_text(c: Column) -> Column:
    """Free text keeps its case; only blanks (U+0020) are trimmed."""
    return F.trim(c)


def normalize_email(c: Column) -> Column:
    """E-mail addresses are trimmed and lower case."""
    return F.lower(F.trim(c))


def title_case(c: Column) -> Column:
    """Trimmed, every blank-separated word capitalised, the rest lower."""
    return F.initcap(F.trim(c))


def strip_chars(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def parse_decimal(
    c: Column,
    *,
    precision: int = 12,
    scale: int = 2,
    remove: Iterable[str] = (r"\$", ","),
) -> Column:
    """Trim, delete every match of each ``remove`` regex in turn, then
    ``try_cast`` to ``decimal(precision, scale)`` (HALF_UP, overflow -> null)."""
    out = F.trim(c)
    for pattern in remove:
        out = strip_chars(out, pattern)
    return out.try_cast(f"decimal({precision},{scale})")


def parse_int(c: Column) -> Column:
    """Strict integer text -> int; anything else (12.0, 1e2, 12L,
    overflow) -> null. Surrounding whitespace and a sign are accepted."""
    return c.try_cast("int")


def _fixed_prefix_literals(fmt: str) -> list[tuple[int, str]]:
    """1-based positions of the literal characters a datetime pattern puts
    before its first variable-width field (``dd`` and ``MM`` are exactly two
    digits; ``yyyy`` and anything else end the fixed prefix)."""
    out, pos, i = [], 1, 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            break  # quoted text: stop guarding here
        if ch.isalpha():
            j = i
            while j < len(fmt) and fmt[j] == ch:
                j += 1
            if fmt[i:j] not in ("dd", "MM"):
                break
            pos, i = pos + (j - i), j
        else:
            out.append((pos, ch))
            pos, i = pos + 1, i + 1
    return out


def parse_date(c: Column, formats: Iterable[str]) -> Column:
    """First format that parses the trimmed text wins; none -> null.

    Each format is tried only where its fixed separators sit at the right
    positions. Any text the parser could accept passes that guard, so the
    result is unchanged, but text in another format no longer goes through
    the parser's (slow, exception-based) failure path.
    """
    trimmed = F.trim(c)
    parsed = []
    for fmt in formats:
        guard = None
        for pos, lit in _fixed_prefix_literals(fmt):
            cond = F.substring(trimmed, pos, 1) == F.lit(lit)
            guard = cond if guard is None else guard & cond
        attempt = F.try_to_date(trimmed, fmt)
        parsed.append(attempt if guard is None else F.when(guard, attempt))
    return F.coalesce(*parsed)


def map_values(
    c: Column,
    synonyms: Mapping[str, Iterable[str]],
    *,
    key: ColumnFn | None = None,
) -> Column:
    """Replace any listed variant by its canonical value; other values
    pass through. ``key`` (e.g. ``F.upper``) is applied to the value before it
    is compared with the variants.

    The mapping is a handful of literals, so a CASE expression (no join, no
    shuffle) is the right plan; for a mapping with thousands of entries see
    :func:`orderflow.operators.lookup.map_from_table`.
    """
    probe = key(c) if key is not None else c
    out = None
    for canonical, variants in synonyms.items():
        cond = probe.isin(*list(variants))
        out = F.when(cond, F.lit(canonical)) if out is None else out.when(cond, F.lit(canonical))
    return c if out is None else out.otherwise(c)


def null_sentinels(c: Column, sentinels: Iterable[str]) -> Column:
    """Null for null, the empty string, or an exact sentinel match."""
    return F.when(F.coalesce(c, F.lit("")).isin("", *list(sentinels)), F.lit(None)).otherwise(c)
