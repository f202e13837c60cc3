"""Lookups on coded values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from wardline import vocabulary as V


def state_abbrev(code: Column | str) -> Column:
    """State abbreviation of a numeric code; unknown and NULL codes give NULL."""
    code = F.col(code) if isinstance(code, str) else code
    entries = ", ".join(f"{number}, '{state}'" for number, state in V.STATE_BY_CODE.items())
    return F.expr(f"map({entries})")[code]


def is_hospital_type(code: Column | str, types: Iterable[int] = V.HOSPITAL_TYPES) -> Column:
    """Whether a facility type is a hospital; NULL for a NULL type."""
    code = F.col(code) if isinstance(code, str) else code
    return code.isin(*types)


def has_prefix(code: Column | str, prefixes: Iterable[str]) -> Column:
    """Case-insensitive test for any of the prefixes. A NULL code has none of them."""
    code = F.upper(F.col(code) if isinstance(code, str) else code)
    test = F.lit(False)
    for prefix in prefixes:
        test = test | code.startswith(prefix.upper())
    return F.coalesce(test, F.lit(False))


def split_code_list(text: str | None) -> list[str]:
    """Codes from a comma-separated option, without blanks around or between them."""
    return [item.strip() for item in (text or "").split(",") if item.strip()]
