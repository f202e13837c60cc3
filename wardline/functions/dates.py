"""Dates, calendar columns and month keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two layouts admission dates arrive in.
ISO_SHAPE = r"\A\d{4}-\d{2}-\d{2}\z"
COMPACT_SHAPE = r"\A\d{8}\z"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_mixed_date(value: Column | str) -> Column:
    """Date from `yyyy-MM-dd` or `yyyyMMdd` text; any other text, or an impossible date, gives NULL.

    Both layouts end in one cast of ISO text, which costs a fraction of parsing by pattern.
    """
    text = _column(value).cast("string")
    spelled = F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    return F.when(text.rlike(ISO_SHAPE), text).when(text.rlike(COMPACT_SHAPE), spelled).try_cast("date")


def iso_date(value: Column | str) -> Column:
    """Date from `yyyy-MM-dd` text, NULL when the text is something else."""
    return F.try_to_date(_column(value).cast("string"), "yyyy-MM-dd")


def with_calendar(df: DataFrame, date_col: str, year: str = "ano", month: str = "mes",
                  week: str = "semana_epidemiologica") -> DataFrame:
    """Add year, month and ISO week. The week name is the table's; the numbering is ISO 8601."""
    day = F.col(date_col)
    return df.withColumns({year: F.year(day), month: F.month(day), week: F.weekofyear(day)})


def quarter_of(month: Column | str) -> Column:
    return ((_column(month) - 1) / 3 + 1).cast("int")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_column(year), _column(month), F.lit(1))


def year_month(year: Column | str, month: Column | str) -> Column:
    """`AAAAMM` partition key."""
    return F.format_string("%d%02d", _column(year), _column(month))
