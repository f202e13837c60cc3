"""Ratios, rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: What 28 digits hold; greater doubles are no amounts of cents anyway.
_MOST_CENTS = 1e27


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pct_change(current: Column | str, previous: Column | str) -> Column:
    """Change against `previous` in percent; NULL unless `previous` is positive."""
    current, previous = _column(current), _column(previous)
    return F.when(previous > 0, (current - previous) / previous * 100)


def per_thousand(amount: Column | str, population: Column | str) -> Column:
    """`amount` per 1000 inhabitants; NULL when the population is 0 or unknown."""
    return _column(amount).cast("double") / F.nullif(_column(population), F.lit(0)) * 1000


def round_tenth(value: Column | str) -> Column:
    """One decimal, ties to even (numpy's rounding, which `round` is not)."""
    return F.rint(_column(value) * 10) / 10


def one_if_zero(value: Column | str) -> Column:
    """Divisor guard: 0 becomes 1, everything else stays."""
    value = _column(value)
    return F.when(value == 0, F.lit(1)).otherwise(value)


def clip(value: Column | str, low: float, high: float) -> Column:
    value = _column(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def as_integer(value: Column | str) -> Column:
    """64-bit integer from a number or numeric text (`12`, `12.0`); NULL for the rest."""
    value = _column(value)
    number = value.try_cast("double")
    return F.coalesce(F.when(number == F.rint(number), F.coalesce(value.cast("string").try_cast("bigint"),
                                                                  number.try_cast("bigint"))))


# Money is added up as whole cents wherever an amount is one: decimal sums do not depend on the order rows arrive in,
# so a report gives the same value on any number of partitions, and 38 digits hold any number of rows. All other values
# (more than two decimals, NaN, infinities) are added as the doubles they are, so nothing is rounded before the sum.

def _whole(money: Column) -> Column:
    """The cents of an amount that is the double nearest to a number of whole cents; NULL for any other."""
    hundred = F.rint(money * 100)
    return F.when((hundred / 100 == money) & (F.abs(hundred) < _MOST_CENTS), hundred)


def cents(money: Column | str) -> Column:
    return _whole(_column(money).cast("double")).cast("decimal(28,0)")


def odd_money(money: Column | str) -> Column:
    money = _column(money).cast("double")
    return F.when(_whole(money).isNull(), money)


def money_total(cents_sum: Column, odd_sum: Column) -> Column:
    """Double total from a sum of `cents` and a sum of `odd_money`; NULL if there was nothing."""
    whole = cents_sum.cast("double") / 100
    return F.when(odd_sum.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + odd_sum)


def money_sum(money: Column | str) -> Column:
    """Aggregate: sum of a money column, exact for amounts of whole cents."""
    return money_total(F.sum(cents(money)), F.sum(odd_money(money)))


def format_thousands(value: Column | str, decimals: int = 0) -> Column:
    """Number as text with `.` between thousands and `,` before decimals."""
    return F.translate(F.format_number(_column(value), decimals), ",.", ".,")


def format_money(value: Column | str) -> Column:
    """Whole reais as they are shown: `R$ 1.234`."""
    return F.concat(F.lit("R$ "), format_thousands(value))


def format_of_hundred(value: Column | str) -> Column:
    """An index as it is shown: `55.1 / 100`."""
    return F.concat(F.format_number(_column(value), 1), F.lit(" / 100"))
