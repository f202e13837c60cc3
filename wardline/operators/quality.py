"""Row rules: what is kept, and why the rest is not."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.codes import has_prefix
from wardline.vocabulary import CODE_BY_STATE


def admission_rules(stay: str = "dias_permanencia", value: str = "valor_total", date: str = "DT_INTER",
                    reject_nan: bool = False) -> dict[str, Column]:
    """Minimum quality: stay and value not negative, admission date known.

    A NULL stay or value breaks its rule. NaN counts as a large number and
    passes, unless `reject_nan`.
    """
    value_ok = F.col(value) >= 0
    return {
        "permanencia": F.col(stay) >= 0,
        "valor": value_ok & ~F.isnan(value) if reject_nan else value_ok,
        "data_internacao": F.col(date).isNotNull(),
    }


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that pass every rule."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def with_reasons(df: DataFrame, rules: Mapping[str, Column], reasons: str = "motivos") -> DataFrame:
    """Add the names of the broken rules; an empty array for a clean row."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(reasons, F.array_compact(F.array(*broken)))


def split_rules(df: DataFrame, rules: Mapping[str, Column],
                reasons: str = "motivos") -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their reasons). Together they are the input."""
    marked = with_reasons(df, rules, reasons)
    return apply_rules(df, rules), marked.filter(F.size(reasons) > 0)


def filter_code_prefix(df: DataFrame, code: str, prefixes: Iterable[str]) -> DataFrame:
    """Rows whose code starts with one of the prefixes; no prefixes, no filter."""
    prefixes = list(prefixes)
    return df.filter(has_prefix(code, prefixes)) if prefixes else df


def slice_cases(df: DataFrame, codes: Iterable[str], state: str, first_year: int, last_year: int,
                code_col: str = "cid_principal", state_col: str = "uf", year_col: str = "ano") -> DataFrame:
    """Rows of some diagnoses in one state and a span of years (inclusive).

    The tests are on plain columns, so years prune partitions and codes reach the scan.
    """
    return df.filter(F.col(code_col).isin(*codes) & (F.col(state_col) == state)
                     & F.col(year_col).between(first_year, last_year))


def in_state(code_col: str, state: str) -> Column:
    """Whether a record's state code is that of `state`; true for all if `state` is unknown."""
    expected = CODE_BY_STATE.get(state.upper())
    if expected is None:
        return F.lit(True)
    return F.coalesce(F.col(code_col).try_cast("int") == expected, F.lit(False))


def validate_state(df: DataFrame, state: str, code_col: str = "codigo_uf") -> tuple[DataFrame, DataFrame]:
    """(records of the state, one row with `aceitos` and `rejeitados`)."""
    valid = in_state(code_col, state)
    counts = df.agg(F.count_if(valid).alias("aceitos"), F.count_if(~valid).alias("rejeitados"))
    return df.filter(valid), counts


def sample_valid(df: DataFrame, state: str, n: int = 100, key: str = "codigo_cnes",
                 code_col: str = "codigo_uf") -> DataFrame:
    """At most `n` records of the state, the lowest keys first (a top-n, not a full sort)."""
    rest = [F.col(name).asc_nulls_last() for name in df.columns if name != key]
    return df.filter(in_state(code_col, state)).orderBy(F.col(key).asc_nulls_last(), *rest).limit(n)


def missing_coordinates(df: DataFrame, latitude: str = "latitude") -> DataFrame:
    """Facilities that cannot be put on a map."""
    return df.filter(F.col(latitude).isNull())


def with_coordinates(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    return df.na.drop(subset=[latitude, longitude])
