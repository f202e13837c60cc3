"""From raw answers and files to Bronze. Fetching them is not part of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from wardline import schemas
from wardline.functions.dates import year_month
from wardline.operators.joins import fill_population, missing_members, restrict_to_codes
from wardline.operators.projections import canonicalize, with_typed_nulls
from wardline.operators.quality import filter_code_prefix, validate_state
from wardline.sinks.writers import land_month
from wardline.sources.harmonize import normalize_names
from wardline.sources.payloads import flatten_municipalities, flatten_population, unwrap_registry_payload


def canonical_month(raw: DataFrame, state: str, year: int, month: int, prefixes: Iterable[str] = ()) -> DataFrame:
    """A raw month in landing form: known columns, one type each, wanted diagnoses only, with its partition keys."""
    rows = canonicalize(normalize_names(raw, schemas.ADMISSIONS.names))
    keys = {"uf": F.lit(state), "ano_mes": year_month(F.lit(year), F.lit(month))}
    return filter_code_prefix(rows, "DIAG_PRINC", prefixes).withColumns(keys)


def land_admissions(raw: DataFrame, root: str, state: str, year: int, month: int,
                    prefixes: Iterable[str] = ()) -> None:
    """Land one month of one state. Landing it again replaces it; a month without rows writes nothing."""
    land_month(canonical_month(raw, state, year, month, prefixes), root)


def municipality_reference(localities: DataFrame, statistics: DataFrame, state: str, fallback_population: int,
                           order: str | None = None) -> DataFrame:
    """Municipality reference of one state from locality and population answers.

    `is_estimated` marks the municipalities that got the fallback population.
    Bed targets come from neither source and stay NULL.
    """
    places = flatten_municipalities(localities, state)
    filled = fill_population(places, flatten_population(statistics, order=order), fallback_population)
    no_targets = T.StructType([schemas.MUNICIPALITIES["meta_leitos_1000hab"]])
    return with_typed_nulls(filled, no_targets).select(*schemas.MUNICIPALITIES.names, "is_estimated")


def registry_of_state(answers: DataFrame, state: str) -> tuple[DataFrame, DataFrame]:
    """(records of the state, counts of accepted and rejected) from registry pages."""
    return validate_state(unwrap_registry_payload(answers), state)


def registry_of_codes(answers: DataFrame, codes: DataFrame, state: str) -> tuple[DataFrame, DataFrame]:
    """(records found for the code list, codes not found) from single lookups.

    A record of another state counts as not found.
    """
    records, _ = validate_state(unwrap_registry_payload(answers, single=True), state)
    found = restrict_to_codes(records, codes, "codigo_cnes")
    return found, missing_members(codes.select(F.col(codes.columns[0]).alias("codigo_cnes")), found, "codigo_cnes")
