"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline import schemas
from wardline.functions.casts import lenient_cast
from wardline.functions.codes import is_hospital_type, state_abbrev
from wardline.functions.dates import iso_date, parse_mixed_date, with_calendar
from wardline.operators.dedup import dedup_any, latest_by
from wardline.operators.quality import admission_rules, apply_rules

# Source name -> table name.
ADMISSION_NAMES = {
    "CNES": "cnes_id",
    "DIAG_PRINC": "cid_principal",
    "MUNIC_MOV": "municipio_id",
    "UF_ZI": "uf_residencia_paciente",
    "VAL_TOT": "valor_total",
    "DIAS_PERM": "dias_permanencia",
}
REGISTRY_NAMES = {
    "codigo_cnes": "cnes_id",
    "nome_fantasia": "nome_estabelecimento",
    "latitude_estabelecimento_decimo_grau": "latitude",
    "longitude_estabelecimento_decimo_grau": "longitude",
    "estabelecimento_possui_atendimento_hospitalar": "possui_atendimento_hospitalar",
}

# Which copy of an admission stays: the reading order of its main columns, then all others.
COPY_ORDER = ["DT_INTER", "DIAS_PERM", "VAL_TOT", "CNES", "DIAG_PRINC"]


def typed_admissions(bronze: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Deduplicated admissions with final names, types and parsed dates, before any row rule.

    Copies are removed first, over all months and states: a row rule applied
    before would let the other copy of a rejected admission through.
    """
    types = dict((f.name, f.dataType) for f in bronze.schema.fields)
    narrow = {name: lenient_cast(F.col(name), types[name], schemas.SILVER_ADMISSIONS[final].dataType)
              for name, final in (("VAL_TOT", "valor_total"), ("DIAS_PERM", "dias_permanencia"), ("IDADE", "IDADE"))}
    return (
        dedup_any(bronze, keys or ["N_AIH"], COPY_ORDER)
        .withColumns({**narrow, "DT_INTER": parse_mixed_date("DT_INTER"), "DT_SAIDA": parse_mixed_date("DT_SAIDA")})
        .withColumnsRenamed(ADMISSION_NAMES)
    )


def silver_admissions(bronze: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Clean admissions: one row each, quality rules met, calendar columns added.

    `bronze` has the admissions schema plus `uf`, the state of the folder.
    """
    clean = apply_rules(typed_admissions(bronze, keys), admission_rules())
    return with_calendar(clean, "DT_INTER").to(schemas.SILVER_ADMISSIONS)


def silver_registry(bronze: DataFrame) -> DataFrame:
    """Latest version of every facility, with its state and hospital flag.

    A facility whose latest version has no known state is dropped, even if an
    earlier version had one. The source has no bed counts: these stay NULL.
    """
    typed = bronze.withColumns({
        "uf": state_abbrev("codigo_uf"),
        "eh_tipo_hospitalar": is_hospital_type("codigo_tipo_unidade"),
        "data_atualizacao": iso_date("data_atualizacao"),
    }).withColumnsRenamed(REGISTRY_NAMES)
    latest = latest_by(typed, ["cnes_id"], "data_atualizacao").filter(F.col("uf").isNotNull())
    beds = {name: F.lit(None).cast("int") for name in ("leitos_totais", "leitos_sus")}
    return latest.withColumns(beds).to(schemas.SILVER_REGISTRY)
