"""Table schemas. Column names and types are the contract with the data files."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


_TEXT, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_DATE, _BOOL = T.DateType(), T.BooleanType()

# Bronze ---------------------------------------------------------------------------------------

ADMISSIONS = _struct(
    N_AIH=_TEXT, UF_ZI=_TEXT, MUNIC_RES=_LONG, MUNIC_MOV=_LONG, DT_INTER=_TEXT, DT_SAIDA=_TEXT,
    DIAG_PRINC=_TEXT, PROC_REA=_TEXT, VAL_TOT=_DOUBLE, DIAS_PERM=_LONG, IDADE=_LONG, SEXO=_TEXT,
    MORTE=_LONG, CNES=_LONG,
)
ADMISSION_PARTITIONS = ("uf", "ano_mes")

REGISTRY = _struct(
    codigo_cnes=_LONG,
    nome_fantasia=_TEXT,
    codigo_tipo_unidade=_INT,
    codigo_uf=_INT,
    codigo_municipio=_INT,
    latitude_estabelecimento_decimo_grau=_DOUBLE,
    longitude_estabelecimento_decimo_grau=_DOUBLE,
    estabelecimento_possui_atendimento_hospitalar=_INT,
    numero_telefone_estabelecimento=_TEXT,
    data_atualizacao=_TEXT,
)

MUNICIPALITIES = _struct(
    codigo_municipio=_LONG, nome_municipio=_TEXT, uf=_TEXT, regiao_saude=_TEXT,
    populacao=_LONG, meta_leitos_1000hab=_DOUBLE,
)

COORDINATES = _struct(codigo_ibge=_LONG, nome=_TEXT, latitude=_DOUBLE, longitude=_DOUBLE)

PRESSURE_FEATURES = _struct(
    cnes_id=_LONG, nome_estabelecimento=_TEXT, qtd_internacoes=_LONG, permanencia_media=_DOUBLE,
    pacientes_criticos=_LONG, taxa_ocupacao_estimada=_DOUBLE,
)

# Silver ---------------------------------------------------------------------------------------

SILVER_ADMISSIONS = _struct(
    N_AIH=_TEXT, uf_residencia_paciente=_TEXT, MUNIC_RES=_LONG, municipio_id=_LONG,
    DT_INTER=_DATE, DT_SAIDA=_DATE, cid_principal=_TEXT, PROC_REA=_TEXT, valor_total=_DOUBLE,
    dias_permanencia=_INT, IDADE=_INT, SEXO=_TEXT, MORTE=_LONG, cnes_id=_LONG,
    uf=_TEXT, ano=_INT, mes=_INT, semana_epidemiologica=_INT,
)

SILVER_REGISTRY = _struct(
    cnes_id=_LONG, nome_estabelecimento=_TEXT, codigo_tipo_unidade=_INT, eh_tipo_hospitalar=_BOOL,
    uf=_TEXT, codigo_municipio=_LONG, latitude=_DOUBLE, longitude=_DOUBLE,
    leitos_totais=_INT, leitos_sus=_INT, possui_atendimento_hospitalar=_INT, data_atualizacao=_DATE,
)

# Gold -----------------------------------------------------------------------------------------

DIM_HOSPITAL = T.StructType(SILVER_REGISTRY.fields[:-1])

DIM_TIME = _struct(ano=_INT, mes=_INT, semana_epidemiologica=_INT, trimestre=_INT)

# The partition columns come last, as they do in the partitioned table.
FACT = _struct(
    cnes_id=_LONG, municipio_id=_LONG, semana_epidemiologica=_INT, cid_principal=_TEXT,
    valor_total=_DOUBLE, dias_permanencia=_INT, ano=_INT, mes=_INT,
)

DISEASE_TREND = _struct(
    uf=_TEXT, cid_principal=_TEXT, ano=_INT, mes=_INT, semana_epidemiologica=_INT,
    qtd_casos=_LONG, qtd_casos_semana_anterior=_LONG, variacao_pct=_DOUBLE,
)

PRESSURE = _struct(
    cnes_id=_LONG, ano=_INT, mes=_INT, qtd_internacoes=_LONG, permanencia_media=_DOUBLE,
    pacientes_criticos=_LONG, cluster=_INT, nivel_risco=_TEXT, indice_pressao=_DOUBLE,
)
