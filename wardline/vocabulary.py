"""Fixed values of the domain: codes, labels, weights and thresholds.

Everything below is a contract with the data or with the people who read the
reports; nothing here is derived.
"""

# IBGE two-digit state codes, in code order.
STATE_BY_CODE = {
    11: "RO", 12: "AC", 13: "AM", 14: "RR", 15: "PA", 16: "AP", 17: "TO",
    21: "MA", 22: "PI", 23: "CE", 24: "RN", 25: "PB", 26: "PE", 27: "AL", 28: "SE", 29: "BA",
    31: "MG", 32: "ES", 33: "RJ", 35: "SP",
    41: "PR", 42: "SC", 43: "RS",
    50: "MS", 51: "MT", 52: "GO", 53: "DF",
}
CODE_BY_STATE = {state: code for code, state in STATE_BY_CODE.items()}

# Facility type codes that count as hospitals.
HOSPITAL_TYPES = (5, 7, 15, 20, 21, 62)

# Risk levels, from the lowest to the highest.
RISK_LEVELS = ("Baixo risco", "Atenção", "Crítico", "Sobrecarga iminente")
ALERT_LEVELS = ("Crítico", "Sobrecarga iminente")
OVERLOAD_LEVEL = "Sobrecarga iminente"

# A stay of this many days or more is a critical patient.
CRITICAL_STAY_DAYS = 10

# Points given to each signal of the pressure index (they add up to 100).
PRESSURE_WEIGHTS = {"qtd_internacoes": 50, "permanencia_media": 30, "pacientes_criticos": 20}
OCCUPANCY_WEIGHTS = {"taxa_ocupacao_estimada": 60, "permanencia_media": 25, "pacientes_criticos": 15}

# Clustering settings.
CLUSTERS = 4
RESTARTS = 10
SEED = 42
MAX_ITERATIONS = 300
CENTRE_SHIFT = 1e-4  # a fit ends when the squared moves of its centres add up to no more than this

# Label of a municipality whose region is unknown.
UNCLASSIFIED_REGION = "Não classificada"
