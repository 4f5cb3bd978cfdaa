"""Fixed values.

These must equal what existing consumers of the tables already rely on, so
they are stated here once, as plain text, and imported everywhere else.
"""

# Fillers for missing values, by type name.
FILLERS = {
    "string": "desconhecido",
    "int": 0,
    "double": 0.0,
    "date": "1900-01-01",
    "timestamp": "1900-01-01 00:00:00",
}

# Column names added by the layers.
INGESTED_AT = "data_ingestao"
UPDATED_AT = "data_atualizacao"
YEAR_MONTH = "ano_mes"
YEAR, MONTH, DAY = "ano", "mes", "dia"
HOUR = "hora"

# Slowly changing dimension: column names, open end, flag values.
VALID_FROM = "data_inicio"
VALID_TO = "data_fim"
IS_CURRENT = "registro_ativo"
OPEN_END = "2400-12-31"
ACTIVE, INACTIVE = 1, 0

# Licence code -> provider name of the high-volume feed; any other code is "Other".
PROVIDERS = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
OTHER_PROVIDER = "Other"

# Columns of the monthly aggregate.
MONTHLY_KEYS = ["ano_mes", "service_type", "provider", "pulocationid", "dolocationid"]
MONTHLY_MEASURES = [
    "qtd_corridas",
    "locais_embarque",
    "locais_desembarque",
    "distancia_total",
    "faturamento_total",
    "media_distancia",
    "media_valor",
    "max_distancia",
    "max_valor",
    "min_data",
    "max_data",
]

# Columns of the report and the lines of its text form.
MEAN_TOTAL = "media_total_amount"
MEAN_PASSENGERS = "media_passageiros"
REPORT_TITLE = "VALIDAÇÃO DAS MÉTRICAS ANALÍTICAS"
REPORT_RULE = "==============================="
REPORT_TOTAL = "[2] Média de total_amount dos Yellow Taxis: "
REPORT_HOURS = "[3] Média de passageiros por hora do dia (maio):"
REPORT_HOUR_LINE = "Hora %d: média = %.2f"
REPORT_NO_PASSENGERS = "[3] Coluna passenger_count não disponível no dataset yellow."

# Masks.
CPF_HEAD, CPF_TAIL = "***.", ".***-**"
EMAIL_TAIL = "***@***.com"
PHONE_HEAD = "***-"

# Row hash: separator between the column texts.
HASH_SEPARATOR = "|"
