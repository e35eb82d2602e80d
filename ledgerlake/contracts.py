"""Table contracts and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Item states, in the order the analytic layer lists them.
PRESENT = "existente"
ABSENT = "inexistente"
UNDER_WORK = "em_obra"
UNUSABLE = "inutilizavel"
UNKNOWN = "nao_informado"
STATES = (PRESENT, ABSENT, UNDER_WORK, UNUSABLE, UNKNOWN)

# One digit per state in the dashboard encoding ("0" = unknown).
STATE_DIGITS = {PRESENT: "1", ABSENT: "2", UNDER_WORK: "3", UNUSABLE: "4"}

# Event origins.
ORIGIN_CENSUS = "censo_escolar"
ORIGIN_ON_SITE = "vistoria_presencial"
ORIGIN_SELF = "autodeclaracao_escola"

# Exam areas; the essay is not an objective area.
OBJECTIVE_AREAS = ("cn", "ch", "lc", "mt")
ESSAY = "redacao"
AREAS = (*OBJECTIVE_AREAS, ESSAY)

# Thresholds of the analytic rules.
MIN_PARTICIPANTS = 10
MIN_GROUP = 10
BAND_EDGES = (1, 2, 5, 10, 30, 100)
TOLERANCE_DAYS = 7
MARK_MARGIN_SECONDS = 600
GOLD_SLA_SECONDS = 25 * 3600
DRAIN_SLA_SECONDS = 60
REASON_MAX_CHARS = 200
INSERT_ONLY_REASON = "violacao_insert_only"

# Open end of a validity interval: Spark timestamps have no infinity.
MAX_TS = "9999-12-31 23:59:59.999999"

# Required columns of the two raw files.
CENSUS_COLUMNS = (
    "NU_ANO_CENSO", "CO_ENTIDADE", "NO_ENTIDADE", "CO_MUNICIPIO", "NO_MUNICIPIO", "SG_UF", "CO_UF",
    "TP_DEPENDENCIA", "TP_LOCALIZACAO", "TP_SITUACAO_FUNCIONAMENTO",
)
EXAM_COLUMNS = (
    "NU_ANO", "CO_ESCOLA", "CO_MUNICIPIO_ESC", "SG_UF_ESC", "TP_DEPENDENCIA_ADM_ESC",
    "TP_LOCALIZACAO_ESC", "TP_SIT_FUNC_ESC", "TP_PRESENCA_CN", "TP_PRESENCA_CH", "TP_PRESENCA_LC",
    "TP_PRESENCA_MT", "NU_NOTA_CN", "NU_NOTA_CH", "NU_NOTA_LC", "NU_NOTA_MT", "TP_STATUS_REDACAO",
    "NU_NOTA_REDACAO",
)

EVENT_KEY = ("vistoria_id", "item_codigo")
EVENT_CONTENT = (
    "vistoria_id", "item_codigo", "co_entidade", "sg_uf", "origem", "ocorrido_em", "registrado_em",
    "situacao", "quantidade", "mes_ocorrencia",
)
EVENT_REQUIRED = tuple(c for c in EVENT_CONTENT if c != "quantidade")

EVENT_SCHEMA = T.StructType([
    T.StructField("vistoria_id", T.LongType(), False),
    T.StructField("item_codigo", T.StringType(), False),
    T.StructField("co_entidade", T.LongType(), False),
    T.StructField("sg_uf", T.StringType(), False),
    T.StructField("origem", T.StringType(), False),
    T.StructField("ocorrido_em", T.TimestampNTZType(), False),
    T.StructField("registrado_em", T.TimestampNTZType(), False),
    T.StructField("situacao", T.StringType(), False),
    T.StructField("quantidade", T.IntegerType(), True),
    T.StructField("mes_ocorrencia", T.StringType(), False),
    T.StructField("lsn_origem", T.LongType(), True),
])

DLQ_KEY = ("lsn_origem", "chave")

# Change-stream schema contract: announced column types per captured table.
# "any" accepts every type (the state enum has a server-specific type id).
STREAM_CONTRACT = {
    "vistoria": {
        "id": "bigint", "co_entidade": "int", "tecnico_id": "bigint", "origem": "text",
        "ocorrido_em": "timestamptz", "registrado_em": "timestamptz", "observacao": "text",
    },
    "vistoria_item": {
        "vistoria_id": "bigint", "item_codigo": "text", "situacao": "any", "quantidade": "int",
    },
}
