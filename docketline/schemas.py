"""Explicit schemas and column contracts."""

from __future__ import annotations

from pyspark.sql import types as T

NAME_CODE = T.StructType([
    T.StructField("codigo", T.LongType()),
    T.StructField("nome", T.StringType()),
])

MOVEMENT = T.StructType([
    T.StructField("codigo", T.LongType()),
    T.StructField("nome", T.StringType()),
    T.StructField("dataHora", T.StringType()),
])

SOURCE = T.StructType([
    T.StructField("numeroProcesso", T.StringType()),
    T.StructField("tribunal", T.StringType()),
    T.StructField("grau", T.StringType()),
    T.StructField("dataAjuizamento", T.StringType()),
    T.StructField("classe", NAME_CODE),
    T.StructField("orgaoJulgador", NAME_CODE),
    T.StructField("nivelSigilo", T.LongType()),
    T.StructField("movimentos", T.ArrayType(MOVEMENT)),
    T.StructField("assuntos", T.ArrayType(T.StringType())),
])

# One search hit as landed in the raw JSON files.
HIT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_source", SOURCE),
    T.StructField("sort", T.ArrayType(T.LongType())),
])

# A landed line that is no JSON object is kept whole in this column.
CORRUPT = "_corrupt_record"
# Names of known fields whose landed value had another type; the value is null.
CHANGED = "_changed_fields"

# Bronze = hit + unreadable line + source tag + ingest time + parsed filing time.
BRONZE = T.StructType(HIT.fields + [
    T.StructField(CORRUPT, T.StringType()),
    T.StructField("tribunal", T.StringType()),
    T.StructField("data_ingestao", T.TimestampType()),
    T.StructField("filed_at", T.TimestampType()),
])

# Flat event columns produced by flatten + explode (before derived columns).
FLAT_COLUMNS = [
    "numero_processo", "sigla_tribunal", "grau", "data_ajuizamento",
    "codigo_classe", "nome_classe", "codigo_orgao", "nome_orgao", "nivel_sigilo",
    "codigo_movimento", "nome_movimento", "data_movimento",
]

CNJ_COLUMNS = ["cnj_sequencial", "cnj_digitos", "cnj_ano", "cnj_justica",
               "cnj_cod_tribunal", "cnj_origem"]

SILVER_COLUMNS = FLAT_COLUMNS + CNJ_COLUMNS + [
    "dias_desde_ajuizamento", "dias_desde_ultimo_movimento", "is_ultimo_movimento",
    "data_ingestao", "data_processamento",
]

SILVER_DDL = (
    "numero_processo string, sigla_tribunal string, grau string, data_ajuizamento timestamp, "
    "codigo_classe bigint, nome_classe string, codigo_orgao bigint, nome_orgao string, "
    "nivel_sigilo bigint, codigo_movimento bigint, nome_movimento string, data_movimento timestamp, "
    "cnj_sequencial string, cnj_digitos string, cnj_ano int, cnj_justica int, cnj_cod_tribunal int, "
    "cnj_origem string, dias_desde_ajuizamento int, dias_desde_ultimo_movimento int, "
    "is_ultimo_movimento boolean, data_ingestao timestamp, data_processamento timestamp"
)

# Event key of silver and of the fact.
EVENT_KEY = ["numero_processo", "codigo_movimento", "data_movimento"]

FACT_COLUMNS = [
    "numero_processo", "data_movimento", "fk_tribunal", "fk_classe", "fk_orgao",
    "fk_data_movimento", "fk_data_ajuizamento", "codigo_movimento", "grau", "tipo_fase",
    "dias_desde_ajuizamento", "dias_desde_ultimo_movimento", "is_ultimo_movimento",
]

FACT_DDL = (
    "numero_processo string, data_movimento timestamp, fk_tribunal string, fk_classe string, "
    "fk_orgao string, fk_data_movimento int, fk_data_ajuizamento int, codigo_movimento bigint, "
    "grau string, tipo_fase string, dias_desde_ajuizamento int, dias_desde_ultimo_movimento int, "
    "is_ultimo_movimento boolean"
)
