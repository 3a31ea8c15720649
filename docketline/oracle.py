"""DuckDB SQL that states each registered query independently of Spark.

Everything is written from the meaning, in another way than the Spark side: silver from one ordered
list of events per case, the dashboards from one row per case, key expressions instead of look-ups for the fact, distinct combinations for the
dimensions. Tables are the driver's pre-registered views. Types are cast to
what Spark returns.
"""

from __future__ import annotations

NULL_TOKEN = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {NULL_TOKEN})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


HDR = """
hdr AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, o.o_orderpriority,
    format('{:07d}{:02d}{:04d}8{:d}{:d}{:02d}{:02d}', o.o_orderkey % 10000000, (o.o_orderkey // 10000000) % 100,
           year(o.o_orderdate), o.o_orderkey // 100000000000, r.r_regionkey,
           (o.o_orderkey // 1000000000) % 100, n.n_nationkey) AS numero_processo,
    r.r_name AS sigla_tribunal,
    CAST(o.o_orderdate AS TIMESTAMP) AS data_ajuizamento,
    CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS codigo_classe,
    substr(o.o_orderpriority, 3) AS nome_classe,
    CAST(n.n_nationkey AS BIGINT) AS codigo_orgao,
    n.n_name AS nome_orgao,
    CAST(o.o_orderkey % 5 AS BIGINT) AS nivel_sigilo
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

MOV = """
mov AS (
  SELECT h.numero_processo, h.sigla_tribunal, l.l_linestatus AS grau, h.data_ajuizamento,
    h.codigo_classe, h.nome_classe, h.codigo_orgao, h.nome_orgao, h.nivel_sigilo,
    l.l_partkey AS codigo_movimento,
    'movimento ' || CAST(l.l_partkey AS VARCHAR) AS nome_movimento,
    CAST(l.l_shipdate AS TIMESTAMP) AS data_movimento
  FROM lineitem l JOIN hdr h ON l.l_orderkey = h.o_orderkey
)"""

# The parts of a 20-digit case number: name, first digit, digits, whether a number.
_PARTS = (("cnj_sequencial", 1, 7, False), ("cnj_digitos", 8, 2, False), ("cnj_ano", 10, 4, True),
          ("cnj_justica", 14, 1, True), ("cnj_cod_tribunal", 15, 2, True), ("cnj_origem", 17, 4, False))


def _part(name: str, at: int, size: int, number: bool) -> str:
    text = f"if(length(digitos) = 20, substr(digitos, {at}, {size}), '')"
    return f"{f'TRY_CAST({text} AS INTEGER)' if number else text} AS {name}"


def silver_of(name: str, source: str) -> str:
    """A silver CTE ``name`` over the flat CTE ``source``, without window functions: a case is the ordered list of its
    events, an event's neighbour the entry before it, and the latest event the last entry."""
    days = lambda a, b: f"CAST(CAST({b} AS DATE) - CAST({a} AS DATE) AS INTEGER)"
    return f"""
{name}__listas AS (
  SELECT list(s ORDER BY data_movimento NULLS FIRST, codigo_movimento NULLS FIRST) AS linhas,
         list(data_movimento ORDER BY data_movimento NULLS FIRST, codigo_movimento NULLS FIRST) AS horas
  FROM {source} s GROUP BY numero_processo
),
{name}__linhas AS (
  SELECT unnest(linhas) AS linha, unnest([NULL] || horas[1:len(horas) - 1]) AS anterior,
         unnest(range(1, len(linhas) + 1)) = len(linhas) AS is_ultimo_movimento
  FROM {name}__listas
),
{name} AS (
  SELECT * EXCLUDE (anterior, digitos), {', '.join(_part(*p) for p in _PARTS)},
         {days('data_ajuizamento', 'data_movimento')} AS dias_desde_ajuizamento,
         {days('anterior', 'data_movimento')} AS dias_desde_ultimo_movimento
  FROM (SELECT *, regexp_replace(numero_processo, '[^0-9]', '', 'g') AS digitos
        FROM (SELECT unnest(linha), anterior, is_ultimo_movimento FROM {name}__linhas))
)"""


SILVER = silver_of("silver", "mov")

# Movement code ranges of the phases.
PHASES = """
fases(de, ate, fase) AS (VALUES (1, 99, 'distribuição'), (100, 199, 'conhecimento'), (200, 299, 'instrução'),
  (300, 399, 'sentença'), (400, 499, 'recurso'), (500, 599, 'execução'), (600, 699, 'arquivamento'))"""


def phase_of(code: str) -> str:
    """The label of the range that holds a code (needs ``PHASES``)."""
    return f"coalesce((SELECT fase FROM fases WHERE {code} >= de AND {code} <= ate), 'outro')"


def date_key(col: str) -> str:
    return f"CAST(year({col}) * 10000 + month({col}) * 100 + day({col}) AS INTEGER)"


def key_or_null(*cols: str) -> str:
    """A surrogate key, null where one of its columns is."""
    return f"if({' AND '.join(f'{c} IS NOT NULL' for c in cols)}, {sk(*cols)}, NULL)"


def fact_of(name: str, silver: str) -> str:
    """A fact CTE over a silver CTE: the foreign keys are hashes of the row's own natural keys."""
    fields = {
        "numero_processo": "numero_processo", "data_movimento": "data_movimento",
        "fk_tribunal": key_or_null("sigla_tribunal"), "fk_classe": key_or_null("codigo_classe"),
        "fk_orgao": key_or_null("codigo_orgao", "sigla_tribunal"),
        "fk_data_movimento": date_key("data_movimento"), "fk_data_ajuizamento": date_key("data_ajuizamento"),
        "codigo_movimento": "codigo_movimento", "grau": "grau", "tipo_fase": phase_of("codigo_movimento"),
        "dias_desde_ajuizamento": "dias_desde_ajuizamento", "dias_desde_ultimo_movimento": "dias_desde_ultimo_movimento",
        "is_ultimo_movimento": "is_ultimo_movimento",
    }
    return f"{PHASES},\n{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in fields.items()) + f" FROM {silver})"


# The distinct combinations of court, class and organ among the events, with the dates they span.
DIMS = f"""
combinacoes AS (
  SELECT sigla_tribunal, codigo_classe, nome_classe, codigo_orgao, nome_orgao,
         min(least(data_ajuizamento, data_movimento)) AS de, max(greatest(data_ajuizamento, data_movimento)) AS ate
  FROM mov GROUP BY ALL
),
dim_tribunais AS (
  SELECT DISTINCT {sk('sigla_tribunal')} AS sk_tribunal, sigla_tribunal FROM combinacoes WHERE sigla_tribunal IS NOT NULL
),
dim_classes AS (
  SELECT DISTINCT ON (codigo_classe) {sk('codigo_classe')} AS sk_classe, codigo_classe, nome_classe
  FROM combinacoes WHERE codigo_classe IS NOT NULL ORDER BY codigo_classe, nome_classe
),
dim_orgaos AS (
  SELECT DISTINCT ON (codigo_orgao, sigla_tribunal) {sk('codigo_orgao', 'sigla_tribunal')} AS sk_orgao,
         codigo_orgao, nome_orgao, {key_or_null('sigla_tribunal')} AS fk_tribunal
  FROM combinacoes WHERE codigo_orgao IS NOT NULL ORDER BY codigo_orgao, sigla_tribunal, nome_orgao
),
dias AS (
  SELECT CAST(unnest(range(date_trunc('year', min(de)), date_trunc('year', max(ate)) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS DATE) AS data
  FROM combinacoes
),
dim_calendario AS (
  SELECT {date_key('data')} AS sk_data, data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
    monthname(data) AS nome_mes, CAST((month(data) + 2) // 3 AS INTEGER) AS trimestre,
    CAST((month(data) + 5) // 6 AS INTEGER) AS semestre, dayname(data) AS dia_semana,
    isodow(data) > 5 AS is_fim_de_semana, false AS is_feriado_nacional
  FROM dias
)"""

# One row per case: its events, the sum of ages, and what its latest event says.
CASES = """
casos AS (
  SELECT numero_processo, count(*) AS n, sum(dias_desde_ajuizamento) AS soma_idade, count(dias_desde_ajuizamento) AS n_idade,
         max(CASE WHEN is_ultimo_movimento THEN dias_desde_ultimo_movimento END) AS intervalo,
         max(CASE WHEN is_ultimo_movimento THEN dias_desde_ajuizamento END) AS idade,
         max(sigla_tribunal) AS tribunal, max(nome_classe) AS classe, max(nome_orgao) AS orgao
  FROM silver GROUP BY numero_processo
)"""


BASE = "WITH " + ",".join([HDR, MOV, SILVER])
GOLD = ",".join([BASE, DIMS, fact_of("fato", "silver")])


def with_gold(select: str, extra_ctes: str = "") -> str:
    return GOLD + ("," + extra_ctes if extra_ctes else "") + "\n" + select


def with_silver(select: str, extra_ctes: str = "") -> str:
    return BASE + ("," + extra_ctes if extra_ctes else "") + "\n" + select


def with_cases(select: str, extra_ctes: str = "") -> str:
    return with_silver(select, CASES + ("," + extra_ctes if extra_ctes else ""))


def with_mov(select: str, extra_ctes: str = "") -> str:
    return "WITH " + ",".join([HDR, MOV]) + ("," + extra_ctes if extra_ctes else "") + "\n" + select
