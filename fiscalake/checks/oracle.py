"""The same results as plain SQL over the test tables, for an independent engine."""

from __future__ import annotations

from ..plans.serving import SHOWCASE_COLUMNS, SHOWCASE_NAMES
from ..schemas import NO_SUBFUNCTION, REGION_STATES, STATE_CODES

_CTE: dict[str, tuple[list[str], str]] = {}
ORACLE: dict[str, str] = {}


def _cte(name: str, needs: list[str], body: str) -> None:
    _CTE[name] = (needs, body)


def _with(needs: list[str], body: str) -> str:
    """``body`` behind the common table expressions it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for earlier in _CTE[name][0]:
            visit(earlier)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in order) + "\n" + body


def _sql(name: str, needs: list[str], body: str) -> None:
    ORACLE[name] = _with(needs, body)


MONEY = "DECIMAL(18,4)"
AMOUNTS = ["valorEmpenhado", "valorLiquidado", "valorPago", "valorRestoInscrito", "valorRestoCancelado", "valorRestoPago"]
TEXTS = "tipoEmenda, autor, nomeAutor, numeroEmenda, localidadeDoGasto, funcao, subfuncao"
DOUBLES = ", ".join(f"{c}::DOUBLE AS {c}" for c in AMOUNTS)


def _title(expr: str) -> str:
    """Capital after every non-letter."""
    return (
        f"list_aggregate(list_transform(regexp_extract_all(lower({expr}), '[\\p{{L}}]+|[^\\p{{L}}]+'), "
        "lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"
    )


def _words(expr: str) -> str:
    """Capital after spaces only."""
    return (
        f"list_aggregate(list_transform(string_split(lower({expr}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
    )


def _mean(expr: str) -> str:
    return f"sum(({expr})::{MONEY})::DOUBLE / nullif(count({expr}), 0)"


def _state(place: str) -> str:
    return (
        f"CASE WHEN regexp_matches({place}, '^NATION_[0-9]+$') AND replace({place}, 'NATION_', '')::INT % 5 < 4 "
        f"THEN 'N' || lpad(replace({place}, 'NATION_', ''), 2, '0') ELSE 'NA' END"
    )


def _region(state: str) -> str:
    return (
        f"CASE WHEN {state} = 'NA' THEN 'Nacional' ELSE (['AFRICA','AMERICA','ASIA','EUROPE'])"
        f"[(replace({state}, 'N', '0')::INT % 5) + 1] END"
    )


def _theme(function: str) -> str:
    return (
        f"CASE WHEN {function} IN ('1-Urgent', '2-High') THEN 'Social' WHEN {function} = '3-Medium' "
        f"THEN 'Infraestrutura' WHEN {function} = '5-Low' THEN 'Segurança' ELSE 'Outros' END"
    )


_PERIOD = "CASE WHEN {0} < 1998 THEN 'Pré-Pandemia/Pandemia' WHEN {0} = 1998 THEN 'Pós-Pandemia' ELSE 'Atual' END"
_TYPE = (
    "CASE WHEN {0} ILIKE '%household%' THEN 'Individual' WHEN {0} ILIKE '%build%' THEN 'Comissão' "
    "WHEN {0} ILIKE '%auto%' THEN 'Bancada' ELSE 'Outro' END"
)
_BR = "translate(format('{{:,.{1}f}}', {0}), ',.', '.,')"

# ---- layers --------------------------------------------------------------------------

_cte(
    "line_amounts",
    [],
    f"""
    SELECT l_orderkey,
      sum(p)::{MONEY} AS valorLiquidado,
      sum(CASE WHEN l_linestatus = 'F' THEN p * (1 - l_discount::DECIMAL(4,2)) ELSE 0 END)::{MONEY} AS valorPago,
      sum(CASE WHEN l_returnflag = 'N' THEN p ELSE 0 END)::{MONEY} AS valorRestoInscrito,
      sum(CASE WHEN l_returnflag = 'R' THEN p ELSE 0 END)::{MONEY} AS valorRestoCancelado,
      sum(CASE WHEN l_returnflag = 'A' THEN p ELSE 0 END)::{MONEY} AS valorRestoPago
    FROM (SELECT *, l_extendedprice::DECIMAL(12,2) AS p FROM lineitem) GROUP BY l_orderkey""",
)
_cte(
    "records",
    ["line_amounts"],
    f"""
    SELECT o_orderkey::VARCHAR AS codigoEmenda, year(o_orderdate)::BIGINT AS ano, c_mktsegment AS tipoEmenda,
      c_name AS autor, c_name AS nomeAutor, lpad(o_custkey::VARCHAR, 8, '0') AS numeroEmenda,
      n_name AS localidadeDoGasto, o_orderpriority AS funcao, o_orderstatus AS subfuncao,
      o_totalprice::{MONEY} AS valorEmpenhado, {", ".join("line_amounts." + c for c in AMOUNTS[1:])}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN line_amounts ON l_orderkey = o_orderkey""",
)
_cte("in_window", ["records"], "SELECT * FROM records WHERE ano BETWEEN 1996 AND 2000")
_cte(
    "zeroed",
    ["in_window"],
    f"SELECT codigoEmenda, ano, {TEXTS}, {', '.join(f'coalesce({c}, 0)::{MONEY} AS {c}' for c in AMOUNTS)} FROM in_window",
)
_cte(
    "firsts",
    ["zeroed"],
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY codigoEmenda
      ORDER BY ano NULLS FIRST, autor NULLS FIRST, valorEmpenhado NULLS FIRST) AS rn FROM zeroed) WHERE rn = 1""",
)
_cte(
    "trusted",
    ["firsts"],
    f"""SELECT codigoEmenda, ano, tipoEmenda, upper(autor) AS autor, upper(nomeAutor) AS nomeAutor, numeroEmenda,
      localidadeDoGasto, {_title('funcao')} AS funcao, {_title('subfuncao')} AS subfuncao,
      {", ".join(AMOUNTS)}, {_state('localidadeDoGasto')} AS uf
    FROM firsts WHERE funcao IS NOT NULL AND valorPago <= valorEmpenhado * 1.01""",
)
_cte(
    "dim_tempo",
    ["trusted"],
    f"SELECT DISTINCT ano AS ano_id, ano, {_PERIOD.format('ano')} AS periodo FROM trusted",
)
_cte(
    "dim_funcao",
    ["trusted"],
    f"""SELECT row_number() OVER (ORDER BY funcao) AS funcao_id, funcao, subfuncao, {_theme('funcao')} AS area_tematica
    FROM (SELECT funcao, subfuncao, row_number() OVER (PARTITION BY funcao ORDER BY count(*) DESC, subfuncao) AS rn
      FROM trusted GROUP BY funcao, subfuncao) WHERE rn = 1""",
)
_cte(
    "dim_localidade",
    ["trusted"],
    f"""SELECT row_number() OVER (ORDER BY uf, localidadeDoGasto) AS localidade_id, localidadeDoGasto AS localidade,
      uf, {_region('uf')} AS regiao FROM (SELECT DISTINCT localidadeDoGasto, uf FROM trusted)""",
)
_cte(
    "dim_autor",
    ["trusted"],
    f"""SELECT row_number() OVER (ORDER BY autor) AS autor_id, autor, tipoEmenda,
      {_TYPE.format('tipoEmenda')} AS tipo_simplificado
    FROM (SELECT autor, tipoEmenda, row_number() OVER (PARTITION BY autor ORDER BY count(*) DESC, tipoEmenda) AS rn
      FROM trusted GROUP BY autor, tipoEmenda) WHERE rn = 1""",
)
_cte(
    "kpi_rows",
    ["trusted"],
    """SELECT *,
      CASE WHEN valorEmpenhado > 0 THEN round(valorPago::DOUBLE / valorEmpenhado::DOUBLE * 100, 2) ELSE 0 END
        AS taxa_execucao_pct,
      valorRestoInscrito - valorRestoCancelado AS restos_liquidos,
      coalesce(valorEmpenhado > 0 AND valorPago::DOUBLE / nullif(valorEmpenhado::DOUBLE, 0) < 0.1, false)
        AS emenda_vitrine
    FROM trusted""",
)
_cte(
    "fato",
    ["kpi_rows", "dim_tempo", "dim_localidade", "dim_autor"],
    """SELECT k.* EXCLUDE (nomeAutor, numeroEmenda), dt.ano_id, dl.localidade_id, da.autor_id
    FROM kpi_rows k LEFT JOIN dim_tempo dt ON k.ano = dt.ano_id
      LEFT JOIN dim_localidade dl ON k.uf = dl.uf AND k.localidadeDoGasto = dl.localidade
      LEFT JOIN dim_autor da ON k.autor = da.autor""",
)
_FACT = f"""codigoEmenda, ano, autor, funcao, subfuncao, localidadeDoGasto, uf, tipoEmenda, {DOUBLES},
  taxa_execucao_pct, restos_liquidos::DOUBLE AS restos_liquidos, emenda_vitrine, ano_id, localidade_id, autor_id"""
_cte(
    "stats_autor",
    ["fato"],
    f"""SELECT autor, sum(valorEmpenhado)::DOUBLE AS total_autor, {_mean('taxa_execucao_pct')} AS media_autor
    FROM fato GROUP BY autor""",
)
_cte(
    "moments",
    ["fato"],
    f"""SELECT {_mean('valorEmpenhado')} AS media, stddev_samp(valorEmpenhado::DOUBLE) AS desvio
    FROM fato WHERE valorEmpenhado > 0""",
)
_cte(
    "features",
    ["fato", "stats_autor", "moments", "dim_localidade", "dim_autor"],
    """SELECT fe.codigoEmenda, fe.autor, fe.funcao, fe.uf, dl.regiao, fe.ano,
      fe.valorEmpenhado::DOUBLE AS valorEmpenhado, fe.valorPago::DOUBLE AS valorPago, fe.taxa_execucao_pct,
      round(fe.valorEmpenhado::DOUBLE / nullif(sa.total_autor, 0) * 100, 2) AS pct_do_total_autor,
      fe.taxa_execucao_pct - sa.media_autor AS desvio_execucao_vs_autor,
      round((fe.valorEmpenhado::DOUBLE - (SELECT media FROM moments))
        / nullif((SELECT desvio FROM moments), 0), 3) AS zscore_valor,
      fe.emenda_vitrine::INT AS flag_vitrine, (fe.valorRestoInscrito > 0)::INT AS flag_em_restos,
      (dl.regiao = 'ASIA')::INT AS flag_nordeste, (dl.regiao = 'EUROPE')::INT AS flag_norte,
      (da.tipo_simplificado = 'Individual')::INT AS flag_individual, (fe.taxa_execucao_pct >= 80)::INT AS executou_bem
    FROM fato fe LEFT JOIN dim_localidade dl ON fe.localidade_id = dl.localidade_id
      LEFT JOIN dim_autor da ON fe.autor_id = da.autor_id JOIN stats_autor sa ON fe.autor = sa.autor
    WHERE fe.valorEmpenhado > 0""",
)

# ---- functions -----------------------------------------------------------------------

_sql(
    "money_parse",
    [],
    f"""SELECT o_orderkey, {_BR.format('o_totalprice', 2)} AS texto,
      o_totalprice::DECIMAL(18,2)::DOUBLE AS valor_zero, o_totalprice::DECIMAL(18,2)::DOUBLE AS valor_nulo,
      0.0::DOUBLE AS status_zero, CAST(NULL AS DOUBLE) AS status_nulo, true AS status_invalido,
      0.0::DOUBLE AS ausente_zero, 'R$ ' || {_BR.format('o_totalprice', 0)} AS moeda FROM orders""",
)
_sql(
    "percent_format",
    [],
    """SELECT l_orderkey, l_linenumber, l_partkey,
      replace(format('{:.1f}', l_discount * 1000), '.', ',') || '%' AS pct FROM lineitem""",
)
_PADDED = "replace(p_name, ' ', '''') || '-' || p_type"
_sql(
    "text_normalise",
    [],
    f"""SELECT p_partkey, {_title(_PADDED)} AS titulo,
      {_words("p_type || ' ' || p_name || ' ' || p_brand")} AS palavras, upper({_PADDED}) AS maiusculas,
      p_name || ' ' || chr(9) AS aparado,
      CASE WHEN p_type = 'PROMO' THEN '{NO_SUBFUNCTION}' ELSE p_type END AS padrao FROM part""",
)
_NAMES = ", ".join(f"({i}, '{n}', '{c}')" for i, (n, c) in enumerate(STATE_CODES.items()))
_BY_STATE = ", ".join(f"('{s}', '{r}')" for r, states in REGION_STATES.items() for s in states)
_sql(
    "state_lookup",
    [],
    f"""WITH names(i, nome, uf) AS (VALUES {_NAMES}), regions(uf, regiao) AS (VALUES {_BY_STATE})
    SELECT c_custkey, coalesce(nome, 'Nacional') || ' (UF)' AS lugar, coalesce(names.uf, 'NA') AS uf,
      coalesce(names.uf, 'NA') AS uf_sem_acento, coalesce(regiao, 'Nacional') AS regiao
    FROM customer LEFT JOIN names ON i = c_custkey % 28 LEFT JOIN regions ON regions.uf = names.uf""",
)
_sql(
    "place_to_region",
    [],
    """SELECT c_custkey, n_name,
      CASE WHEN r_name = 'MIDDLE EAST' THEN 'NA' ELSE 'N' || lpad(n_nationkey::VARCHAR, 2, '0') END AS uf,
      CASE WHEN r_name = 'MIDDLE EAST' THEN 'Nacional' ELSE r_name END AS regiao, r_name
    FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey""",
)
_sql(
    "theme_lookup",
    [],
    f"""SELECT o_orderkey, f AS funcao, {_theme('f')} AS area_tematica, 'Outros' AS area_publicada
    FROM (SELECT o_orderkey, {_title('o_orderpriority')} AS f FROM orders)""",
)
_sql(
    "year_filter",
    [],
    """SELECT o_orderkey, year(o_orderdate)::BIGINT AS ano FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'""",
)
_sql(
    "period_case",
    [],
    f"""SELECT o_orderkey, year(o_orderdate)::BIGINT AS ano, {_PERIOD.format('year(o_orderdate)')} AS periodo
    FROM orders""",
)
_sql(
    "type_simplify",
    [],
    """SELECT p_partkey, p_name, CASE WHEN p_name ILIKE '%ring%' THEN 'Individual' WHEN p_name ILIKE '%red%'
      THEN 'Comissão' WHEN p_name ILIKE '%bolt%' THEN 'Bancada' ELSE 'Outro' END AS tipo_simplificado FROM part""",
)
_sql(
    "rates_and_flags",
    ["records"],
    """SELECT codigoEmenda,
      CASE WHEN e > 0 THEN round(p / e * 100, 2) ELSE 0 END AS taxa_execucao_pct,
      CASE WHEN e > 0 THEN round(p / e * 100, 6) ELSE 0 END AS taxa_sem_arredondar,
      (valorRestoInscrito - valorRestoCancelado)::DOUBLE AS restos_liquidos,
      coalesce(e > 0 AND p / nullif(e, 0) < 0.1, false) AS emenda_vitrine,
      e > 1000 AND (CASE WHEN e > 0 THEN round(p / e * 100, 2) ELSE 0 END) < 10 AS vitrine_painel,
      round(p / nullif(valorRestoCancelado::DOUBLE, 0), 3) AS razao
    FROM (SELECT *, valorPago::DOUBLE AS p, valorEmpenhado::DOUBLE AS e FROM records)""",
)

# ---- sources and sinks ---------------------------------------------------------------

_sql(
    "parquet_scan_count",
    [],
    " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) AS linhas, count(*) AS observadas FROM {t}"
        for t in ("customer", "orders", "lineitem")
    ),
)
_sql(
    "json_roundtrip",
    ["records"],
    f"""SELECT codigoEmenda, ano, {TEXTS.replace(', subfuncao', '')},
      CASE WHEN ano < 1998 THEN subfuncao END AS subfuncao,
      {", ".join(f"{c}::DECIMAL(18,2)::DOUBLE AS {c}" for c in AMOUNTS[:3])},
      {", ".join(f"CASE WHEN ano >= 1998 THEN {c}::DECIMAL(18,2)::DOUBLE END AS {c}" for c in AMOUNTS[3:])}
    FROM records""",
)
_sql(
    "json_pages",
    [],
    "SELECT o_orderkey::VARCHAR AS codigoEmenda, year(o_orderdate)::BIGINT AS ano, o_orderstatus AS subfuncao FROM orders",
)
_sql("parquet_roundtrip", [], "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
_sql(
    "lookup_register",
    [],
    """SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Social'
      WHEN o_orderpriority = '5-LOW' THEN 'Segurança' ELSE 'NA' END AS area FROM orders""",
)
_sql(
    "layer_fallback",
    ["kpi_rows", "records"],
    f"""SELECT 'mart' AS camada, count(*) AS linhas, sum(valorEmpenhado)::DOUBLE AS empenhado,
      count(*) FILTER (emenda_vitrine) AS vitrines, count(DISTINCT uf) AS ufs FROM kpi_rows
    UNION ALL
    SELECT 'trusted', count(*), sum(valorEmpenhado)::DOUBLE, count(*) FILTER (valorEmpenhado > 1000
      AND valorPago::DOUBLE / valorEmpenhado::DOUBLE * 100 < 10), count(DISTINCT uf) FROM trusted
    UNION ALL
    SELECT unnest(['raw', 'raw arrays']), count(*), sum(valorEmpenhado::DECIMAL(18,2))::DOUBLE, count(*) FILTER (valorEmpenhado > 1000
      AND valorPago::DECIMAL(18,2)::DOUBLE / valorEmpenhado::DECIMAL(18,2)::DOUBLE * 100 < 10),
      count(DISTINCT {_state('localidadeDoGasto')}) FROM records""",
)
_sql(
    "filename_parse",
    [],
    """SELECT o_orderkey,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'outro.json'
        WHEN o_orderstatus = 'P' THEN 'emendas_' || year(o_orderdate) || '_sample.json'
        ELSE 'emendas_' || year(o_orderdate) || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.json' END AS arquivo,
      CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate)::INT END AS ano,
      CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y%m%d_%H%M%S') END
        AS carimbo,
      o_orderpriority <> '5-LOW' AND o_orderstatus = 'P' AS amostra FROM orders""",
)

# ---- ingestion control ---------------------------------------------------------------

_cte(
    "loads",
    [],
    """SELECT ano, st, 'emendas_' || ano || '_' || strftime(ultima, '%Y%m%d_')
        || lpad(ascii(st)::VARCHAR, 6, '0') || '.json' AS arquivo
    FROM (SELECT year(o_orderdate)::BIGINT AS ano, o_orderstatus AS st, max(o_orderdate) AS ultima
      FROM orders GROUP BY 1, 2)""",
)
_sql(
    "snapshot_select",
    ["loads"],
    """SELECT ano, arquivo, '/raw/' || arquivo AS path, 'ledger' AS origem, 'ledger' AS caso FROM loads WHERE st = 'O'
    UNION ALL
    SELECT l.ano, max(l.arquivo), '/raw/' || max(l.arquivo), 'nome', 'perdido' FROM loads l GROUP BY l.ano""",
)
_sql(
    "idempotent_load",
    [],
    """WITH m AS (SELECT strftime(o_orderdate, '%Y%m') AS mes, count(*) AS registros,
      count(*) FILTER (o_orderdate < TIMESTAMP '1999-06-15') AS loaded FROM orders GROUP BY 1)
    SELECT false AS forcado, mes, registros FROM m WHERE loaded = 0
    UNION ALL SELECT true, mes, registros FROM m""",
)
_sql(
    "page_completeness",
    [],
    """SELECT ano, count(DISTINCT pagina) AS paginas, min(pagina) AS primeira, max(pagina) AS ultima,
      count(*) AS registros, min(pagina) = 1 AND max(pagina) = count(DISTINCT pagina) AS completa
    FROM (SELECT year(o_orderdate)::BIGINT AS ano, month(o_orderdate)::BIGINT AS pagina FROM orders)
    WHERE NOT (ano = 1997 AND pagina = 5) GROUP BY ano""",
)
_sql(
    "land_and_read",
    [],
    """SELECT o_orderkey, year(o_orderdate)::BIGINT AS ano,
      CASE year(o_orderdate) WHEN 1998 THEN '20240103_000000' ELSE '20240101_000000' END AS ingest_id
    FROM orders""",
)
_sql(
    "forced_reload",
    [],
    """SELECT o_orderkey, year(o_orderdate)::BIGINT AS ano, 'emendas_' || year(o_orderdate) || '_20240101_000000' AS ingest_id
    FROM orders WHERE year(o_orderdate) IN (1997, 1998)""",
)
_sql(
    "page_set",
    ["records"],
    "SELECT codigoEmenda, ano, funcao, codigoEmenda::BIGINT % 12 + 1 AS pagina FROM records",
)
_sql("json_arrays", [], ORACLE["json_pages"])
def _print_of(rows: str) -> str:
    """Fingerprint of the rows of a query: count and two sums of each row's digest."""
    return f"""SELECT registros, sha256(registros || '/' || a || '/' || b) AS hash
    FROM (SELECT count(*) AS registros, sum(('0x' || h[1:15])::BIGINT) AS a, sum(('0x' || h[16:30])::BIGINT) AS b
      FROM (SELECT sha256(to_json(r)::VARCHAR) AS h FROM ({rows}) AS r))"""


def _cents(name: str) -> str:
    return f"floor({name} * 100 + 0.5)::BIGINT"


_sql(
    "fingerprint",
    [],
    "SELECT registros, hash, 2::BIGINT AS vezes FROM ("
    + _print_of(
        "SELECT * REPLACE ("
        + ", ".join(f"{_cents(c)} AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
        + ", strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem"
    )
    + ")",
)
_LOAD = f"""SELECT o_orderkey, o_custkey, o_orderstatus, {_cents('o_totalprice')} AS centavos,
    strftime(o_orderdate, '%Y-%m-%d') AS data, o_orderpriority, year(o_orderdate)::BIGINT AS ano FROM orders"""
_sql("failed_reload", [], f"SELECT *, 1::BIGINT AS entradas FROM ({_LOAD})")


def _entry(where: str) -> str:
    """(ano, registros, hash) of the rows of every year that meet a condition."""
    return f"""SELECT ano, registros, sha256(registros || '/' || a || '/' || b) AS hash
    FROM (SELECT ano, count(*) AS registros, sum(('0x' || h[1:15])::BIGINT) AS a, sum(('0x' || h[16:30])::BIGINT) AS b
      FROM (SELECT r.ano, sha256(to_json({{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
        'centavos': centavos, 'data': data, 'o_orderpriority': o_orderpriority}})::VARCHAR) AS h
        FROM ({_LOAD}) AS r WHERE {where}) GROUP BY ano)"""


_sql(
    "ledger_entries",
    [],
    f"""SELECT ano, ano || '/ingest_id=a' || ano AS carga, hash, registros, 'api' AS modo, ano % 2 = 1 AS atual FROM ({_entry('true')})
    UNION ALL
    SELECT ano, ano || '/ingest_id=b' || ano, hash, registros, 'amostra', true
    FROM ({_entry("o_orderstatus <> 'O' AND ano % 2 = 0")})""",
)
_sql(
    "empty_load_gate",
    [],
    f"""SELECT ano, count(*) FILTER (ok) = 0 AS recusada, count(*) FILTER (ok) AS registros
    FROM (SELECT ano, ano % 2 = 1 AND o_orderpriority = '1-URGENT' AS ok FROM ({_LOAD})) GROUP BY ano""",
)
_sql("page_stream", [], ORACLE["page_set"])
_sql(
    "staged_by_loads",
    [],
    f"""SELECT ano, count(*) AS linhas, sum(centavos)::BIGINT AS centavos, caso
    FROM ({_LOAD}) CROSS JOIN (VALUES ('antes'), ('de novo'), ('depois')) AS c(caso)
    WHERE NOT (caso = 'depois' AND ano = 1997 AND o_orderstatus <> 'F') GROUP BY ano, caso""",
)
_sql(
    "json_array_splits",
    [],
    """SELECT o_orderkey::VARCHAR AS "codigoEmenda", year(o_orderdate)::BIGINT AS ano, '}"{\\ ' || o_orderstatus || ' [{' AS subfuncao FROM orders""",
)

# ---- profiling, contract, quality ----------------------------------------------------


def _profile(tables: str, fields: dict[str, str], position: str, example: bool = True) -> str:
    parts = []
    for name, kind in fields.items():
        first = f"arg_min(v, {position}) FILTER (v IS NOT NULL)"
        parts.append(
            f"""SELECT '{name}' AS campo, CASE WHEN count(v) > 0 THEN '{kind}' ELSE 'null' END AS tipo,
              count(*) AS total, count(*) - count(v) AS nulos, count(DISTINCT v) AS cardinalidade,
              {first + " AS exemplo," if example else ""}
              CASE WHEN count(DISTINCT v) = 0 THEN '' WHEN count(DISTINCT v) <= 20
                THEN string_agg(DISTINCT v, '|' ORDER BY v) END AS valores_unicos
            FROM (SELECT *, nullif({name}::VARCHAR, '') AS v FROM {tables})"""
        )
    return " UNION ALL ".join(parts)


_CUSTOMER = "(SELECT * REPLACE (CASE WHEN c_nationkey = 3 THEN '' ELSE c_mktsegment END AS c_mktsegment) FROM customer)"
_sql(
    "field_profile",
    [],
    _profile(
        _CUSTOMER,
        {"c_custkey": "int", "c_name": "str", "c_nationkey": "int", "c_acctbal": "float", "c_mktsegment": "str"},
        "c_custkey",
    ),
)
_sql(
    "document_profile",
    [],
    ORACLE["field_profile"],
)
_ORDERS = {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "str", "o_totalprice": "float", "o_orderdate": "timestamp", "o_orderpriority": "str"}
_sql(
    "profile_envelope",
    [],
    f"""SELECT 'orders' AS arquivo_origem, 2001::BIGINT AS ano, (SELECT count(*) FROM orders) AS total_registros,
      {len(_ORDERS)}::BIGINT AS total_campos, p.* FROM ({_profile("orders", _ORDERS, "o_orderkey")}) AS p""",
)
_LOADED = {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "str", "centavos": "int", "data": "str", "o_orderpriority": "str"}
_sql(
    "landed_profile",
    [],
    " UNION ALL ".join(
        f"""SELECT ano, count(*) AS registros, count(*) AS total_registros, {len(_LOADED)}::BIGINT AS total_campos, '{name}' AS campo,
          '{kind}' AS tipo, count(*) AS total, count(*) - count(v) AS nulos, count(DISTINCT v) AS cardinalidade,
          arg_min(v, o_orderkey) AS exemplo,
          CASE WHEN count(DISTINCT v) <= 20 THEN string_agg(DISTINCT v, '|' ORDER BY v) END AS valores_unicos
        FROM (SELECT ano, o_orderkey, {name}::VARCHAR AS v FROM ({_LOAD})) GROUP BY ano"""
        for name, kind in _LOADED.items()
    ),
)
_CURRENT = f"(SELECT * FROM ({_LOAD}) WHERE ano <> 1997 OR o_orderstatus = 'F')"
_sql(
    "merged_profile",
    [],
    " UNION ALL ".join(
        f"""SELECT '{name}' AS campo, '{kind}' AS tipo, count(*) AS total, count(*) - count(v) AS nulos,
          CASE WHEN count(DISTINCT v) <= 20 THEN count(DISTINCT v) END AS cardinalidade, arg_min(v, (ano, o_orderkey)) AS exemplo,
          CASE WHEN count(DISTINCT v) <= 20 THEN string_agg(DISTINCT v, '|' ORDER BY v) END AS valores_unicos, true AS perto
        FROM (SELECT ano, o_orderkey, {name}::VARCHAR AS v FROM {_CURRENT})"""
        for name, kind in _LOADED.items()
    ),
)
_DICTIONARY = {
    "dim_tempo": "ano_id BIGINT, ano BIGINT, periodo VARCHAR",
    "dim_funcao": "funcao_id BIGINT, funcao VARCHAR, subfuncao VARCHAR, area_tematica VARCHAR",
    "dim_localidade": "localidade_id BIGINT, localidade VARCHAR, uf VARCHAR, regiao VARCHAR",
    "dim_autor": "autor_id BIGINT, autor VARCHAR, tipoEmenda VARCHAR, tipo_simplificado VARCHAR",
    "fato": "codigoEmenda VARCHAR, ano BIGINT, autor VARCHAR, funcao VARCHAR, subfuncao VARCHAR, "
    "localidadeDoGasto VARCHAR, uf VARCHAR, tipoEmenda VARCHAR, "
    + ", ".join(f"{c} DOUBLE" for c in AMOUNTS)
    + ", taxa_execucao_pct DOUBLE, restos_liquidos DOUBLE, emenda_vitrine BOOLEAN, ano_id BIGINT, "
    "localidade_id BIGINT, autor_id BIGINT",
}
_LISTED = ", ".join(
    f"('{t if t != 'fato' else 'fato_emendas'}', {i}, '{c.split()[0]}', '{c.split()[1]}')"
    for t, columns in _DICTIONARY.items()
    for i, c in enumerate(columns.split(", "))
)
_sql(
    "data_dictionary",
    list(_DICTIONARY),
    f"""SELECT table_name, position::BIGINT AS position, column_name, column_type, 'YES' AS "null", linhas
    FROM (VALUES {_LISTED}) AS d(table_name, position, column_name, column_type) JOIN ("""
    + " UNION ALL ".join(
        f"SELECT '{t if t != 'fato' else 'fato_emendas'}' AS t, count(*) AS linhas FROM {t}" for t in _DICTIONARY
    )
    + ") ON t = table_name",
)


def _rule(column: str, rule: str, test: str) -> str:
    return f"SELECT '{column}' AS \"column\", '{rule}' AS rule, count(*) FILTER ({test}) AS \"rows\" FROM records"


_sql(
    "contract_violations",
    ["records"],
    " UNION ALL ".join(
        [
            _rule("codigoEmenda", "type", "false"),
            _rule("codigoEmenda", "null", "codigoEmenda IS NULL"),
            _rule("ano", "type", "false"),
            _rule("ano", "null", "ano IS NULL"),
            _rule("ano", "domain", "ano NOT BETWEEN 1996 AND 2000"),
            _rule("tipoEmenda", "type", "tipoEmenda IS NOT NULL AND try_cast(tipoEmenda AS INT) IS NULL"),
            _rule("funcao", "type", "false"),
            _rule("funcao", "null", "funcao IS NULL"),
            _rule("funcao", "domain", "funcao NOT IN ('1-URGENT', '2-HIGH')"),
            _rule("subfuncao", "type", "false"),
            _rule("subfuncao", "money", "subfuncao IN ('F', 'O', 'P')"),
            _rule("valorPago", "type", "false"),
            _rule("valorPago", "null", "valorPago IS NULL"),
            "SELECT 'inexistente', 'missing', 1",
            "SELECT '*', 'empty', CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM records",
        ]
    ),
)


def _cases(column: str, rule: str, test: str, value: str) -> str:
    return f"""SELECT '{column}' AS "column", '{rule}' AS rule, count(*) AS "rows",
      string_agg(codigoEmenda || '=' || {value}, '|' ORDER BY codigoEmenda) FILTER (rn <= 3) AS casos
    FROM (SELECT *, row_number() OVER (ORDER BY codigoEmenda) AS rn FROM records WHERE {test}) HAVING count(*) > 0"""


_sql(
    "contract_gate",
    ["records"],
    " UNION ALL ".join(
        [
            _cases("ano", "domain", "ano NOT BETWEEN 1996 AND 2000", "ano"),
            _cases("valorRestoInscrito", "money", "subfuncao = 'P'", "'lixo'"),
            _cases("valorRestoPago", "money", "ano < 1995", "'1.0E15'"),
        ]
    ),
)


def _summary(records: str, order: str) -> str:
    """Discard accounting written as the steps themselves."""
    return f"""
    w AS (SELECT * FROM {records} WHERE ano BETWEEN 1996 AND 2000),
    d AS (SELECT *, row_number() OVER (PARTITION BY codigoEmenda ORDER BY {order}) AS rn FROM w),
    k AS (SELECT * FROM d WHERE rn = 1),
    n AS (SELECT (SELECT count(*) FROM {records}) AS lido, (SELECT count(*) FROM w) AS ini,
      (SELECT count(*) FROM d WHERE rn > 1) AS dup, (SELECT count(*) FROM k WHERE funcao IS NULL) AS semf,
      (SELECT count(*) FROM k WHERE funcao IS NOT NULL
        AND coalesce(valorPago, 0) > coalesce(valorEmpenhado, 0) * 1.01) AS corr),
    s AS (SELECT lido AS total_lido, lido - ini AS fora_da_janela, ini AS total_inicial, dup AS duplicatas,
      semf AS sem_funcao, corr AS corrompidos, ini - dup - semf - corr AS total_final,
      dup + semf + corr AS total_descartado, round((dup + semf + corr) / ini::DOUBLE * 100, 2) AS pct_descartado
      FROM n)"""


_SUMMARY = _with(["records"], "").rstrip() + "," + _summary("records", "ano, autor, valorEmpenhado")
ORACLE["quality_summary"] = f"{_SUMMARY} SELECT * FROM s"
ORACLE["publish_quality"] = f"{_SUMMARY} SELECT *, total_final AS publicados FROM s"
ORACLE["quality_report"] = f"""{_SUMMARY}
  SELECT motivo, registros_descartados, round(registros_descartados / total_inicial::DOUBLE * 100, 2) AS percentual
  FROM (SELECT 'duplicata por codigoEmenda' AS motivo, duplicatas AS registros_descartados, total_inicial FROM s
    UNION ALL SELECT 'funcao orçamentária nula', sem_funcao, total_inicial FROM s
    UNION ALL SELECT 'valorPago > valorEmpenhado (corrompido)', corrompidos, total_inicial FROM s)
  WHERE registros_descartados > 0"""
ORACLE["discard_gate"] = f"""{_SUMMARY}
  SELECT pct_descartado, limite::DOUBLE AS limite, pct_descartado / 100 <= limite AS aprovado
  FROM s, (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.3::DOUBLE)) AS l(limite)"""

_cte(
    "line_records",
    [],
    f"""SELECT l_orderkey::VARCHAR AS codigoEmenda, year(l_shipdate)::BIGINT AS ano, l_suppkey::VARCHAR AS autor,
      concat_ws('-', l_linenumber, l_partkey, l_quantity) AS numeroEmenda,
      CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS funcao, l_extendedprice::{MONEY} AS valorEmpenhado,
      (l_extendedprice::{MONEY} * (l_discount * 20)::DECIMAL(4,2))::{MONEY} AS valorPago FROM lineitem""",
)
ORACLE["quality_summary_lines"] = (
    _with(["line_records"], "").rstrip()
    + ","
    + _summary("line_records", "ano, numeroEmenda, valorEmpenhado")
    + " SELECT * FROM s"
)
_cte("staged", ["in_window"], "SELECT * FROM in_window WHERE codigoEmenda IS NOT NULL")
_sql("staging", ["staged"], f"SELECT codigoEmenda, ano, {TEXTS}, {DOUBLES} FROM staged")
_sql(
    "quarantine",
    ["staged"],
    f"SELECT codigoEmenda, ano, {TEXTS}, {DOUBLES} FROM staged WHERE valorPago > valorEmpenhado * 1.01",
)
_sql(
    "quality_report_null",
    ["staged"],
    """SELECT (SELECT count(*) FROM records) AS lidos,
      (SELECT count(*) FROM records WHERE ano NOT BETWEEN 1996 AND 2000) AS ano_invalido, 0::BIGINT AS codigo_nulo,
      count(*) AS registros_staging, count(*) FILTER (valorPago > valorEmpenhado * 1.01) AS quarentena,
      count(DISTINCT codigoEmenda) FILTER (valorPago <= valorEmpenhado * 1.01) AS aprovados,
      count(*) - count(*) FILTER (valorPago > valorEmpenhado * 1.01)
        - count(DISTINCT codigoEmenda) FILTER (valorPago <= valorEmpenhado * 1.01) AS descartados,
      count(*) FILTER (valorPago IS NULL OR valorEmpenhado IS NULL) AS valor_nulo,
      count(*) FILTER (valorPago <= valorEmpenhado * 1.01)
        - count(DISTINCT codigoEmenda) FILTER (valorPago <= valorEmpenhado * 1.01) AS duplicatas,
      0::BIGINT AS sem_funcao,
      round(count(DISTINCT codigoEmenda) FILTER (valorPago <= valorEmpenhado * 1.01) / count(*)::DOUBLE * 100, 1)
        AS pct_aprovados
    FROM staged""",
)
_sql("trusted_zero", ["trusted"], f"SELECT codigoEmenda, ano, {TEXTS}, {DOUBLES}, uf FROM trusted")
_sql(
    "trusted_null",
    ["staged"],
    f"""SELECT codigoEmenda, ano, tipoEmenda, trim(upper(autor)) AS autor, trim(upper(nomeAutor)) AS nomeAutor,
      numeroEmenda, localidadeDoGasto, trim({_words('funcao')}) AS funcao, trim({_words('subfuncao')}) AS subfuncao,
      {DOUBLES}, {_state('localidadeDoGasto')} AS uf
    FROM (SELECT *, row_number() OVER (PARTITION BY codigoEmenda ORDER BY ano DESC, autor, valorEmpenhado) AS rn
      FROM staged WHERE valorPago <= valorEmpenhado * 1.01) WHERE rn = 1 AND funcao IS NOT NULL""",
)
_sql(
    "trusted_null_lines",
    ["line_records"],
    f"""SELECT codigoEmenda, ano, autor, numeroEmenda, funcao, 'Não Informada' AS subfuncao,
      'Nacional' AS localidadeDoGasto, 'NA' AS uf, valorPago::DOUBLE AS valorPago
    FROM (SELECT *, row_number() OVER (PARTITION BY codigoEmenda ORDER BY ano DESC, numeroEmenda, valorEmpenhado) AS rn
      FROM line_records WHERE ano BETWEEN 1996 AND 2000 AND valorPago <= valorEmpenhado * 1.01)
    WHERE rn = 1 AND funcao IS NOT NULL""",
)

# ---- windows and relational operators ------------------------------------------------

_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
for _name, _direction in (("dedupe_latest", "DESC"), ("dedupe_first", "ASC")):
    _sql(
        _name,
        [],
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate {_direction}, {_REST}) AS rn FROM lineitem) WHERE rn = 1""",
    )
_sql(
    "modal_attribute",
    [],
    """SELECT row_number() OVER (ORDER BY o_custkey) AS id, o_custkey, o_orderpriority, pedidos::BIGINT AS pedidos
    FROM (SELECT o_custkey, o_orderpriority, sum(count(*)) OVER (PARTITION BY o_custkey) AS pedidos,
      row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
      FROM orders GROUP BY o_custkey, o_orderpriority) WHERE rn = 1""",
)
_sql(
    "surrogate_key",
    [],
    f"""SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, {_REST}) AS id, l_orderkey,
      l_linenumber, l_shipdate, l_partkey FROM lineitem""",
)
_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
_sql(
    "global_rank",
    [],
    f"""SELECT {_KEY}, l_quantity AS quantidade, rank() OVER (ORDER BY l_quantity DESC) AS posicao,
      (sum(l_quantity::{MONEY}) OVER (ORDER BY l_quantity DESC, {_KEY} ROWS UNBOUNDED PRECEDING))::DOUBLE AS acumulado
    FROM lineitem""",
)
_sql(
    "rank_with_nulls",
    [],
    f"""SELECT {_KEY}, q AS quantidade, rank() OVER (ORDER BY q DESC NULLS LAST) AS posicao,
      (sum(q::{MONEY}) OVER (ORDER BY q DESC NULLS LAST, {_KEY} ROWS UNBOUNDED PRECEDING))::DOUBLE AS acumulado
    FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS q FROM lineitem)""",
)
_sql(
    "projection_filter",
    [],
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS total, upper(trim(o_orderpriority)) AS o_orderpriority,
      o_totalprice * 2 AS dobro FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 1000
      AND o_totalprice < 400000 AND o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')""",
)
_sql(
    "group_aggregates",
    [],
    f"""SELECT l_returnflag, l_linestatus, count(*) AS linhas, sum(l_extendedprice::{MONEY})::DOUBLE AS soma,
      {_mean('l_extendedprice')} AS media, count(*) FILTER (l_discount > 0.05) AS com_desconto,
      round(count(*) FILTER (l_discount > 0.05) / count(*)::DOUBLE * 100, 1) AS pct_desconto,
      count(DISTINCT l_suppkey) AS fornecedores, count(l_partkey) AS pecas,
      round(stddev_samp(l_extendedprice), 6) AS desvio
    FROM lineitem GROUP BY ALL""",
)
_sql(
    "distinct_options",
    ["trusted"],
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS filtro, {c}::VARCHAR AS valor FROM trusted" for c in ("ano", "funcao", "uf")
    ),
)
_sql(
    "global_stats",
    [],
    f"""WITH m AS (SELECT {_mean('o_totalprice')} AS media, stddev_samp(o_totalprice) AS desvio FROM orders
      WHERE o_totalprice > 0)
    SELECT o_orderkey, round((o_totalprice - (SELECT media FROM m)) / nullif((SELECT desvio FROM m), 0), 3) AS zscore,
      round((SELECT media FROM m), 6) AS media, round((SELECT desvio FROM m), 6) AS desvio FROM orders""",
)
_sql(
    "group_join_back",
    [],
    f"""SELECT o_orderkey, o_custkey, n, round(o_totalprice / nullif(total, 0) * 100, 2) AS pct,
      o_totalprice - media AS desvio
    FROM orders JOIN (SELECT o_custkey, sum(o_totalprice::{MONEY})::DOUBLE AS total, {_mean('o_totalprice')} AS media,
      count(*) AS n FROM orders GROUP BY o_custkey) USING (o_custkey)""",
)
_sql(
    "skewed_join",
    [],
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, s_name, s_nationkey
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)

# ---- mart and features ---------------------------------------------------------------

_sql("dim_time", ["dim_tempo"], "SELECT * FROM dim_tempo")
_sql("dim_function", ["dim_funcao"], "SELECT * FROM dim_funcao")
_sql("dim_place", ["dim_localidade"], "SELECT * FROM dim_localidade")
_sql("dim_author", ["dim_autor"], "SELECT * FROM dim_autor")
_sql("fact", ["fato"], f"SELECT {_FACT} FROM fato")
_sql(
    "rank_authors",
    ["fato", "dim_autor"],
    f"""SELECT autor, tipo_simplificado, t::DOUBLE AS total_empenhado, total_pago, qtd_emendas, media_execucao,
      rank() OVER (ORDER BY t DESC) AS rank_empenhado,
      (sum(t) OVER (ORDER BY t DESC, autor ROWS UNBOUNDED PRECEDING))::DOUBLE AS total_acumulado
    FROM (SELECT fe.autor, da.tipo_simplificado, sum(valorEmpenhado) AS t, sum(valorPago)::DOUBLE AS total_pago,
      count(*) AS qtd_emendas, {_mean('taxa_execucao_pct')} AS media_execucao
      FROM fato fe JOIN dim_autor da ON fe.autor_id = da.autor_id GROUP BY fe.autor, da.tipo_simplificado)""",
)
# A record's region is that of its place, if the place is known.
_cte(
    "placed",
    ["fato", "dim_localidade"],
    "SELECT f.*, (SELECT max(p.regiao) FROM dim_localidade p WHERE p.localidade_id = f.localidade_id) AS regiao FROM fato f",
)
_sql(
    "dist_function_region",
    ["placed", "dim_funcao"],
    f"""SELECT t.funcao, t.area_tematica, g.* EXCLUDE (funcao) FROM dim_funcao t JOIN (
      SELECT funcao, regiao, count(*) AS qtd_emendas, count(*) FILTER (emenda_vitrine) AS emendas_vitrine,
        sum(valorEmpenhado)::DOUBLE AS total_empenhado, sum(valorPago)::DOUBLE AS total_pago,
        {_mean('taxa_execucao_pct')} AS media_execucao
      FROM placed GROUP BY ALL) g USING (funcao)""",
)
_sql(
    "exec_function_place",
    ["placed"],
    f"""SELECT *, round(vitrines::DOUBLE / total_emendas * 100, 1) AS pct_vitrines FROM (
      SELECT funcao, uf, regiao, count(*) AS total_emendas, count(*) FILTER (emenda_vitrine) AS vitrines,
        {_mean('taxa_execucao_pct')} AS media_execucao
      FROM placed GROUP BY ALL)""",
)
_sql(
    "fact_joins",
    ["fato", "dim_autor", "dim_funcao", "dim_localidade", "dim_tempo"],
    """SELECT fe.codigoEmenda, fe.valorEmpenhado::DOUBLE AS valorEmpenhado, df.area_tematica, dl.regiao, dl.localidade,
      da.tipo_simplificado, dt.periodo
    FROM fato fe JOIN dim_autor da ON fe.autor_id = da.autor_id JOIN dim_funcao df ON fe.funcao = df.funcao
      LEFT JOIN dim_localidade dl ON fe.localidade_id = dl.localidade_id
      LEFT JOIN dim_tempo dt ON fe.ano_id = dt.ano_id""",
)
_sql(
    "star_denormalised",
    ["fato", "dim_autor", "dim_funcao", "dim_localidade"],
    f"""SELECT f.*, dl.regiao, df.area_tematica, da.tipo_simplificado FROM (SELECT {_FACT} FROM fato) f
      LEFT JOIN dim_localidade dl ON f.localidade_id = dl.localidade_id LEFT JOIN dim_funcao df ON f.funcao = df.funcao
      LEFT JOIN dim_autor da ON f.autor_id = da.autor_id""",
)
_sql("features", ["features"], "SELECT * FROM features")
_FEATURES = [
    "valorEmpenhado",
    "taxa_execucao_pct",
    "pct_do_total_autor",
    "desvio_execucao_vs_autor",
    "zscore_valor",
    "flag_vitrine",
    "flag_em_restos",
    "flag_nordeste",
    "flag_norte",
    "flag_individual",
]


def _corr(x: str, y: str) -> str:
    return f"round(covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0), 6)"


_cte(
    "complete",
    ["features"],
    "SELECT * FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in [*_FEATURES, "executou_bem"]),
)
_sql(
    "label_correlation",
    ["complete"],
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {_corr(f, 'executou_bem')} AS correlation FROM complete" for f in _FEATURES
    ),
)
_sql(
    "correlation_matrix",
    ["complete"],
    " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {_corr(x, y)} AS correlation FROM complete"
        for x in [*_FEATURES, "executou_bem"]
        for y in [*_FEATURES, "executou_bem"]
    ),
)
_sql(
    "line_correlation",
    [],
    " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, {_corr(f, "(l_returnflag = 'R')::INT")} AS correlation
        FROM (SELECT *, 1 AS constante FROM lineitem)"""
        for f in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "constante")
    ),
)

# ---- serving -------------------------------------------------------------------------

_sql(
    "kpis",
    ["trusted"],
    """SELECT count(*) AS total_emendas, sum(valorEmpenhado)::DOUBLE AS total_empenhado,
      sum(valorPago)::DOUBLE AS total_pago,
      CASE WHEN sum(valorEmpenhado) > 0 THEN sum(valorPago)::DOUBLE / sum(valorEmpenhado)::DOUBLE * 100 ELSE 0 END
        AS taxa_execucao,
      count(DISTINCT autor) AS autores_unicos, count(DISTINCT funcao) AS funcoes, count(DISTINCT uf) AS ufs
    FROM trusted""",
)
_sql(
    "coverage",
    ["trusted"],
    """SELECT count(*) FILTER (uf <> 'NA') AS qtd_com_uf, count(*) FILTER (uf = 'NA') AS qtd_sem_uf,
      coalesce(sum(valorEmpenhado) FILTER (uf = 'NA'), 0)::DOUBLE AS valor_sem_uf,
      round((1 - coalesce(sum(valorEmpenhado) FILTER (uf = 'NA'), 0)::DOUBLE
        / nullif(sum(valorEmpenhado)::DOUBLE, 0)) * 100, 6) AS pct_valor_coberto
    FROM trusted""",
)
_cte(
    "by_function",
    ["trusted"],
    """SELECT funcao, sum(valorEmpenhado)::DOUBLE AS total_empenhado, sum(valorPago)::DOUBLE AS total_pago,
      count(codigoEmenda) AS qtd FROM trusted WHERE funcao IS NOT NULL GROUP BY funcao""",
)
_cte("by_author", ["trusted"], "SELECT autor, sum(valorEmpenhado)::DOUBLE AS total_empenhado FROM trusted GROUP BY autor")
_cte(
    "by_state",
    ["trusted"],
    """SELECT uf, sum(valorEmpenhado)::DOUBLE AS total, count(codigoEmenda) AS qtd FROM trusted
    WHERE uf <> 'NA' GROUP BY uf""",
)


def _top(source: str, by: str, key: str, n: int) -> str:
    return (
        f"SELECT *, row_number() OVER (ORDER BY {by} DESC, {key}) AS posicao FROM {source} "
        f"ORDER BY {by} DESC, {key} LIMIT {n}"
    )


_sql("functions_totals", ["by_function"], "SELECT * FROM by_function")
_sql("top_functions", ["by_function"], _top("by_function", "total_empenhado", "funcao", 10))
_sql("top_authors", ["by_author"], _top("by_author", "total_empenhado", "autor", 10))
_sql("uf_totals", ["by_state"], "SELECT * FROM by_state")
_sql("top_states", ["by_state"], _top("by_state", "total", "uf", 15))
_sql(
    "uf_share",
    ["by_state"],
    f"""SELECT *, round(qtd / (sum(qtd) OVER ())::DOUBLE * 100, 2) AS pct_qtd
    FROM ({_top("by_state", "total", "uf", 10)})""",
)
_SHOW = """codigoEmenda, autor, funcao, localidadeDoGasto, valorEmpenhado::DOUBLE AS valorEmpenhado,
  valorPago::DOUBLE AS valorPago, taxa_execucao_pct"""
_RULE = "valorEmpenhado > 1000 AND taxa_execucao_pct < 10"
_sql("showcase_table", ["kpi_rows"], f"SELECT {_SHOW} FROM kpi_rows WHERE {_RULE}")
_sql(
    "showcase_display",
    ["kpi_rows"],
    "SELECT "
    + ", ".join(f'"{old}" AS "{new}"' for old, new in zip(SHOWCASE_COLUMNS, SHOWCASE_NAMES))
    + f" FROM (SELECT {_SHOW} FROM kpi_rows WHERE {_RULE})",
)
_sql(
    "top_showcases",
    ["kpi_rows"],
    _top(f"(SELECT {_SHOW} FROM kpi_rows WHERE emenda_vitrine)", "valorEmpenhado", "codigoEmenda", 20),
)
_sql(
    "showcase_totals",
    ["kpi_rows"],
    f"""SELECT count(*) FILTER ({_RULE}) AS qtd_vitrines,
      coalesce(sum(valorEmpenhado) FILTER ({_RULE}), 0)::DOUBLE AS valor_vitrines,
      count(*) FILTER (emenda_vitrine) AS qtd_flag,
      coalesce(sum(valorEmpenhado) FILTER (emenda_vitrine), 0)::DOUBLE AS valor_flag FROM kpi_rows""",
)
_sql(
    "rate_histogram",
    ["kpi_rows"],
    """SELECT funcao, bin, "rows", round((bin - 1) * 5.05, 6)::DOUBLE AS bin_start, round(bin * 5.05, 6)::DOUBLE AS bin_end
    FROM (SELECT funcao, (least(greatest(floor(taxa_execucao_pct / 5.05), -1), 20) + 1)::BIGINT AS bin,
      count(*) AS "rows" FROM kpi_rows WHERE valorEmpenhado > 0 GROUP BY ALL)""",
)
_sql(
    "scatter_set",
    ["kpi_rows"],
    """SELECT valorEmpenhado::DOUBLE AS valorEmpenhado, taxa_execucao_pct, funcao, autor, localidadeDoGasto
    FROM kpi_rows WHERE valorEmpenhado > 0""",
)
_PCT = "replace(format('{{:.1f}}', {0}), '.', ',') || '%'"
_sql(
    "executive_summary",
    ["kpi_rows"],
    f"""SELECT {_BR.format('n::DOUBLE', 0)} AS emendas, 'R$ ' || {_BR.format('e', 0)} AS empenhado,
      'R$ ' || {_BR.format('p', 0)} AS pago, {_PCT.format('p / e * 100')} AS execucao,
      {_BR.format('v::DOUBLE', 0)} AS vitrines, 'R$ ' || {_BR.format('ve', 0)} AS valor_vitrines
    FROM (SELECT count(*) AS n, sum(valorEmpenhado)::DOUBLE AS e, sum(valorPago)::DOUBLE AS p,
      count(*) FILTER (emenda_vitrine) AS v,
      coalesce(sum(valorEmpenhado) FILTER (emenda_vitrine), 0)::DOUBLE AS ve FROM kpi_rows)""",
)
_sql(
    "report_states",
    ["by_state"],
    f"SELECT posicao, uf, 'R$ ' || {_BR.format('total', 0)} AS total, qtd FROM ({_top('by_state', 'total', 'uf', 10)})",
)
_sql(
    "report_showcases",
    ["kpi_rows"],
    f"""SELECT * REPLACE ('R$ ' || {_BR.format('valorEmpenhado', 0)} AS valorEmpenhado,
      'R$ ' || {_BR.format('valorPago', 0)} AS valorPago, {_PCT.format('taxa_execucao_pct')} AS taxa_execucao_pct)
    FROM ({_top(f"(SELECT {_SHOW} FROM kpi_rows WHERE emenda_vitrine)", "valorEmpenhado", "codigoEmenda", 20)})""",
)
_sql(
    "report_authors",
    ["by_author"],
    f"""SELECT posicao, autor, 'R$ ' || format('{{:,.2f}}', total_empenhado) AS empenhado
    FROM ({_top('by_author', 'total_empenhado', 'autor', 10)})""",
)
_FUNCTIONS = "funcao IN ('1-Urgent', '5-Low')"
_SETTINGS = {
    "tudo": _FUNCTIONS,
    "um_estado": f"ano IN (1997, 1998) AND {_FUNCTIONS} AND uf = 'N01'",
    "um_tipo": f"{_FUNCTIONS} AND {_TYPE.format('tipoEmenda')} IN ('Individual', 'Outro')",
    "tipo_vazio": f"ano = 1999 AND {_FUNCTIONS}",
    "ano_vazio": "false",
    "funcao_vazia": "false",
}
_sql(
    "filtered_working_set",
    ["trusted"],
    " UNION ALL ".join(
        f"""SELECT '{name}' AS filtro, count(*) AS linhas, coalesce(sum(valorEmpenhado), 0)::DOUBLE AS empenhado
        FROM trusted WHERE {test}"""
        for name, test in _SETTINGS.items()
    ),
)
_PUBLISHED = "codigoEmenda, ano, autor, funcao, valorEmpenhado, valorPago, count(*) OVER () AS linhas"
_sql(
    "publish_null_keeping",
    [],
    f"""SELECT {_PUBLISHED}, 'emendas_trusted' AS tabela FROM ({ORACLE["trusted_null"]})
    UNION ALL SELECT {_PUBLISHED}, 'emendas_financeiro_invalido' FROM ({ORACLE["quarantine"]})""",
)
_sql(
    "dictionary_document",
    [],
    f"""SELECT table_name, position::BIGINT AS position, column_name, column_type, 'YES' AS "null",
      NULL::VARCHAR AS "key", NULL::VARCHAR AS "default", NULL::VARCHAR AS extra
    FROM (VALUES {_LISTED}) AS d(table_name, position, column_name, column_type)""",
)
