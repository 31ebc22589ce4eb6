"""The result sets behind the dashboard and the report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import (
    execution_rate,
    format_money_br,
    format_number_br,
    format_pct_br,
    is_showcase_for_display,
    ratio,
)
from ..operators.joins import lookup_join
from ..operators.statistics import histogram
from ..rules import DEFAULT_RULES, Rules
from ..schemas import MONEY, NO_STATE
from .mart import Star, published

ALL_STATES = "Todas"
SHOWCASE_COLUMNS = [
    "codigoEmenda",
    "autor",
    "funcao",
    "localidadeDoGasto",
    "valorEmpenhado",
    "valorPago",
    "taxa_execucao_pct",
]
# Display names of the showcase table.
SHOWCASE_NAMES = ["Código", "Autor", "Função", "Localidade", "Empenhado (R$)", "Pago (R$)", "Execução (%)"]


def denormalised(star: Star) -> DataFrame:
    """The fact with region, theme and simplified type."""
    rows = lookup_join(
        star.fato_emendas, star.dim_localidade._replace(df=star.dim_localidade.df.select("localidade_id", "regiao")), ["localidade_id"]
    )
    rows = lookup_join(rows, star.dim_funcao._replace(df=star.dim_funcao.df.select("funcao", "area_tematica")), ["funcao"])
    return lookup_join(
        rows, star.dim_autor._replace(df=star.dim_autor.df.select("autor_id", "tipo_simplificado")), ["autor_id"]
    )


def with_serving_columns(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add what a lower layer lacks: state, unrounded rate, showcase flag."""
    if "uf" not in df.columns:
        df = df.withColumn("uf", rules.state_of(F.col("localidadeDoGasto")))
    if "taxa_execucao_pct" not in df.columns:
        df = df.withColumn(
            "taxa_execucao_pct", execution_rate(F.col("valorPago"), F.col("valorEmpenhado"), None)
        )
    if "emenda_vitrine" not in df.columns:
        df = df.withColumn(
            "emenda_vitrine", is_showcase_for_display(F.col("valorEmpenhado"), F.col("taxa_execucao_pct"))
        )
    return df


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values for a filter."""
    return df.select(column).dropna().distinct().orderBy(column)


def filtered(
    df: DataFrame,
    years: Sequence[int],
    functions: Sequence[str],
    state: str = ALL_STATES,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """The working set. No year or no function selects nothing; no type selects all."""
    tests: list[Column] = [_any_of("ano", years), _any_of("funcao", functions)]
    if state != ALL_STATES:
        tests.append(F.col("uf") == state)
    if types and "tipo_simplificado" in df.columns:
        tests.append(_any_of("tipo_simplificado", types))
    return df.where(reduce(Column.__and__, tests))


def _any_of(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values)) if values else F.lit(False)


# ---- the reused result ---------------------------------------------------------------

CUBE_KEYS = ["ano", "funcao", "uf", "autor", "tipoEmenda"]
_MEASURES = ["_rows", "_codes", "_committed", "_paid", "_shown", "_shown_value", "_flagged", "_flagged_value"]


def _is_cube(df: DataFrame) -> bool:
    return "_rows" in df.columns


def _measures(df: DataFrame, *names: str) -> list[Column]:
    """What is added up, of records or, once more, of a cube's rows."""
    if _is_cube(df):
        return [F.sum(m).alias(m) for m in names]
    committed, paid = F.col("valorEmpenhado").cast(MONEY), F.col("valorPago").cast(MONEY)
    made = {
        "_rows": lambda: F.count(F.lit(1)),
        "_codes": lambda: F.count("codigoEmenda"),
        "_committed": lambda: F.sum(committed),
        "_paid": lambda: F.sum(paid),
        "_shown": lambda: F.count_if(_is_showcase()),
        "_shown_value": lambda: F.sum(F.when(_is_showcase(), committed)),
        "_flagged": lambda: F.count_if("emenda_vitrine"),
        "_flagged_value": lambda: F.sum(F.when(F.col("emenda_vitrine"), committed)),
    }
    return [made[m]().alias(m) for m in names]


def cube(df: DataFrame) -> DataFrame:
    """Counts and exact sums by year, function, state, author and type: what the headline
    figures, totals and rankings add up, under any choice of these. All functions below
    that take records take a cube, too. It has as many rows as there are combinations,
    at most as many as records; store it next to what it was made from (``run.read_cube``)."""
    return df.groupBy(*CUBE_KEYS).agg(*_measures(df, *_MEASURES))


def _amount(measure: str) -> Column:
    return F.col(measure).cast("double")


def kpis(df: DataFrame) -> DataFrame:
    """One row. The distinct counts take a row per author, function and state and task."""
    if not _is_cube(df):
        paid = F.col("valorPago").cast(MONEY).alias("_paid")
        committed = F.col("valorEmpenhado").cast(MONEY).alias("_committed")
        df = df.select("autor", "funcao", "uf", F.lit(1).alias("_rows"), committed, paid)
    committed, paid = (F.sum(c).cast("double") for c in ("_committed", "_paid"))
    return df.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("total_emendas"),
        committed.alias("total_empenhado"),
        paid.alias("total_pago"),
        F.when(committed > 0, ratio(paid, committed) * 100).otherwise(0.0).alias("taxa_execucao"),
        F.count_distinct("autor").alias("autores_unicos"),
        F.count_distinct("funcao").alias("funcoes"),
        F.count_distinct("uf").alias("ufs"),
    )


def top(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The ``n`` largest rows with their 1-based position; equal values go by ``key``."""
    best = df.orderBy(F.desc(by), F.asc(key)).limit(n)
    return best.withColumn("posicao", F.row_number().over(Window.orderBy(F.desc(by), F.asc(key))).cast("long"))


def by_function(df: DataFrame) -> DataFrame:
    totals = df.where(F.col("funcao").isNotNull()).groupBy("funcao").agg(*_measures(df, "_committed", "_paid", "_codes"))
    return totals.select(
        "funcao", _amount("_committed").alias("total_empenhado"), _amount("_paid").alias("total_pago"), F.col("_codes").alias("qtd")
    )


def top_functions(df: DataFrame, n: int = 10) -> DataFrame:
    """The largest functions, smallest of them first as the chart draws them."""
    return top(by_function(df), "total_empenhado", "funcao", n).orderBy(F.desc("posicao"))


def by_author(df: DataFrame) -> DataFrame:
    totals = df.where(F.col("autor").isNotNull()).groupBy("autor").agg(*_measures(df, "_committed"))
    return totals.select("autor", _amount("_committed").alias("total_empenhado"))


def top_authors(df: DataFrame, n: int = 10) -> DataFrame:
    return top(by_author(df), "total_empenhado", "autor", n)


def by_state(df: DataFrame) -> DataFrame:
    """Totals of the records that belong to one state, largest first."""
    totals = df.where(F.col("uf") != NO_STATE).groupBy("uf").agg(*_measures(df, "_committed", "_codes"))
    rows = totals.select("uf", _amount("_committed").alias("total"), F.col("_codes").alias("qtd"))
    return rows.orderBy(F.desc("total"), "uf")


def top_states(df: DataFrame, n: int = 15) -> DataFrame:
    return top(by_state(df), "total", "uf", n)


def state_shares(df: DataFrame, n: int = 10) -> DataFrame:
    """Share of records among the ``n`` states with the largest totals."""
    whole = Window.partitionBy()
    return top_states(df, n).withColumn(
        "pct_qtd", F.round(F.col("qtd") / F.sum("qtd").over(whole) * 100, 2)
    )


def scatter(df: DataFrame) -> DataFrame:
    """Committed against rate for every record with a commitment."""
    return published(
        df.where(F.col("valorEmpenhado") > 0).select(
            "valorEmpenhado", "taxa_execucao_pct", "funcao", "autor", "localidadeDoGasto"
        )
    )


def _is_showcase() -> Column:
    return is_showcase_for_display(F.col("valorEmpenhado"), F.col("taxa_execucao_pct"))


def showcase_table(df: DataFrame) -> DataFrame:
    """Sizeable records that were hardly paid, largest first."""
    rows = published(df.where(_is_showcase()).select(*SHOWCASE_COLUMNS))
    return rows.orderBy(F.desc("valorEmpenhado"), "codigoEmenda")


def showcase_display(df: DataFrame) -> DataFrame:
    return showcase_table(df).withColumnsRenamed(dict(zip(SHOWCASE_COLUMNS, SHOWCASE_NAMES)))


def top_showcases(df: DataFrame, n: int = 20) -> DataFrame:
    """The largest records that carry the showcase flag."""
    return top(published(df.where("emenda_vitrine").select(*SHOWCASE_COLUMNS)), "valorEmpenhado", "codigoEmenda", n)


def showcase_totals(df: DataFrame) -> DataFrame:
    """Count and committed value under the dashboard's rule and under the flag."""
    totals = df.agg(*_measures(df, "_shown", "_shown_value", "_flagged", "_flagged_value"))
    count = lambda m: F.coalesce(m, F.lit(0)).cast("long")
    value = lambda m: F.coalesce(_amount(m), F.lit(0.0))
    return totals.select(
        count("_shown").alias("qtd_vitrines"),
        value("_shown_value").alias("valor_vitrines"),
        count("_flagged").alias("qtd_flag"),
        value("_flagged_value").alias("valor_flag"),
    )


def coverage(df: DataFrame) -> DataFrame:
    """Records and value that belong to one state, against those that do not."""
    none = F.col("uf") == NO_STATE
    if not _is_cube(df):
        df = df.select("uf", F.lit(1).alias("_rows"), F.col("valorEmpenhado").cast(MONEY).alias("_committed"))
    total = F.sum("_committed").cast("double")
    uncovered = F.coalesce(F.sum(F.when(none, F.col("_committed"))).cast("double"), F.lit(0.0))
    rows = F.coalesce(F.sum("_rows"), F.lit(0)).cast("long")
    rows_none = F.coalesce(F.sum(F.when(none, F.col("_rows"))), F.lit(0)).cast("long")
    return df.agg(
        (rows - rows_none).alias("qtd_com_uf"),
        rows_none.alias("qtd_sem_uf"),
        uncovered.alias("valor_sem_uf"),
        F.round((1 - ratio(uncovered, total)) * 100, 6).alias("pct_valor_coberto"),
    )


def rate_histogram(df: DataFrame, low: float = 0.0, high: float = 101.0, bins: int = 20) -> DataFrame:
    rows = df.where(F.col("valorEmpenhado") > 0)
    return histogram(rows, "taxa_execucao_pct", low, high, bins, "funcao")


def executive_summary(df: DataFrame) -> DataFrame:
    """The report's headline figures as Brazilian text: records, committed, paid, the
    ratio of the sums, and count and value of the flagged showcases."""
    totals = df.agg(*_measures(df, "_rows", "_committed", "_paid", "_flagged", "_flagged_value"))
    committed, paid = _amount("_committed"), _amount("_paid")
    return totals.select(
        format_number_br(F.coalesce("_rows", F.lit(0)).cast("long")).alias("emendas"),
        format_money_br(committed).alias("empenhado"),
        format_money_br(paid).alias("pago"),
        format_pct_br(ratio(paid, committed) * 100).alias("execucao"),
        format_number_br(F.coalesce("_flagged", F.lit(0)).cast("long")).alias("vitrines"),
        format_money_br(F.coalesce(_amount("_flagged_value"), F.lit(0.0))).alias("valor_vitrines"),
    )


def report_states(df: DataFrame, n: int = 10) -> DataFrame:
    """The ranking of states as the report prints it."""
    return top_states(df, n).select("posicao", "uf", format_money_br(F.col("total")).alias("total"), "qtd")


def report_showcases(df: DataFrame, n: int = 20) -> DataFrame:
    """The largest flagged showcases as the report prints them."""
    return top_showcases(df, n).withColumns(
        {
            "valorEmpenhado": format_money_br(F.col("valorEmpenhado")),
            "valorPago": format_money_br(F.col("valorPago")),
            "taxa_execucao_pct": format_pct_br(F.col("taxa_execucao_pct")),
        }
    )


def report_authors(df: DataFrame, n: int = 10) -> DataFrame:
    """The top authors as the dashboard prints them, in its own number format."""
    amount = F.concat(F.lit("R$ "), F.format_number("total_empenhado", 2))
    return top_authors(df, n).select("posicao", F.col("autor"), amount.alias("empenhado"))
