"""Trusted -> star schema: four dimensions, the fact and three analytic views."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import execution_rate, is_showcase
from ..operators.dedupe import modal_value
from ..operators.joins import lookup_join
from ..operators.ordered import number_rows, rank_and_running_total
from ..rules import DEFAULT_RULES, Rules
from ..schemas import FACT_COLUMNS, MONEY
from ..staging import Staged, stage, submit


@dataclass(frozen=True)
class Star:
    """The mart. Fact money is decimal; :func:`published` shows it as double."""

    dim_tempo: DataFrame
    dim_funcao: Staged
    dim_localidade: Staged
    dim_autor: Staged
    fato_emendas: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_tempo": self.dim_tempo,
            "dim_funcao": self.dim_funcao.df,
            "dim_localidade": self.dim_localidade.df,
            "dim_autor": self.dim_autor.df,
            "fato_emendas": published(self.fato_emendas),
        }


def published(df: DataFrame) -> DataFrame:
    """Decimal columns as the doubles of the published schemas."""
    decimals = {name: F.col(name).cast("double") for name, dtype in df.dtypes if dtype.startswith("decimal")}
    return df.withColumns(decimals) if decimals else df


def dim_tempo(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    years = trusted.select("ano").distinct()
    return years.select(F.col("ano").alias("ano_id"), "ano", rules.period_of(F.col("ano")).alias("periodo"))


def dim_funcao(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> Staged:
    modal = modal_value(trusted, "funcao", "subfuncao").withColumn("area_tematica", rules.theme_of(F.col("funcao")))
    return number_rows(modal, [F.asc_nulls_last("funcao")], "funcao_id", "dim_funcao")


def dim_localidade(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> Staged:
    places = trusted.select(F.col("localidadeDoGasto").alias("localidade"), "uf").distinct()
    places = places.withColumn("regiao", rules.region_of(F.col("uf")))
    order = [F.asc_nulls_last("uf"), F.asc_nulls_last("localidade")]
    return number_rows(places, order, "localidade_id", "dim_localidade")


def dim_autor(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> Staged:
    modal = modal_value(trusted, "autor", "tipoEmenda").withColumn(
        "tipo_simplificado", rules.type_of(F.col("tipoEmenda"))
    )
    return number_rows(modal, [F.asc_nulls_last("autor")], "autor_id", "dim_autor")


def with_kpis(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    paid, committed = F.col("valorPago"), F.col("valorEmpenhado")
    return trusted.withColumns(
        {
            "taxa_execucao_pct": execution_rate(paid, committed),
            "restos_liquidos": F.col("valorRestoInscrito") - F.col("valorRestoCancelado"),
            "emenda_vitrine": is_showcase(paid, committed, rules.showcase_below),
        }
    )


def fact(trusted: DataFrame, tempo: DataFrame, localidade: Staged, autor: Staged, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Trusted rows with KPIs and dimension keys; a key is NULL where nothing matches.
    The time dimension has one row per valid year and may always be broadcast."""
    places = localidade._replace(
        df=localidade.df.select("localidade_id", F.col("localidade").alias("localidadeDoGasto"), "uf")
    )
    rows = with_kpis(trusted, rules)
    rows = rows.join(F.broadcast(tempo.select("ano_id", "ano")), "ano", "left")
    rows = lookup_join(rows, places, ["uf", "localidadeDoGasto"])
    rows = lookup_join(rows, autor._replace(df=autor.df.select("autor_id", "autor")), ["autor"])
    return rows.select(*FACT_COLUMNS)


def build(trusted: DataFrame, rules: Rules = DEFAULT_RULES) -> Star:
    """All mart tables. The dimensions do not depend on each other and are written at the
    same time; the fact stays lazy, so write it or stage it where it is reused."""
    with ThreadPoolExecutor() as pool:
        waiting = [submit(pool, make, trusted, rules) for make in (dim_funcao, dim_localidade, dim_autor)]
        funcao, localidade, autor = (dim.result() for dim in waiting)
    tempo = dim_tempo(trusted, rules)
    return Star(tempo, funcao, localidade, autor, fact(trusted, tempo, localidade, autor, rules))


def _parts() -> list[Column]:
    """Additive parts of the view measures, so that a view can group twice."""
    rate = F.col("taxa_execucao_pct").cast(MONEY)
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.sum("valorEmpenhado").alias("_committed"),
        F.sum("valorPago").alias("_paid"),
        F.sum(rate).alias("_rate"),
        F.count(rate).alias("_rated"),
        F.count_if("emenda_vitrine").alias("_showcases"),
    ]


def _mean_rate() -> Column:
    return F.try_divide(F.sum("_rate").cast("double"), F.sum("_rated"))


def author_totals(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per author: totals, mean rate and the simplified most frequent type.

    One grouping by (author, type) serves both: its counts choose the type, its sums add
    up. Nothing is joined, and a prolific author shrinks to a few rows before the shuffle.
    """
    pairs = rows.where(F.col("autor").isNotNull()).groupBy("autor", "tipoEmenda").agg(*_parts())
    return (
        pairs.groupBy("autor")
        .agg(
            F.min_by("tipoEmenda", F.struct(-F.col("_rows"), F.col("tipoEmenda"))).alias("_type"),
            F.sum("_committed").alias("total_empenhado"),
            F.sum("_paid").cast("double").alias("total_pago"),
            F.sum("_rows").alias("qtd_emendas"),
            _mean_rate().alias("media_execucao"),
        )
        .withColumn("tipo_simplificado", rules.type_of(F.col("_type")))
        .drop("_type")
    )


def ranking_by_author(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Authors by committed amount, with rank and running total. The totals, one row per
    author, are written first: the borders of the global order are found in what is
    written, not by summing up once more."""
    totals = stage(author_totals(rows, rules), "author_totals").df
    return published(rank_and_running_total(totals, "total_empenhado", ["autor"], "rank_empenhado", "total_acumulado"))


def place_region(rules: Rules = DEFAULT_RULES) -> Column:
    """Region of a record's place: a function of its state, as in the place dimension.
    NULL where place or state is missing, since no dimension row matches there."""
    known = F.col("localidadeDoGasto").isNotNull() & F.col("uf").isNotNull()
    return F.when(known, rules.region_of(F.col("uf")))


def distribution_by_function_and_region(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Totals by function, theme and region. The theme is a function of the function."""
    totals = (
        rows.where(F.col("funcao").isNotNull()).groupBy("funcao", place_region(rules).alias("regiao")).agg(*_parts())
    )
    return totals.select(
        "funcao",
        rules.theme_of(F.col("funcao")).alias("area_tematica"),
        "regiao",
        F.col("_rows").alias("qtd_emendas"),
        F.col("_committed").cast("double").alias("total_empenhado"),
        F.col("_paid").cast("double").alias("total_pago"),
        F.try_divide(F.col("_rate").cast("double"), F.col("_rated")).alias("media_execucao"),
        F.col("_showcases").alias("emendas_vitrine"),
    )


def budget_execution(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Records, showcases and mean rate by function, state and region."""
    totals = rows.groupBy("funcao", "uf", place_region(rules).alias("regiao")).agg(*_parts())
    return totals.select(
        "funcao",
        "uf",
        "regiao",
        F.col("_rows").alias("total_emendas"),
        F.col("_showcases").alias("vitrines"),
        F.round(F.col("_showcases").cast("double") / F.col("_rows") * 100, 1).alias("pct_vitrines"),
        F.try_divide(F.col("_rate").cast("double"), F.col("_rated")).alias("media_execucao"),
    )


# The names of the analytic views.
VIEWS = ["vw_ranking_autores", "vw_distribuicao_funcao_regiao", "vw_execucao_orcamentaria"]


def views(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The analytic views over the fact, or over trusted rows with their KPIs."""
    makers = [ranking_by_author, distribution_by_function_and_region, budget_execution]
    return {name: make(rows, rules) for name, make in zip(VIEWS, makers)}


def register(tables: dict[str, DataFrame], names: Sequence[str] | None = None) -> None:
    """Temporary views, evaluated when queried."""
    for name in names or tables:
        tables[name].createOrReplaceTempView(name)
