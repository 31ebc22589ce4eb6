"""Mart -> one flat feature table, and its correlation with the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_mean, ratio
from ..operators.joins import lookup_join
from ..operators.statistics import correlation_matrix, label_correlation
from ..rules import DEFAULT_RULES, Rules
from ..schemas import CORRELATED_FEATURES, FEATURE_COLUMNS, LABEL
from ..staging import stage
from .mart import author_totals, place_region


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def committed_moments(rows: DataFrame) -> Column:
    """Mean and sample deviation of the positive commitments, as one scalar subquery."""
    positive = rows.where(F.col("valorEmpenhado") > 0)
    return positive.agg(
        F.struct(
            exact_mean(F.col("valorEmpenhado")).alias("mean"),
            F.stddev_samp(F.col("valorEmpenhado").cast("double")).alias("sd"),
        )
    ).scalar()


def features(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """18 columns per record with a positive commitment, from the fact or from trusted
    rows with their KPIs.

    An author's figures include records without a commitment. They are summed up and
    staged, one row per author, and joined back: a window over the author would take all
    records of a prolific one to a single task.
    """
    totals = author_totals(rows, rules)
    stats = stage(totals.select("autor", "total_empenhado", "media_execucao", "tipo_simplificado"), "author_totals")
    joined = lookup_join(rows.where(F.col("valorEmpenhado") > 0), stats, ["autor"], "inner")
    committed = F.col("valorEmpenhado").cast("double")
    rate = F.col("taxa_execucao_pct")
    return joined.withColumns({"regiao": place_region(rules), "_moments": committed_moments(rows)}).withColumns(
        {
            "valorEmpenhado": committed,
            "valorPago": F.col("valorPago").cast("double"),
            "pct_do_total_autor": F.round(ratio(committed, F.col("total_empenhado")) * 100, 2),
            "desvio_execucao_vs_autor": rate - F.col("media_execucao"),
            "zscore_valor": F.round(ratio(committed - F.col("_moments.mean"), F.col("_moments.sd")), 3),
            "flag_vitrine": _flag(F.col("emenda_vitrine")),
            "flag_em_restos": _flag(F.col("valorRestoInscrito") > 0),
            "flag_nordeste": _flag(F.col("regiao") == rules.northeast),
            "flag_norte": _flag(F.col("regiao") == rules.north),
            "flag_individual": _flag(F.col("tipo_simplificado") == rules.individual),
            LABEL: _flag(rate >= rules.good_rate),
        }
    ).select(*FEATURE_COLUMNS)


def feature_ranking(table: DataFrame, places: int | None = None) -> DataFrame:
    """(feature, correlation), strongest first; a constant feature is undefined and last."""
    ranked = label_correlation(table, CORRELATED_FEATURES, LABEL, places)
    return ranked.orderBy(F.desc_nulls_last("correlation"), "feature")


def feature_matrix(table: DataFrame, places: int | None = None) -> DataFrame:
    return correlation_matrix(table, [*CORRELATED_FEATURES, LABEL], places)
