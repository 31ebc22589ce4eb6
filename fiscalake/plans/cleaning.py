"""Raw -> trusted, in two published flavours.

*Zero-null*: missing amounts become 0; keep one row per code, then drop rows without a
function, then rows that break the financial rule. *Null-keeping*: missing amounts stay
NULL and fail the financial rule, which comes first; violators go to a quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import money_or_null, money_or_zero
from ..functions.text import strip, title_case, upper_strip, word_case
from ..operators.contract import Contract, Field
from ..operators.dedupe import keep_first, keep_latest
from ..rules import DEFAULT_RULES, Rules
from ..schemas import MONEY_COLUMNS, NATIONAL, NO_STATE, NO_SUBFUNCTION, RAW_COLUMNS, TEXT_COLUMNS

KEY = "codigoEmenda"

# The reasons for which rows are discarded.
DUPLICATE = "duplicata por codigoEmenda"
NO_FUNCTION = "funcao orçamentária nula"
OVERPAID = "valorPago > valorEmpenhado (corrompido)"
NULL_AMOUNT = "valor nulo"
BAD_YEAR = "ano fora da janela"
NULL_CODE = "codigoEmenda nulo"


class InsufficientQuality(ValueError):
    """More rows were discarded than the ceiling allows."""


def raw_contract(rules: Rules = DEFAULT_RULES, money_text: bool = True) -> Contract:
    """What the raw layer must look like before it is cleaned."""
    text = T.StringType()
    required = ["tipoEmenda", "autor", "funcao"]
    return Contract(
        [
            Field(KEY, text, nullable=False),
            Field("ano", T.IntegerType(), nullable=False, allowed=rules.years),
            *[Field(c, text, nullable=False) for c in required],
            *[Field(c, text) for c in ("localidadeDoGasto", "subfuncao")],
            *[Field(c, text, money=money_text) for c in MONEY_COLUMNS[:3]],
            # Amounts carried over are parsed like the others, but a source may lack them.
            *[Field(c, text, money=money_text, optional=True) for c in MONEY_COLUMNS[3:]],
        ]
    )


def in_window(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows of the valid years; a pushed filter, or partition pruning on landed data."""
    return df.where(F.col("ano").between(rules.first_year, rules.last_year))


def typed(df: DataFrame, null_money: str = "zero") -> DataFrame:
    """Raw columns in their types; ``null_money`` is 'zero' or 'keep'."""
    parse = {"zero": money_or_zero, "keep": money_or_null}[null_money]
    types = {f.name: f.dataType for f in df.schema}
    amounts = {c: parse(F.col(c), types[c]) for c in MONEY_COLUMNS if c in types}
    codes = {c: F.col(c).cast("string") for c in TEXT_COLUMNS if c in types}
    return df.withColumns({**codes, "ano": F.col("ano").try_cast("long"), **amounts})


def within_tolerance(rules: Rules = DEFAULT_RULES) -> Column:
    """Paid may exceed committed by the tolerance. NULL when an amount is missing."""
    return F.col("valorPago") <= F.col("valorEmpenhado") * F.lit(rules.tolerance)


def normalised(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Text of the zero-null flavour, and the state of the place."""
    cleaned = df.withColumns(
        {
            "funcao": title_case(strip(F.col("funcao"))),
            "subfuncao": title_case(strip(F.coalesce("subfuncao", F.lit(NO_SUBFUNCTION)))),
            "autor": upper_strip(F.col("autor")),
            "nomeAutor": upper_strip(F.col("nomeAutor")),
            "localidadeDoGasto": strip(F.coalesce("localidadeDoGasto", F.lit(NATIONAL))),
        }
    )
    return cleaned.withColumn("uf", rules.state_of(F.col("localidadeDoGasto")))


def normalised_words(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Text of the null-keeping flavour: words rather than letters start in capitals."""
    place = F.coalesce("localidadeDoGasto", F.lit(NATIONAL))
    return df.withColumns(
        {
            "autor": F.trim(F.upper("autor")),
            "nomeAutor": F.trim(F.upper("nomeAutor")),
            "funcao": F.trim(word_case(F.col("funcao"))),
            "subfuncao": F.trim(word_case(F.coalesce("subfuncao", F.lit(NO_SUBFUNCTION)))),
            "localidadeDoGasto": place,
            # A missing place has no state, whatever label it is shown under.
            "uf": F.when(F.col("localidadeDoGasto").isNull(), NO_STATE).otherwise(rules.state_of_loose(place)),
        }
    )


def trusted_zero(df: DataFrame, position: Sequence[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The zero-null flavour. ``position`` orders copies of a code; the first one stays."""
    rows = keep_first(typed(in_window(df, rules), "zero"), [KEY], position)
    rows = rows.where(F.col("funcao").isNotNull()).where(within_tolerance(rules))
    return normalised(rows, rules).select(*RAW_COLUMNS, "uf")


def staging_rows(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Typed rows with a code and a valid year, amounts possibly NULL."""
    return typed(in_window(df, rules), "keep").where(F.col(KEY).isNotNull())


def quarantine(staging: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows that were paid more than they committed, with their values."""
    return staging.where(F.col("valorPago") > F.col("valorEmpenhado") * F.lit(rules.tolerance))


def trusted_null(staging: DataFrame, tie_break: Sequence[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The null-keeping flavour; the latest year of a code stays, then ``tie_break``."""
    rows = keep_latest(staging.where(within_tolerance(rules)), [KEY], "ano", tie_break)
    return normalised_words(rows.where(F.col("funcao").isNotNull()), rules).select(*RAW_COLUMNS, "uf")


def discard_summary(df: DataFrame, position: Sequence[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row of counts for the zero-null flavour, charging each row to the first rule
    it fails: outside the years, copy of a code, no function, overpaid.

    Copies are counted and the surviving one chosen in the same grouping by code, which
    combines before the shuffle and reads only the columns the rules need.
    """
    valid = F.col("ano").between(rules.first_year, rules.last_year)
    rows = typed(df, "zero")
    keep = F.struct("funcao", "valorPago", "valorEmpenhado")
    order = F.struct(*position)
    groups = (
        rows.where(valid)
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min_by(keep, order).alias("_row"))
        .select("_copies", "_row.*")
    )
    no_function = F.col("funcao").isNull()
    read = df.agg(F.count(F.lit(1))).scalar()
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_inicial"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicatas"),
        F.count_if(no_function).alias("sem_funcao"),
        F.count_if(~no_function & ~within_tolerance(rules)).alias("corrompidos"),
    ).select(
        read.alias("total_lido"),
        (read - F.col("total_inicial")).alias("fora_da_janela"),
        "*",
        (F.col("total_inicial") - F.col("duplicatas") - F.col("sem_funcao") - F.col("corrompidos")).alias(
            "total_final"
        ),
    ).withColumns(
        {
            "total_descartado": F.col("total_inicial") - F.col("total_final"),
            "pct_descartado": _pct(F.col("total_inicial") - F.col("total_final")),
        }
    )


def _pct(rows: Column) -> Column:
    share = F.try_divide(rows.cast("double"), F.col("total_inicial").cast("double")) * 100
    return F.coalesce(F.round(share, 2), F.lit(0.0))


def discard_report(summary: DataFrame) -> DataFrame:
    """(motivo, registros_descartados, percentual) for the reasons that occurred."""
    reasons = {DUPLICATE: "duplicatas", NO_FUNCTION: "sem_funcao", OVERPAID: "corrompidos"}
    entries = [
        F.struct(
            F.lit(reason).alias("motivo"),
            F.col(column).cast("long").alias("registros_descartados"),
            _pct(F.col(column)).alias("percentual"),
        )
        for reason, column in reasons.items()
    ]
    return summary.select(F.inline(F.array(*entries))).where("registros_descartados > 0")


def staging_report(df: DataFrame, tie_break: Sequence[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row for the null-keeping flavour: read, staged, quarantined, approved and the
    rest, split into its causes. Read counts rows before any filter."""
    rows = typed(df, "keep")
    valid = F.coalesce(F.col("ano").between(rules.first_year, rules.last_year), F.lit(False))
    staged = valid & F.col(KEY).isNotNull()
    fine = within_tolerance(rules)
    order = F.struct(-F.col("ano"), *[F.col(c) for c in tie_break])
    kept = staged & F.coalesce(fine, F.lit(False))
    groups = rows.groupBy(F.when(staged, F.col(KEY)).alias("_key")).agg(
        F.count(F.lit(1)).alias("lidos"),
        F.count_if(~valid).alias("ano_invalido"),
        F.count_if(valid & F.col(KEY).isNull()).alias("codigo_nulo"),
        F.count_if(staged & ~fine).alias("quarentena"),
        F.count_if(staged & fine.isNull()).alias("valor_nulo"),
        F.count_if(kept).alias("_fine"),
        F.min_by(F.when(F.col("funcao").isNotNull(), 1).otherwise(0), F.when(kept, order)).alias("_has_function"),
    )
    approved = F.col("_has_function") == 1
    dropped = (F.col("_fine") > 0) & (F.col("_has_function") == 0)
    totals = groups.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("lidos", "ano_invalido", "codigo_nulo", "quarentena", "valor_nulo")],
        F.coalesce(F.sum(F.greatest(F.col("_fine") - 1, F.lit(0))), F.lit(0)).alias("duplicatas"),
        F.count_if(dropped).alias("sem_funcao"),
        F.count_if(approved).alias("aprovados"),
    )
    staged_rows = F.col("lidos") - F.col("ano_invalido") - F.col("codigo_nulo")
    share = F.try_divide(F.col("aprovados").cast("double"), staged_rows.cast("double")) * 100
    return totals.select(
        "lidos",
        "ano_invalido",
        "codigo_nulo",
        staged_rows.alias("registros_staging"),
        "quarentena",
        "aprovados",
        (staged_rows - F.col("quarentena") - F.col("aprovados")).alias("descartados"),
        "valor_nulo",
        "duplicatas",
        "sem_funcao",
        F.coalesce(F.round(share, 1), F.lit(0.0)).alias("pct_aprovados"),
    )


def passes(summary_row, rules: Rules = DEFAULT_RULES) -> bool:
    return summary_row["pct_descartado"] / 100 <= rules.discard_limit


def require_quality(summary: DataFrame, rules: Rules = DEFAULT_RULES) -> dict:
    """The summary as a dict, or :class:`InsufficientQuality`. Collects one row."""
    row = summary.first()
    if not passes(row, rules):
        raise InsufficientQuality(
            f"{row['pct_descartado']}% discarded, the limit is {rules.discard_limit:.0%}"
        )
    return row.asDict()
