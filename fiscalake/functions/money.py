"""Brazilian money text, number formats and guarded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY
from .text import strip

# Texts that stand for "no amount".
BLANK_AMOUNTS = ["", "nan", "None"]


# What plain text must look like to be read as a number.
_BLANKS = r"[\x00-\x20]*"
NUMBER = rf"^{_BLANKS}[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{_BLANKS}$"


def _plain_number(col: Column) -> Column:
    """``1.234,56`` -> ``1234.56``."""
    return F.replace(F.replace(col, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def _as_money(col: Column, dtype: T.DataType) -> Column:
    # Only text carries Brazilian separators; a numeric column is already a number, and
    # taking its decimal point for a thousands separator would multiply it by a hundred.
    if not isinstance(dtype, T.StringType):
        return col.try_cast(MONEY)
    plain = _plain_number(col)
    # Casts that fail are slow; text that is no number is not tried.
    return F.when(plain.rlike(NUMBER), plain.try_cast(MONEY))


def money_or_null(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Parse money; anything unreadable becomes NULL."""
    return _as_money(col, dtype)


def money_or_zero(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Parse money; missing amounts become 0. Unreadable text also yields 0, so run
    the contract first: it counts such text through :func:`bad_money`."""
    return F.coalesce(_as_money(col, dtype), F.lit(Decimal(0)).cast(MONEY))


def bad_money(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    """True where text is present but is not an amount, or a number is too large for one."""
    if not isinstance(dtype, T.StringType):
        return col.isNotNull() & _as_money(col, dtype).isNull()
    present = ~strip(_plain_number(col)).isin(BLANK_AMOUNTS)
    return F.coalesce(present & _as_money(col, dtype).isNull(), F.lit(False))


def swap_separators(text: Column) -> Column:
    """``1,234.5`` <-> ``1.234,5``."""
    return F.translate(text, ",.", ".,")


def format_number_br(col: Column, places: int = 0) -> Column:
    """1234567 -> ``1.234.567``."""
    return swap_separators(F.format_number(col, places))


def format_money_br(col: Column, places: int = 0) -> Column:
    """1234567 -> ``R$ 1.234.567``."""
    return F.concat(F.lit("R$ "), format_number_br(col, places))


def format_pct_br(col: Column, places: int = 1) -> Column:
    """62.37 -> ``62,4%``; no thousands separator."""
    plain = F.replace(F.format_number(col, places), F.lit(","), F.lit(""))
    return F.concat(F.replace(plain, F.lit("."), F.lit(",")), F.lit("%"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double that yields NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def execution_rate(paid: Column, committed: Column, places: int | None = 2) -> Column:
    """Paid as a percentage of committed; 0 where nothing was committed."""
    rate = ratio(paid, committed) * 100
    if places is not None:
        rate = F.round(rate, places)
    return F.when(committed > 0, rate).otherwise(F.lit(0.0))


def is_showcase(paid: Column, committed: Column, below: float) -> Column:
    """Committed but hardly paid. A missing amount is not a showcase."""
    return F.coalesce((committed > 0) & (ratio(paid, committed) < below), F.lit(False))


def is_showcase_for_display(committed: Column, rate: Column, over: int = 1000, below_pct: int = 10) -> Column:
    """The dashboard's rule: sizeable amounts whose (rounded) rate is low."""
    return (committed > over) & (rate < below_pct)


def exact_sum(col: Column) -> Column:
    """Sum money exactly, then expose it as a double. Decimals make the result
    independent of the order in which partitions arrive."""
    return F.sum(col.cast(MONEY)).cast("double")


def exact_mean(col: Column) -> Column:
    """Mean over the non-null values, from an exact sum."""
    return F.try_divide(F.sum(col.cast(MONEY)).cast("double"), F.count(col))
