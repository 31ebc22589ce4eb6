"""Small fixed lookups as expressions, so that they need no join and no UDF."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from .text import fold_accents, strip


def lookup(col: Column, table: Mapping[str, str], default: str) -> Column:
    """Value of ``table`` under ``col``, else ``default``."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(literal, col), F.lit(default))


def state_of_place(col: Column) -> Column:
    """``PERNAMBUCO (UF)`` -> ``PE``; anything that is not a state -> ``NA``."""
    name = F.upper(strip(F.replace(col, F.lit(" (UF)"), F.lit(""))))
    return lookup(name, S.STATE_CODES, S.NO_STATE)


def state_of_place_loose(col: Column) -> Column:
    """As above from the text before ``(``, whatever its accents."""
    folded = {_plain(name): code for name, code in S.STATE_CODES.items()}
    name = fold_accents(strip(F.substring_index(col, "(", 1)))
    return lookup(name, folded, S.NO_STATE)


def _plain(name: str) -> str:
    return name.translate(str.maketrans("ÁÂÃÉÍÓÔ", "AAAEIOO"))


def region_of_state(col: Column) -> Column:
    table = {state: region for region, states in S.REGION_STATES.items() for state in states}
    return lookup(col, table, S.NATIONAL)


def theme_of_function(col: Column) -> Column:
    return lookup(col, S.THEMES, S.OTHER_THEME)


def period_of_year(col: Column, turning_year: int = 2023) -> Column:
    before, during, after = S.PERIOD_LABELS
    return F.when(col < turning_year, before).when(col == turning_year, during).otherwise(after)


def simple_type(col: Column, patterns: Mapping[str, str] | None = None) -> Column:
    """First label whose pattern occurs in the text, whatever its case."""
    patterns = patterns or {label: label for label in S.TYPE_LABELS}
    chosen = F.lit(S.OTHER_TYPE)
    for label, word in reversed(patterns.items()):
        chosen = F.when(col.ilike(f"%{word}%"), label).otherwise(chosen)
    return chosen
