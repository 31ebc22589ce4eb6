"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# What a word is made of: letters that have case.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# A word break for initcap: a private character and the space it looks for.
_BREAK = "\ue000 "


def strip(col: Column) -> Column:
    """Drop white space of any kind at both ends (SQL ``trim`` drops spaces only)."""
    return F.btrim(col, F.lit(_SPACES))


def upper_strip(col: Column) -> Column:
    return F.upper(strip(col))


def title_case(col: Column) -> Column:
    """Capital after every character that is not a letter: ``d'água`` -> ``D'Água``.

    A break goes in after each such character, ``initcap`` sets the capitals, and the
    breaks come out again. A private character of the text itself is kept: it gets a
    break of its own, and only that one is removed.
    """
    broken = F.regexp_replace(col, f"([^{_CASED}])", f"$1{_BREAK}")
    return F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))


def word_case(col: Column) -> Column:
    """Capital after white space only: ``d'água`` -> ``D'água``."""
    return F.initcap(col)


def fold_accents(col: Column) -> Column:
    """Upper-case Portuguese letters without their accents."""
    return F.translate(F.upper(col), "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ", "AAAAAEEEEIIIIOOOOOUUUUC")
