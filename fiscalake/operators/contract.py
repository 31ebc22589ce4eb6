"""Declarative data contracts, checked in one pass and blocking when violated."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import NUMBER, bad_money


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType = T.StringType()
    nullable: bool = True
    allowed: Sequence | None = None
    money: bool = False
    optional: bool = False


@dataclass(frozen=True)
class Contract:
    """Required columns. Columns it does not name are let through."""

    fields: Sequence[Field] = field(default_factory=list)
    min_rows: int = 1


class ContractViolation(ValueError):
    """A blocking failure that names every violated rule, and some of the rows of each:
    ``cases`` holds (column, rule, place among them, position, value)."""

    def __init__(self, found: list[tuple[str, str, int]], cases: list[tuple[str, str, int, str, str]] = ()):
        self.found, self.cases = found, list(cases)
        shown = {(column, rule): [] for column, rule, _ in found}
        for column, rule, _, position, value in self.cases:
            shown[column, rule].append(f"{value!r} at {position}")
        told = [f"{c}: {r} ({n}{''.join(f', {case}' for case in shown[c, r])})" for c, r, n in found]
        super().__init__("; ".join(told))


# What text must look like to be read as a whole number. A cast that fails costs many times
# as much as one that succeeds, so text that cannot be cast is not tried.
_WHOLE = r"^[\x00-\x20]*[+-]?\d+[\x00-\x20]*$"


def converted(col: Column, present: T.DataType, wanted: T.DataType) -> Column:
    """``col`` in the wanted type, NULL where it does not convert."""
    if isinstance(present, T.StringType) and isinstance(wanted, T.IntegralType):
        return F.when(col.rlike(_WHOLE), col.try_cast(wanted))
    if isinstance(present, T.StringType) and isinstance(wanted, T.DecimalType):
        return F.when(col.rlike(NUMBER), col.try_cast(wanted))
    return col if present == wanted else col.try_cast(wanted)


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns in their declared types; a value that does not convert is NULL."""
    types = {f.name: f.dataType for f in df.schema}
    casts = {
        f.name: converted(F.col(f.name), types[f.name], f.dtype)
        for f in contract.fields
        if f.name in types and types[f.name] != f.dtype
    }
    return df.withColumns(casts) if casts else df


def _tests(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(column, rule, whether a row violates it) for each rule that rows can violate."""
    schema = {f.name: f.dataType for f in df.schema}
    tests: list[tuple[str, str, Column]] = []
    for f in contract.fields:
        if f.name not in schema:
            continue
        raw = F.col(f.name)
        value = converted(raw, schema[f.name], f.dtype)
        tests.append((f.name, "type", raw.isNotNull() & value.isNull()))
        if not f.nullable:
            tests.append((f.name, "null", raw.isNull()))
        if f.allowed is not None:
            tests.append((f.name, "domain", value.isNotNull() & ~value.isin(list(f.allowed))))
        if f.money:
            tests.append((f.name, "money", bad_money(raw, schema[f.name])))
    return tests


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """(column, rule, rows) for every rule of the contract, violated or not.

    All rules are conditional counts of one aggregation. Rules: ``missing`` column,
    ``type`` that does not convert, ``null``, ``domain``, ``money`` text, ``empty`` set.
    """
    missing = [f.name for f in contract.fields if f.name not in df.columns and not f.optional]
    rules = [(column, rule, F.count_if(test)) for column, rule, test in _tests(df, contract)]
    rules += [(column, "missing", F.lit(1)) for column in missing]
    rules.append(("*", "empty", F.when(F.count(F.lit(1)) < contract.min_rows, 1).otherwise(0)))
    counts = df.agg(*[rule.cast("long").alias(f"r{i}") for i, (_, _, rule) in enumerate(rules)])
    entries = [
        F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("rows"))
        for i, (column, rule, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    return check(df, contract).where("rows > 0")


def failure_cases(df: DataFrame, contract: Contract, position: Sequence[str], first: int = 3) -> DataFrame:
    """(column, rule, place, position, value): of each rule the ``first`` rows that violate
    it, in the order of the columns ``position``, with the value as text.

    Only violating cells leave a row, and each task keeps the first of a rule before they
    meet (``WindowGroupLimit``): a rule that every row violates moves a few rows per task."""
    place = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(position)])
    shown = F.concat_ws("/", *[F.col(c).cast("string") for c in position])
    cells = [
        F.when(
            F.coalesce(test, F.lit(False)),
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), F.col(column).cast("string").alias("value")),
        )
        for column, rule, test in _tests(df, contract)
    ]
    broken = df.select(place.alias("_place"), shown.alias("position"), F.filter(F.array(*cells), lambda c: c.isNotNull()).alias("_cells"))
    each = broken.select("_place", "position", F.inline("_cells"))
    order = Window.partitionBy("column", "rule").orderBy("_place", "value")
    ranked = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= first)
    return ranked.select("column", "rule", "place", "position", "value")


def enforce(df: DataFrame, contract: Contract, position: Sequence[str] = (), first: int = 3) -> DataFrame:
    """The coerced table, or :class:`ContractViolation`. Collects one row per rule; only a
    violated contract is read once more, for the ``first`` cases of each rule in the order
    of the columns ``position``, if there are any."""
    found = [tuple(r) for r in violations(df, contract).collect()]
    if found:
        cases = []
        if position:
            cases = [tuple(r) for r in failure_cases(df, contract, position, first).collect()]
        raise ContractViolation(sorted(found), sorted(cases))
    return coerce(df, contract)
