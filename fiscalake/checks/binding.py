"""The test tables seen as spending records; one order is one record.

author = customer, type = market segment, place = nation, function = order priority,
subfunction = order status, committed = order total; liquidated, paid and carried-over
amounts are sums over the order's lines. Orders without lines have no amounts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lookups import lookup, period_of_year, simple_type
from ..functions.text import upper_strip
from ..plans import cleaning, features, mart, serving
from ..rules import Rules
from ..schemas import MONEY, NATIONAL, NO_STATE, RAW_COLUMNS
from ..staging import found, stage

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Nation i lies in region i modulo 5. The nations of the last region stand for places
# without a state code.
STATES = {f"NATION_{i}": f"N{i:02d}" for i in range(25) if i % 5 < 4}
STATE_REGIONS = {f"N{i:02d}": REGIONS[i % 5] for i in range(25) if i % 5 < 4}
THEMES = {"1-Urgent": "Social", "2-High": "Social", "3-Medium": "Infraestrutura", "5-Low": "Segurança"}
TYPES = {"Individual": "household", "Comissão": "build", "Bancada": "auto"}


def _state(place: Column) -> Column:
    return lookup(upper_strip(place), STATES, NO_STATE)


RULES = Rules(
    first_year=1996,
    last_year=2000,
    state_of=_state,
    state_of_loose=_state,
    region_of=lambda state: lookup(state, STATE_REGIONS, NATIONAL),
    theme_of=lambda function: lookup(function, THEMES, "Outros"),
    period_of=lambda year: period_of_year(year, 1998),
    type_of=lambda kind: simple_type(kind, TYPES),
    northeast="ASIA",
    north="EUROPE",
)

# A total order among copies of a code.
POSITION = ["ano", "autor", "valorEmpenhado"]


_schemas: dict[tuple, StructType] = {}


def _state_of(spark: SparkSession, path: str) -> tuple:
    """What is there now, and since when: what is remembered of other files is not used."""
    return tuple(sorted(found(spark, path)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the files once, not by every query."""
    path = f"{folder}/{name}.parquet"
    state = _state_of(spark, path)
    if state not in _schemas:
        _schemas[state] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[state]).parquet(path)


def _hundredths(name: str) -> Column:
    """A two-place double as a whole number."""
    return F.floor(F.col(name) * 100 + 0.5)


def _money(units: Column, scale: int) -> Column:
    """Whole units of 10**-scale as money."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(MONEY)


def line_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """The five line-based amounts of each order.

    Lines are the largest table, so they are summed as whole hundredths, which is exact
    and many times faster than decimals. A long holds more than the money type does.
    """
    price = _hundredths("l_extendedprice")
    net = price * (100 - _hundredths("l_discount"))

    def total(amount: Column, column: str, value: str) -> Column:
        return F.sum(F.when(F.col(column) == value, amount).otherwise(0))

    sums = {
        "valorLiquidado": (F.sum(price), 2),
        "valorPago": (total(net, "l_linestatus", "F"), 4),
        "valorRestoInscrito": (total(price, "l_returnflag", "N"), 2),
        "valorRestoCancelado": (total(price, "l_returnflag", "R"), 2),
        "valorRestoPago": (total(price, "l_returnflag", "A"), 2),
    }
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(*[units.alias(name) for name, (units, _) in sums.items()])
        .withColumns({name: _money(F.col(name), scale) for name, (_, scale) in sums.items()})
    )


def records(spark: SparkSession, folder: str, rules: Rules | None = None) -> DataFrame:
    """All orders as raw records, with amounts already numeric. With ``rules``, only those
    of the valid years, as a range of dates that reaches the files."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey"
    )
    orders = table(spark, folder, "orders")
    if rules:
        first, after = f"{rules.first_year}-01-01", f"{rules.last_year + 1}-01-01"
        orders = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < after))
    orders = orders.join(line_amounts(spark, folder), "o_orderkey", "left")
    joined = orders.join(customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("codigoEmenda"),
        F.year("o_orderdate").cast("long").alias("ano"),
        F.col("c_mktsegment").alias("tipoEmenda"),
        F.col("c_name").alias("autor"),
        F.col("c_name").alias("nomeAutor"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("numeroEmenda"),
        F.col("n_name").alias("localidadeDoGasto"),
        F.col("o_orderpriority").alias("funcao"),
        F.col("o_orderstatus").alias("subfuncao"),
        _money(_hundredths("o_totalprice"), 2).alias("valorEmpenhado"),
        *RAW_COLUMNS[10:],
    )


class Layers:
    """The layers over one data folder, each written once on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._done: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._done:
            self._done[name] = make()
        return self._done[name]

    @property
    def records(self) -> DataFrame:
        """The raw layer: both cleaning flavours, contract and accounting start here."""
        return self._once("records", lambda: stage(records(self.spark, self.folder), "records")).df

    @property
    def trusted_plan(self) -> DataFrame:
        """Trusted rows straight from the source tables, for a single consumer; from the raw
        layer if that is written already."""
        if "records" in self._done:
            return cleaning.trusted_zero(cleaning.in_window(self.records, RULES), POSITION, RULES)
        return cleaning.trusted_zero(records(self.spark, self.folder, RULES), POSITION, RULES)

    @property
    def trusted(self) -> DataFrame:
        return self._once("trusted", lambda: stage(self.trusted_plan, "trusted")).df

    @property
    def star(self) -> mart.Star:
        """The dimensions, written, and the fact as a plan over them."""
        return self._once("star", lambda: mart.build(self.trusted, RULES))

    @property
    def serving(self) -> DataFrame:
        """Trusted rows with their KPIs. Result sets without a dimension key start here:
        regions, themes and types are functions of columns the rows already have."""
        return mart.with_kpis(self.trusted, RULES)

    @property
    def cube(self) -> DataFrame:
        """What the dashboard's figures add up, as a layer of its own."""
        return self._once("cube", lambda: stage(serving.cube(self.serving), "cube")).df

    @property
    def features(self) -> DataFrame:
        """The feature table as a layer of its own, as it is published."""
        return self._once("features", lambda: stage(features.features(self.serving, RULES), "features")).df


_open: dict[tuple, Layers] = {}


def layers(spark: SparkSession, folder: str, fresh: bool = False) -> Layers:
    """The layers of the tables now in ``folder`` in this session; ``fresh`` starts over."""
    key = (spark.sparkContext.applicationId, folder, _state_of(spark, f"{folder}/*.parquet"))
    if fresh or key not in _open:
        _open[key] = Layers(spark, folder)
    return _open[key]
