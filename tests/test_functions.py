import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalake.functions import lookups, money, text
from fiscalake.schemas import REGION_STATES, STATE_CODES


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", expression(F.col("v")).alias("out")).collect()
    return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]


AMOUNTS = ["1.234,56", "", None, "nan", "None", "abc", "-1.234,56", " 12,50 ", "0,00", "1.000.000", "7"]


def test_money_with_zero_for_missing(spark):
    got = column(spark, AMOUNTS, lambda c: money.money_or_zero(c).cast("double"))
    assert got == [1234.56, 0, 0, 0, 0, 0, -1234.56, 12.5, 0, 1000000, 7]


def test_money_with_null_for_unreadable(spark):
    got = column(spark, AMOUNTS, lambda c: money.money_or_null(c).cast("double"))
    assert got == [1234.56, None, None, None, None, None, -1234.56, 12.5, 0, 1000000, 7]


def test_only_unreadable_text_is_bad_money(spark):
    got = column(spark, AMOUNTS, money.bad_money)
    assert [v for v, bad in zip(AMOUNTS, got) if bad] == ["abc"]


def test_numbers_are_not_read_as_brazilian_text(spark):
    got = column(spark, [1234.56, None], lambda c: money.money_or_zero(c, T.DoubleType()), "double")
    assert got == [Decimal("1234.5600"), Decimal("0.0000")]


@pytest.mark.parametrize(
    ("expression", "value", "expected"),
    [
        (money.format_number_br, 1234567.0, "1.234.567"),
        (money.format_money_br, 1234567.0, "R$ 1.234.567"),
        (lambda c: money.format_number_br(c, 2), 1234.5, "1.234,50"),
        (money.format_pct_br, 62.37, "62,4%"),
        (money.format_pct_br, 1234.0, "1234,0%"),
    ],
)
def test_brazilian_formats(spark, expression, value, expected):
    assert column(spark, [value], expression, "double") == [expected]


def test_parsing_reverses_formatting(spark):
    values = [0.0, 0.01, 999.99, 1000.0, 123456789.12, -5.5]
    got = column(spark, values, lambda c: money.money_or_zero(money.format_number_br(c, 2)).cast("double"), "double")
    assert got == values


TITLES = [
    "d'água pós-graduação",
    "SAÚDE",
    "1a2b c_d",
    "",
    None,
    "  duas  palavras ",
    "ÇA (uf)",
    "a\tb\nc",
    "x y",
    "z  w",
    "ação/ética 3º ano",
]


def test_title_case_is_pythons(spark):
    assert column(spark, TITLES, text.title_case) == [t if t is None else t.title() for t in TITLES]


def test_word_case_starts_after_spaces_only(spark):
    assert column(spark, ["d'água pós-graduação"], text.word_case) == ["D'água Pós-graduação"]


def test_strip_is_pythons(spark):
    padded = ["\t a b \n", " x　", "", None, "a", " \x1f\x85 "]
    assert column(spark, padded, text.strip) == [p if p is None else p.strip() for p in padded]


def test_every_state_is_found(spark):
    places = [f"{name} (UF)" for name in STATE_CODES]
    assert column(spark, places, lookups.state_of_place) == list(STATE_CODES.values())
    assert column(spark, places, lookups.state_of_place_loose) == list(STATE_CODES.values())


def test_other_places_have_no_state(spark):
    places = ["Nacional", "FORTALEZA - CE", None, "", "CEARA (UF)", "ceará (UF)"]
    assert column(spark, places, lookups.state_of_place) == ["NA", "NA", "NA", "NA", "NA", "CE"]
    assert column(spark, places, lookups.state_of_place_loose) == ["NA", "NA", "NA", "NA", "CE", "CE"]


def test_regions_cover_all_states(spark):
    assert sorted(s for states in REGION_STATES.values() for s in states) == sorted(STATE_CODES.values())
    assert column(spark, ["CE", "SP", "NA", None], lookups.region_of_state) == [
        "Nordeste",
        "Sudeste",
        "Nacional",
        "Nacional",
    ]


def test_themes_periods_and_types(spark):
    themes = column(spark, ["Saúde", "Transporte", "Defesa Nacional", "Defesa nacional", None], lookups.theme_of_function)
    assert themes == ["Social", "Infraestrutura", "Segurança", "Outros", "Outros"]
    assert column(spark, [2022, 2023, 2024], lookups.period_of_year, "int") == [
        "Pré-Pandemia/Pandemia",
        "Pós-Pandemia",
        "Atual",
    ]
    kinds = ["EMENDA DE COMISSÃO", "individual de bancada", "Bancada", "relator", None]
    assert column(spark, kinds, lookups.simple_type) == ["Comissão", "Individual", "Bancada", "Outro", "Outro"]


def test_rates_and_showcase_edges(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (100.0, 10.0), (100.0, 9.99), (1000.0, 0.0), (1000.01, 0.0), (3.0, 1.0), (100.0, None)],
        "committed double, paid double",
    )
    paid, committed = F.col("paid"), F.col("committed")
    rate = money.execution_rate(paid, committed)
    rows = df.select(
        rate.alias("rate"),
        money.is_showcase(paid, committed, 0.1).alias("flag"),
        money.is_showcase_for_display(committed, rate).alias("shown"),
    ).collect()
    assert [r["rate"] for r in rows] == [0, 10, 9.99, 0, 0, 33.33, None]
    assert [r["flag"] for r in rows] == [False, False, True, True, True, False, False]
    assert [r["shown"] for r in rows[:6]] == [False, False, False, False, True, False]


def test_case_and_strip_on_random_text(spark):
    chooser = random.Random(7)
    alphabet = "aAbBzZ çÇãÃéÉíÓõÜ ñß'’-–_./()&0123º ª\t\n\r\x1f\x85  　"
    values = ["".join(chooser.choices(alphabet, k=chooser.randint(0, 14))) for _ in range(5000)]
    assert column(spark, values, text.title_case) == [v.title() for v in values]
    assert column(spark, values, text.upper_strip) == [v.strip().upper() for v in values]
