"""Column functions against the vectors of the data contract."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwarden.fixed_values import BLANKS
from cardwarden.functions.dates import date_key, transaction_date
from cardwarden.functions.keys import surrogate_key
from cardwarden.functions.numbers import brazilian_amount, clean_double, round4_even
from cardwarden.functions.periods import chosen_window, normalize_period, statement_month
from cardwarden.functions.text import sanitize_name

# one or more invented names for each rule: what is cut, and what only looks like it
NAMES = [
    ("41.268.903 MERCADO AZUL", "MERCADO AZUL"),
    ("41.268.903/0007-52 – mercado azul", "MERCADO AZUL"),
    ("41268903000752-MERCADO AZUL", "MERCADO AZUL"),
    ("ANA SOUSA–cpf 5*5.", "ANA SOUSA"),
    ("MERCADO AZUL cnpj : 41.268.903/0007-52", "MERCADO AZUL"),
    ("ANA SOUSA   73920518466", "ANA SOUSA"),
    ("MERCADO AZUL\t41268903000752", "MERCADO AZUL"),
    ("41.268.90 MERCADO", "41.268.90 MERCADO"),
    ("4126890300075 MERCADO", "4126890300075 MERCADO"),
    ("ANA73920518466", "ANA73920518466"),
    ("ANA 7392051846", "ANA 7392051846"),
    ("CPF DA ANA", "CPF DA ANA"),
    ("LOJA 24 HORAS - CENTRO", "LOJA 24 HORAS - CENTRO"),
    ("5 IRMAOS", "5 IRMAOS"),
    (None, "NAO INFORMADO"),
    ("\t \n", "NAO INFORMADO"),
    ("41268903000752", "NAO INFORMADO"),
    ("\x1fana\x85", "ANA"),
]


def one_column(spark, values, expression, kind="STRING"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    got = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in got]


def test_names(spark):
    assert one_column(spark, [n for n, _ in NAMES], sanitize_name) == [e for _, e in NAMES]


def test_blanks_are_those_of_the_contract():
    assert sorted(BLANKS) == [chr(i) for i in range(0x110000) if chr(i).isspace()]


@settings(max_examples=1, deadline=None, derandomize=True)
@given(st.data())
def names_at_random(found, data):
    letters = st.text("ABCDEFGHIJ LMNOçé&.'-", min_size=3, max_size=24)
    clean = letters.map(lambda t: f"{t} Z".strip(" -"))
    digits = lambda n: st.text("0123456789", min_size=n, max_size=n)
    for _ in range(300):
        name, d = data.draw(clean), data.draw(digits(14))
        dash = data.draw(st.sampled_from(["", " ", "-", " - ", " – "]))
        dotted = f"{d[:2]}.{d[2:5]}.{d[5:8]}"
        found.append((name, [
            f"{dotted}{dash}{name}", f"{dotted}/{d[8:12]}-{d[12:]}{dash}{name}", f"{d}{dash}{name}",
            f"{name}{dash}CPF: ***.{d[:3]}.{d[3:6]}-**", f"{name}{dash}Cnpj {d}", f"{name} {d[:11]}", f"{name} {d}",
        ]))


def test_names_at_random(spark):
    found = []
    names_at_random(found)
    cleaned = one_column(spark, [n for n, _ in found], sanitize_name)
    assert cleaned == [n.strip().upper() for n, _ in found]  # nothing to cut
    for rule in range(len(found[0][1])):
        attached = [with_document[rule] for _, with_document in found]
        leading = [n.lstrip(" -–") if rule < 3 else n for n, _ in found]  # blanks and a dash go with it
        assert one_column(spark, attached, sanitize_name) == [n.strip().upper() for n in leading]


@pytest.mark.parametrize("text, month, expected", [
    ("1/2026", 1, "01/2026"),
    ("12/2024", 1, "12/2024"),
    (" 007 /2024 ", 1, "07/2024"),
    ("202603", 1, "03/2026"),
    ("2025", 7, "07/2025"),
    ("a/b/c", 1, "01/2026"),
    ("lixo", 1, "01/2026"),
    (None, 7, "07/2026"),
])
def test_period(spark, text, month, expected):
    assert one_column(spark, [text], lambda c: normalize_period(c, month)) == [expected]


def test_period_with_a_word_for_a_month_raises(spark):
    with pytest.raises(Exception, match="month is not a number"):
        one_column(spark, ["jan/2026"], normalize_period)


@pytest.mark.parametrize("first, last, as_of, expected", [
    ("", "", dt.date(2026, 9, 14), ("07/2026", "09/2026")),
    ("", "", dt.date(2026, 1, 31), ("11/2025", "01/2026")),
    ("01/2024", "", dt.date(2026, 9, 1), ("07/2026", "09/2026")),
    ("01/2024", "03/2024", dt.date(2026, 9, 1), ("01/2024", "03/2024")),
])
def test_window(spark, first, last, as_of, expected):
    a, b = chosen_window(F.lit(first), F.lit(last), F.lit(as_of))
    assert tuple(spark.range(1).select(a, b).first()) == expected


@pytest.mark.parametrize("date, month, day, year_month", [
    ("12/01/2026", "202601", dt.date(2026, 1, 12), "2026-01"),
    ("1/2/2026", "1/2026", dt.date(2026, 2, 1), "2026-01"),
    ("2026-03-04 10:11:12", "03/2026", dt.date(2026, 3, 4), "2026-03"),
    (None, "03/2026", dt.date(2026, 3, 1), "2026-03"),
    ("x", "202603", dt.date(1900, 1, 1), "2026-03"),
    ("31/02/2026", "02/2026", dt.date(2026, 2, 1), "2026-02"),
    ("", "02/2026", dt.date(1900, 1, 1), "2026-02"),
    (None, None, dt.date(1900, 1, 1), None),
])
def test_dates(spark, date, month, day, year_month):
    row = spark.createDataFrame([(date, month)], "d STRING, m STRING").select(
        transaction_date(F.col("d"), F.col("m")), statement_month(F.col("m"))
    ).first()
    assert tuple(row) == (day, year_month)


def test_money(spark):
    given_texts = [
        "1.250,50", "1.250,505", "1250.50", "", "abc", "1e3", "-3,5", ".", " 7 ",
        "12345678901234567", None,
    ]
    assert one_column(spark, given_texts, brazilian_amount) == [
        Decimal("1250.50"), Decimal("1250.51"), Decimal("125050.00"), None, None, None,
        Decimal("-3.50"), None, Decimal("7.00"), None, None,
    ]


def test_keys_and_numbers(spark):
    row = spark.range(1).select(
        surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("k"),
        F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")).alias("m"),
        date_key(F.lit(dt.date(2026, 1, 5))).alias("d"),
        date_key(F.lit(None).cast("date")).alias("n"),
    ).first()
    assert row.k == row.m and (row.d, row.n) == (20260105, 19000101)
    nan = float("nan")
    assert one_column(spark, [1.5, nan, None], clean_double, "DOUBLE") == [1.5, 0.0, 0.0]


def test_rounding_equals_numpy(spark):
    import numpy as np

    values = [float(v) for v in np.random.default_rng(1).random(20000)]
    assert one_column(spark, values, round4_even, "DOUBLE") == list(np.round(values, 4))
