import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest

from factloom.operators.units import _whole_money, read_amount, segment, to_common_currency
from pyspark.sql import functions as F

SOURCES = [("HKF", "002", "HKD"), ("USA", "001", "USD")]
RATES = [("HKD", Decimal("1.0000")), ("USD", Decimal("7.8013")), ("JPY", Decimal("0.0517")), ("MYR", Decimal("1.7653"))]


@pytest.mark.parametrize(
    ("text", "power", "currency"),
    [("HK$'000", 3, "HKD"), ("人民幣百萬元", 6, "CNY"), ("US$ mn", 6, "USD"), ("千港元", 3, "HKD"), ("RM", None, "MYR"), ("RM'000", 3, "MYR"), ("十億元", 9, None), ("in thousands", 3, None), ("單位：元", None, None), ("m", 6, None), ("004", 6, None), ("港幣’000", 3, "HKD"), ("RMBmillion", 6, "CNY"), ("百万新加坡元", 6, "SGD")],
)
def test_segments(text, power, currency):
    got = segment(text)
    assert got[:2] == (power, currency)
    assert got[3]


@pytest.mark.parametrize("text", [None, "", "  ", "bond", "未披露", "abc元x"])
def test_unreadable_units(text):
    assert segment(text) == (None, None, False, False)


def test_dimension_prior():
    assert segment("m", "money")[0] == 6
    assert segment("m", "length")[0] is None


@pytest.mark.parametrize(
    ("text", "number", "words"),
    [("(1,234)千元", "-1234", "千元"), ("-42.29百萬元", "-42.29", "百萬元"), ("HK$1.522 million", "1.522", "HK$ million"), ("２，４４２．３", "2442.3", ""), ("765 000", "765000", ""), ("(RMB5.2 million)", "-5.2", "RMB million"), ("RMB(5.2)million", "-5.2", "RMB million"), ("-HK$5m", "-5", "HK$ m"), ("5-", "-5", "")],
)
def test_amounts(text, number, words):
    num, rest = read_amount(text)
    assert num == number
    assert " ".join(rest.split()) == words


@pytest.mark.parametrize("text", [None, "", "-", "—", "n/a", "1,7", "1,23,4", "x" * 10_000])
def test_no_amounts(text):
    assert read_amount(text)[0] is None


def _run(spark, rows):
    flat = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, source_code string, mbrevenue string, unit string, currency string").selectExpr("*", "1 AS scale", "'x' AS amount", "'y' AS hkd_rate")
    src = spark.createDataFrame(SOURCES, "source_code string, default_unit string, default_currency string")
    rates = spark.createDataFrame(RATES, "currency_code string, hkd_rate decimal(12,4)")
    return {r.row_id: (r.currency_code, r.amount_hkd) for r in to_common_currency(flat, src, rates).collect()}


def test_order_of_sources_and_rounding(spark):
    got = _run(spark, [
        ("HKF", "1,000", None, None), ("HKF", "1,000", "元", None), ("HKF", "1000千元", "百萬元", None), ("HKF", "1000百萬元", " ", None), ("USA", "0.5", None, None), ("USA", "-0.5", "單位：元", "JPY"),
        ("HKF", "10", "US$", None), ("HKF", "US$10", None, None), ("HKF", "10", "US$", "RM"), ("USA", "(1.5)", "001", "HKD"), ("USA", "2.5", "001", "HKD"), ("HKF", None, None, None), ("HKF", "—", None, None), ("nobody", "5", None, None), ("nobody", "5", "001", "HKD"), ("HKF", "5", None, "EUR"),
    ])
    assert got == {
        0: ("HKD", 1_000_000), 1: ("HKD", 1000), 2: ("HKD", 1_000_000_000), 3: ("HKD", 1_000_000_000), 4: ("USD", 4), 5: ("JPY", 0), 6: ("USD", 78), 7: ("USD", 78013), 8: ("MYR", 18), 9: ("HKD", -2), 10: ("HKD", 3), 14: ("HKD", 5),
    }


def test_many_decimals_and_digits(spark):
    got = _run(spark, [("USA", "0.019288791", "bn", "USD"), ("USA", "0.0000000004", "bn", "HKD"), ("USA", "1234567890123456", "001", "HKD"), ("USA", "99999999999999999999", "001", "HKD"), ("USA", "9" * 60, "004", "HKD")])
    assert got == {0: ("USD", 150477645), 1: ("HKD", 0), 2: ("HKD", 1234567890123456)}


def test_empty(spark):
    assert _run(spark, [(None, None, None, None)]) == {}


def test_whole_money_is_exact(spark):
    rng = random.Random(4)
    cases = [("0.5", 0, "1.0000"), ("-0.5", 0, "1.0000"), ("2.5", 0, "1.0000"), ("1234567890123456789", 0, "1.0000"), ("9223372036854775807", 0, "1.0000"), ("9223372036854775808", 0, "1.0000"), ("123456789012345678.5", 0, "7.7812"), ("0.000000000000000049", 12, "99999999.9999")]
    for _ in range(400):
        cases.append((rng.choice(["", "-"]) + str(rng.randint(0, 10 ** rng.randint(1, 17))) + rng.choice(["", "." + "".join(rng.choices("0123456789", k=rng.randint(1, 20)))]), rng.choice([0, 3, 4, 6, 8]), f"{rng.randint(1, 99)}.{rng.randint(0, 9999):04d}"))
    df = spark.createDataFrame([(i, a, s, Decimal(r)) for i, (a, s, r) in enumerate(cases)], "i int, a string, s int, r decimal(12,4)")
    got = {r.i: r.m for r in df.select("i", _whole_money(F.col("a"), F.col("s"), F.col("r")).alias("m")).collect()}
    with localcontext() as exact:
        exact.prec = 80
        for i, (a, s, r) in enumerate(cases):
            want = int((Decimal(a) * 10**s * Decimal(r)).quantize(Decimal(1), ROUND_HALF_UP))
            assert got[i] == (want if abs(want) < 2**63 else None), (a, s, r)
