"""Column expressions on hand-made values."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from blotter.config import FX_RATES_TO_EUR, Config
from blotter.functions import clock, money, risk, text
from blotter.operators import features

CFG = Config(root="unused")


def values(spark, column, schema, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {schema}")
    return [row[1] for row in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_text(spark):
    assert values(spark, text.code(F.col("x")), "string", " aapl ", None) == ["AAPL", None]
    assert values(spark, text.title(F.col("x")), "string", "FX", " fixed income ") == [
        "Fx", "Fixed Income",
    ]


FX_CASES = [
    ("GBPUSD", "100", "117.00"),
    ("USDJPY", "1000", "6.30"),
    ("gbpusd", "100", "117.00"),
    ("AAPL", "100", "100.00"),
    ("EURUSD", "7.5", "7.50"),
    ("USDCHF", "100", "108.00"),
    ("AAPL", "2.6750", "2.68"),
    ("AAPL", None, None),
    (None, "5", None),
]


@pytest.mark.parametrize("joined", [False, True])
def test_fx_conversion(spark, joined):
    rows = [(i, name, n and Decimal(n)) for i, (name, n, _) in enumerate(FX_CASES)]
    df = spark.createDataFrame(rows, "i int, instrument string, notional decimal(24,4)")
    if joined:
        out = features.convert_with(df, features.fx_table(spark, CFG))
    else:
        out = features.convert(df, CFG)
    got = [row.notional_eur for row in out.orderBy("i").collect()]
    assert got == [None if eur is None else Decimal(eur) for *_, eur in FX_CASES]
    assert dict(out.dtypes)["notional_eur"] == money.AMOUNT


def test_fx_rates_may_be_empty(spark):
    df = spark.createDataFrame([("GBPUSD", Decimal(3))], "instrument string, notional decimal(24,4)")
    rate = money.rate_for(F.col("instrument"), {})
    assert df.select(money.in_eur(F.col("notional"), rate)).first()[0] == Decimal(3)
    assert set(FX_RATES_TO_EUR) == {"EURUSD", "GBPUSD", "USDJPY", "USDCHF"}


def test_signed(spark):
    df = spark.createDataFrame(
        [("BUY", Decimal(3)), ("SELL", Decimal(3)), ("HOLD", Decimal(3)), (None, Decimal(3))],
        "direction string, eur decimal(24,4)",
    )
    got = [r[0] for r in df.select(money.signed(F.col("eur"), F.col("direction"))).collect()]
    assert got == [3, -3, 0, 0]


def test_threshold_edges(spark):
    amounts = [Decimal(x) for x in ("1000000", "1000000.01", "5000000", "5000000.01")] + [None]
    eur = F.col("x")
    assert values(spark, risk.tier(eur, CFG), "decimal(24,4)", *amounts) == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW",
    ]
    assert values(spark, risk.is_large(eur, CFG), "decimal(24,4)", *amounts) == [
        False, True, True, True, None,
    ]
    assert values(spark, risk.exposure_tier(-eur, CFG), "decimal(24,4)", *amounts)[:4] == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH",
    ]


def test_hours(spark):
    hours = [7, 8, 11, 12, 15, 16, 17, 18, None]
    assert values(spark, clock.time_of_day(F.col("x")), "int", *hours) == [
        "PREMARKET", "MORNING", "MORNING", "AFTERNOON", "AFTERNOON", "CLOSE", "CLOSE",
        "AFTERHOURS", "AFTERHOURS",
    ]
    assert values(spark, clock.is_market_hours(F.col("x")), "int", 6, 7, 17, 18, None) == [
        False, True, True, False, False,
    ]


def test_calendar(spark):
    days = (date(2026, 1, 4), date(2027, 1, 1), date(2026, 1, 3))
    x = F.col("x")
    assert values(spark, F.dayofweek(x), "date", *days) == [1, 6, 7]
    assert values(spark, clock.day_name(x), "date", *days) == ["Sunday", "Friday", "Saturday"]
    assert values(spark, F.weekofyear(x), "date", *days) == [1, 53, 1]
    assert values(spark, clock.is_weekend(x), "date", *days) == [True, False, True]


def test_alert_matrix(spark):
    three = (True, False, None)
    rows = [(a, v) for a in three for v in three]
    df = spark.createDataFrame(rows, "a boolean, v boolean")
    got = [r[0] for r in df.select(risk.alert_level(F.col("a"), F.col("v"))).collect()]
    expected = [
        "CRITICAL" if a and v else "WARNING" if a or v else "NORMAL" for a, v in rows
    ]
    assert got == expected


def test_position_and_worst_alert(spark):
    net = [Decimal(5), Decimal(-5), Decimal(0), None]
    assert values(spark, risk.position(F.col("x")), "decimal(34,4)", *net) == [
        "LONG", "SHORT", "FLAT", "FLAT",
    ]
    df = spark.createDataFrame([(1, 1), (0, 2), (0, 0)], "c bigint, w bigint")
    got = [r[0] for r in df.select(risk.worst_alert(F.col("c"), F.col("w"))).collect()]
    assert got == ["CRITICAL", "WARNING", "NORMAL"]
    assert values(spark, risk.direction_multiplier(F.col("x")), "string", "BUY", "SELL", None) == [
        1, -1, 0,
    ]


def test_percent_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(201, 20000), (1, 3), (5, 0)], "n bigint, d bigint")
    got = [r[0] for r in df.select(money.percent(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("1.01"), Decimal("33.33"), None]


def test_cents_to_euros(spark):
    got = values(spark, money.cents_to_euros(F.col("x")), "bigint", 12345, 0, -250)
    assert got == [Decimal("123.45"), 0, Decimal("-2.50")]
    got = values(spark, money.cents_to_euros(F.col("x")), "decimal(18,6)", Decimal("7.5"), Decimal("1.49"))
    assert got == [Decimal("0.08"), Decimal("0.01")]
