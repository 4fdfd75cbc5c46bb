"""The declared data-quality rules."""

from __future__ import annotations

from collections import Counter

import pytest

from blotter.config import Config
from blotter.operators import quality
from blotter.operators.quality import Rule
from blotter.plans import gold
from blotter.plans.silver import silver
from tests.conftest import trade

CFG = Config(root="unused")


@pytest.fixture
def tables(bronze):
    def build(*trades):
        staged = gold.staging(silver(bronze(*trades), CFG))
        full = gold.enriched(staged, CFG)
        cube = gold.activity_cube(full)
        marts = {name: build(cube, CFG) for name, build in gold.MARTS.items()}
        return {"stg_trades": staged, "int_trade_enriched": full, **marts}

    return build


def failing(report):
    return {r.rule: r.failing_rows for r in report.collect() if r.failing_rows}


def test_the_declared_rules():
    assert Counter(rule.kind for rule in quality.rules()) == {
        "not_null": 32, "accepted_values": 11, "unique": 6, "positive": 2,
    }
    assert len({rule.name for rule in quality.rules()}) == 51


def test_sound_data_pass_and_every_rule_reports(tables):
    made = tables(trade(), trade(trade_id="t2", direction="SELL", desk="FX", instrument="GBPUSD"))
    report = quality.run_suite(made)
    results = quality.enforce(report)
    assert len(results) == 51
    # One trader on two desks breaks the rule that is only reported.
    assert failing(report) == {"unique:mart_risk_exposure.trader_id": 1}


BREAKS = {
    "not_null:stg_trades.trade_date": ("stg_trades", "trade_date", "CAST(NULL AS DATE)"),
    "accepted_values:stg_trades.desk": ("stg_trades", "desk", "'FX'"),
    "accepted_values:int_trade_enriched.direction_multiplier": (
        "int_trade_enriched", "direction_multiplier", "0",
    ),
    "positive:stg_trades.notional_eur": ("stg_trades", "notional_eur", "CAST(0 AS DECIMAL(24,4))"),
    "positive:mart_daily_volume.trade_count": ("mart_daily_volume", "trade_count", "0L"),
    "accepted_values:mart_risk_exposure.position_direction": (
        "mart_risk_exposure", "position_direction", "'SIDEWAYS'",
    ),
}


@pytest.mark.parametrize("rule", BREAKS)
def test_one_violation_fails_exactly_its_rule(tables, rule):
    table, column, value = BREAKS[rule]
    made = tables(trade())
    broken = made[table].selectExpr(f"* EXCEPT ({column})", f"{value} AS {column}")
    report = quality.run_suite(made | {table: broken})
    assert failing(report) == {rule: 1}
    with pytest.raises(quality.QualityError, match=rule.split(":")[0]):
        quality.enforce(report)


def test_unique_ignores_unknown_keys(spark):
    rule = Rule("unique", "stg_trades", ("trade_id",))
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "trade_id string")
    assert [tuple(r) for r in quality.repeated_keys(df, rule).collect()] == [("a", 2)]


def test_unexpected_values_ignore_unknown(spark):
    rule = Rule("accepted_values", "stg_trades", ("status",), ("EXECUTED", "PENDING"))
    df = spark.createDataFrame([("EXECUTED",), ("X",), ("X",), (None,)], "status string")
    assert [tuple(r) for r in quality.unexpected_values(df, rule).collect()] == [("X", 2)]
    assert quality.failing_rows(df, rule).count() == 2
    with pytest.raises(ValueError):
        Rule("unique", "stg_trades", ("status",)).broken()
