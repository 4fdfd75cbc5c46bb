"""Enrichment, cube and marts on hand-made trades."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

import pytest

from blotter.config import Config
from blotter.operators import profile
from blotter.plans import gold
from blotter.plans.silver import silver
from tests.conftest import trade

CFG = Config(root="unused")


@pytest.fixture
def cube(bronze):
    def build(*trades, cfg=CFG):
        return gold.activity_cube(
            gold.enriched(gold.staging(silver(bronze(*trades), cfg)), cfg)
        )

    return build


def test_enriched_columns(bronze):
    row = gold.enriched(
        gold.staging(silver(bronze(trade(direction="SELL", notional=2_000_000)), CFG)), CFG
    ).first()
    assert row.direction_multiplier == -1
    assert (row.day_of_week, row.day_name, row.week_number) == (2, "Monday", 2)
    assert (row.is_weekend, row.exposure_tier, row.is_market_hours) == (False, "MEDIUM", True)


def test_staging_drops_cancelled(bronze):
    made = silver(bronze(trade()), CFG)
    assert gold.staging(made.replace("EXECUTED", "CANCELLED", "status")).count() == 0


def test_flat_position(cube):
    row = gold.risk_exposure(
        cube(trade(trade_id="a"), trade(trade_id="b", direction="SELL")), CFG
    ).first()
    assert row.net_exposure_eur == 0
    assert (row.position_direction, row.exposure_risk_tier) == ("FLAT", "LOW")
    assert (row.gross_long_eur, row.gross_short_eur) == (100, 100)
    assert (row.buy_trades, row.sell_trades, row.active_trading_days) == (1, 1, 1)


def test_rank_ties(cube):
    rows = gold.top_instruments(
        cube(
            trade(trade_id="a", instrument="AAPL", notional=10),
            trade(trade_id="b", instrument="MSFT", notional=10),
            trade(trade_id="c", instrument="GOLD", notional=5, is_anomaly=True),
        )
    ).collect()
    assert {r.instrument: r.volume_rank for r in rows} == {"AAPL": 1, "MSFT": 1, "GOLD": 3}
    assert {r.instrument: r.anomaly_rank for r in rows} == {"AAPL": 2, "MSFT": 2, "GOLD": 1}
    assert {r.instrument: r.volume_share_pct for r in rows} == {
        "AAPL": Decimal("40.00"), "MSFT": Decimal("40.00"), "GOLD": Decimal("20.00"),
    }


def test_zero_denominator_gives_null(cube):
    row = gold.top_instruments(cube(trade(notional=0))).first()
    assert row.total_volume_eur == 0
    assert row.buy_volume_pct is None and row.volume_share_pct is None
    assert row.anomaly_rate_pct == 0


def test_average_is_exact(cube):
    row = gold.daily_volume(
        cube(*[trade(trade_id=f"t{i}", notional=n) for i, n in enumerate((1, 1, 2))])
    ).first()
    assert row.avg_notional_eur == Decimal("1.33333333")
    assert (row.min_notional_eur, row.max_notional_eur) == (1, 2)


def test_distinct_counts_come_from_cube_cells(cube):
    row = gold.top_instruments(
        cube(
            trade(trade_id="a", trader_id="TDR_001", region="EMEA"),
            trade(trade_id="b", trader_id="TDR_002", region="APAC"),
            trade(trade_id="c", trader_id="TDR_002", region="APAC",
                  trade_timestamp="2026-01-06T10:00:00"),
        )
    ).first()
    assert (row.unique_traders, row.active_days, row.active_regions) == (2, 2, 2)


def test_flags_and_worst_alert(cube):
    trades = [trade(trade_id=f"t{i}", is_anomaly=i == 0) for i in range(3)]
    row = gold.risk_exposure(cube(*trades, cfg=replace(CFG, velocity_max_trades=2)), CFG).first()
    assert (row.has_velocity_flag, row.has_anomaly, row.has_large_trade) == (1, 1, 0)
    assert (row.has_critical_alert, row.has_warning_alert) == (1, 1)
    assert row.worst_alert_level == "CRITICAL" and row.velocity_flagged_trades == 3
    assert row.anomaly_rate_pct == Decimal("33.33")


def test_mart_types(cube):
    cells = cube(trade())
    daily = dict(gold.daily_volume(cells).dtypes)
    assert daily["total_notional_eur"] == "decimal(34,4)"
    assert daily["avg_notional_eur"] == "decimal(28,8)"
    assert daily["anomaly_rate_pct"] == "decimal(27,2)"
    risk = dict(gold.risk_exposure(cells, CFG).dtypes)
    assert risk["has_anomaly"] == "int" and risk["active_trading_days"] == "bigint"
    top = dict(gold.top_instruments(cells).dtypes)
    assert top["volume_share_pct"] == "decimal(35,2)" and top["volume_rank"] == "int"


def test_previews_keep_reading_order(cube):
    cells = cube(
        *[trade(trade_id=f"t{i}", trader_id=f"TDR_{i:03d}", notional=10 * i + 1) for i in range(7)]
    )
    top = gold.top_exposures(gold.risk_exposure(cells, CFG)).collect()
    assert [r.trader_id for r in top] == [f"TDR_{i:03d}" for i in (6, 5, 4, 3, 2)]
    assert gold.latest_days(gold.daily_volume(cells)).count() == 1
    assert gold.instrument_ranking(gold.top_instruments(cells)).columns[-1] == "volume_rank"


def test_summary_and_breakdown(bronze):
    made = silver(
        bronze(
            trade(trade_id="a"),
            trade(trade_id="b", trader_id="TDR_002", trade_timestamp="2026-02-01T00:00:00"),
            trade(trade_id="c", instrument="MSFT", status="PENDING"),
        ),
        CFG,
    )
    row = profile.silver_summary(made).first()
    assert (row.total_rows, row.traders, row.instruments) == (3, 2, 2)
    assert (str(row.first_date), str(row.last_date)) == ("2026-01-05", "2026-02-01")
    assert [tuple(r) for r in profile.breakdown(made, "status").collect()] == [
        ("EXECUTED", 2), ("PENDING", 1),
    ]
    sample = profile.sample_rows(made, 2, "trade_id", "status")
    assert (sample.count(), sample.columns) == (2, ["trade_id", "status"])
    assert profile.sample_rows(made, 5).count() == 3
    empty = profile.silver_summary(made.where("false")).first()
    assert (empty.total_rows, empty.traders) == (0, 0)


def test_flagged_traders(bronze):
    trades = [
        trade(trade_id=f"{t}{i}", trader_id=f"TDR_{t:03d}") for t in range(12) for i in range(2)
    ]
    cfg = replace(CFG, velocity_max_trades=1)
    top = profile.flagged_traders(silver(bronze(*trades), cfg)).collect()
    assert [(r.trader_id, r.flagged_trades) for r in top] == [
        (f"TDR_{t:03d}", 2) for t in range(10)
    ]
