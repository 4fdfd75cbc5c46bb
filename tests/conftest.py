from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import SparkSession

from blotter.config import Config

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path):
    return replace(Config(root="unused"), root=str(tmp_path / "lake"))


GOOD = {
    "trade_id": "t1",
    "trader_id": "TDR_001",
    "instrument": "AAPL",
    "direction": "BUY",
    "notional": 100.0,
    "price": 10.5,
    "desk": "Equities",
    "region": "EMEA",
    "counterparty": "Acme",
    "status": "EXECUTED",
    "trade_timestamp": "2026-01-05T09:30:00.000001",
    "is_anomaly": False,
}


def trade(**changes):
    """A valid raw trade with some fields changed; a field set to `...` is left out."""
    return {k: v for k, v in (GOOD | changes).items() if v is not ...}


def line(**changes):
    return json.dumps(trade(**changes))


@pytest.fixture
def bronze(spark):
    """Build a Bronze-shaped DataFrame: text fields and lineage, from raw trades."""

    def build(*trades):
        names = list(GOOD)
        rows = [
            tuple(None if t.get(n) is None else str(t[n]) for n in names) for t in trades
        ]
        schema = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame(rows, schema).selectExpr(
            "*", "TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at", "'trades_jsonl' AS _source"
        )

    return build
