"""Schemas found in records, and their differences from the contract."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from blotter.sources import drift
from tests.conftest import line, trade


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_schema_is_inferred(spark):
    rows = lines(spark, line(), line(extra={"a": [1, 2]}), line(notional="12.5"), "{oops", "[1]", "7", " ")
    found = drift.infer(rows)
    kinds = dict(found.dtypes)
    assert kinds["trade_id"] == "string" and kinds["is_anomaly"] == "boolean"
    assert kinds["extra"] == "struct<a:array<bigint>>" and kinds["notional"] == "variant"
    assert found.count() == 3
    assert sorted(str(r.extra.a) for r in found.collect() if r.extra) == ["[1, 2]"]
    assert drift.infer(lines(spark, "x")).columns == []


def test_differences_from_the_contract(spark):
    rows = lines(
        spark,
        line(),
        line(price=..., venue="X", counterparty=7),
        line(desk=None, is_anomaly="false"),
        json.dumps(trade() | {"it's": [1]}),
    )
    found = {r.field: r for r in drift.drift(drift.variants(rows)).collect()}
    assert (found["venue"].status, found["venue"].n_present, found["venue"].n_missing) == ("added", 1, 3)
    assert found["it's"].kinds == "array"
    assert (found["price"].status, found["price"].n_missing) == ("missing", 1)
    assert (found["counterparty"].status, found["counterparty"].n_unexpected) == ("retyped", 1)
    assert found["counterparty"].kinds == "number,string"
    assert (found["desk"].status, found["desk"].kinds) == ("as_declared", "null,string")
    assert found["is_anomaly"].status == "as_declared" and len(found) == 14


def test_no_records(spark):
    found = drift.drift(drift.variants(lines(spark, "x"))).collect()
    assert len(found) == 12 and all(r.n_present == 0 and r.status == "as_declared" for r in found)
    assert drift.infer_schema(drift.variants(lines(spark)).where(F.lit(False))) is None
