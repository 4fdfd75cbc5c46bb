"""Data-quality rules, declared per table and evaluated with few passes.

All null, value and sign rules of a table share one aggregate, and all its uniqueness rules one
grouped count of keys. A rule reports its number of failing rows, zero included.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions import clock, risk

# The rules of each table.
NOT_NULL = {
    "stg_trades": (
        "trade_id", "trader_id", "notional_eur", "desk", "time_of_day", "trade_date",
        "trade_timestamp",
    ),
    "int_trade_enriched": (
        "trade_id", "direction_multiplier", "day_of_week", "exposure_tier", "is_market_hours",
        "is_weekend",
    ),
    "mart_daily_volume": (
        "trade_date", "desk", "instrument", "trade_count", "total_notional_eur",
        "anomaly_rate_pct", "buy_pct", "sell_pct",
    ),
    "mart_risk_exposure": (
        "trader_id", "net_exposure_eur", "exposure_risk_tier", "worst_alert_level",
        "position_direction", "anomaly_rate_pct",
    ),
    "mart_top_instruments": (
        "instrument", "total_volume_eur", "volume_rank", "anomaly_rate_pct", "volume_share_pct",
    ),
}
ACCEPTED = {
    "stg_trades": {
        "direction": ("BUY", "SELL"),
        "status": ("EXECUTED", "PENDING"),
        "risk_tier": risk.TIERS,
        "alert_level": risk.ALERTS,
        # A desk is title-cased by the cleaning step, hence `Fx`.
        "desk": ("Fx", "Equities", "Commodities", "Fixed Income"),
        "time_of_day": (*[name for _, name in clock.DAY_PARTS], clock.AFTER_CLOSE),
    },
    "int_trade_enriched": {"direction_multiplier": (1, -1), "exposure_tier": risk.TIERS},
    "mart_risk_exposure": {
        "exposure_risk_tier": risk.TIERS,
        "worst_alert_level": risk.ALERTS,
        "position_direction": risk.POSITIONS,
    },
}
UNIQUE = {
    "stg_trades": (("trade_id",),),
    "int_trade_enriched": (("trade_id",),),
    "mart_risk_exposure": (("trader_id",), ("trader_id", "desk", "region")),
    "mart_top_instruments": (("instrument",), ("volume_rank",)),
}
POSITIVE = {"stg_trades": ("notional_eur",), "mart_daily_volume": ("trade_count",)}

# These two contradict their table: a trader has a row per desk and region, and equal volumes
# share a rank. They are reported, but sound data breaks them, so they do not block the export.
REPORT_ONLY = frozenset(
    {"unique:mart_risk_exposure.trader_id", "unique:mart_top_instruments.volume_rank"}
)


@dataclass(frozen=True)
class Rule:
    kind: str
    table: str
    columns: tuple[str, ...]
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{'+'.join(self.columns)}"

    @property
    def blocking(self) -> bool:
        return self.name not in REPORT_ONLY

    def broken(self) -> Column:
        """Whether a row breaks the rule. An unknown value breaks only `not_null`."""
        column = F.col(self.columns[0])
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.values)
        if self.kind == "positive":
            return column <= 0
        raise ValueError(f"{self.kind} is not a rule about single rows")


def rules(kinds: Iterable[str] | None = None) -> list[Rule]:
    """The declared rules, all or only those of some kinds."""
    declared = [
        Rule("not_null", table, (column,)) for table, columns in NOT_NULL.items() for column in columns
    ]
    declared += [
        Rule("accepted_values", table, (column,), tuple(values))
        for table, by_column in ACCEPTED.items()
        for column, values in by_column.items()
    ]
    declared += [Rule("unique", table, key) for table, keys in UNIQUE.items() for key in keys]
    declared += [
        Rule("positive", table, (column,)) for table, columns in POSITIVE.items() for column in columns
    ]
    wanted = None if kinds is None else set(kinds)
    return [rule for rule in declared if wanted is None or rule.kind in wanted]


def unexpected_values(df: DataFrame, rule: Rule) -> DataFrame:
    """The values an `accepted_values` rule rejects, with their rows. Unknown values pass."""
    return df.where(rule.broken()).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n_rows"))


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break a rule about single rows."""
    return df.where(rule.broken())


def repeated_keys(df: DataFrame, rule: Rule) -> DataFrame:
    """The keys a `unique` rule finds more than once. Unknown keys pass."""
    return (
        df.dropna(subset=list(rule.columns))
        .groupBy(*rule.columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def _report(counts: DataFrame, places: Mapping[Rule, int]) -> DataFrame:
    """Turn one row with counts `_0`, `_1` ... into one row per rule."""
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.blocking).alias("blocking"),
            F.col(f"_{place}").alias("failing_rows"),
        )
        for rule, place in places.items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def _repeated_counts(df: DataFrame, keys: Sequence[tuple[str, ...]]) -> DataFrame:
    """One row: how many values each key has more than once, from one pass over the rows."""
    if len(keys) == 1:
        values = df.dropna(subset=list(keys[0])).groupBy(*keys[0])
        return values.agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("_0"))
    entries = [
        F.when(
            reduce(and_, [F.col(name).isNotNull() for name in key]),
            F.struct(
                F.lit(place).alias("key"),
                F.array(*[F.col(name).cast("string") for name in key]).alias("value"),
            ),
        )
        for place, key in enumerate(keys)
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.key", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.agg(
        *[
            F.count_if((F.col("key") == place) & (F.col("n") > 1)).alias(f"_{place}")
            for place in range(len(keys))
        ]
    )


# A table whose rows are those of another table, which has all its columns too.
SAME_ROWS = {"stg_trades": "int_trade_enriched"}


def run_suite(
    tables: Mapping[str, DataFrame],
    kinds: Iterable[str] | None = None,
    same_rows: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row (rule, blocking, failing_rows) per declared rule about the given tables.

    A table is read at most twice: once for all rules about single rows, once for all its keys.
    With `same_rows`, the rules of a table are evaluated on the other, equal one; a key both
    declare unique is counted once.
    """
    by_table: dict[str, list[Rule]] = {}
    for table in tables:
        read = (same_rows or {}).get(table, table)
        own = [rule for rule in rules(kinds) if rule.table == table]
        by_table.setdefault(read if read in tables else table, []).extend(own)
    reports = []
    for table, own in by_table.items():
        df = tables[table]
        row_rules = [rule for rule in own if rule.kind != "unique"]
        if row_rules:
            counts = df.agg(
                *[F.count_if(rule.broken()).alias(f"_{i}") for i, rule in enumerate(row_rules)]
            )
            reports.append(_report(counts, {rule: i for i, rule in enumerate(row_rules)}))
        unique = [rule for rule in own if rule.kind == "unique"]
        if unique:
            keys = list(dict.fromkeys(rule.columns for rule in unique))
            counts = _repeated_counts(df, keys)
            reports.append(_report(counts, {rule: keys.index(rule.columns) for rule in unique}))
    return reduce(DataFrame.unionByName, reports)


class QualityError(RuntimeError):
    """A blocking rule has failing rows."""


def enforce(report: DataFrame) -> list[dict]:
    """The report as a list, one entry per declared rule; raises if a blocking rule fails."""
    results = [row.asDict() for row in report.collect()]
    failed = [r["rule"] for r in results if r["blocking"] and r["failing_rows"]]
    if failed:
        raise QualityError(f"data-quality rules failed: {', '.join(sorted(failed))}")
    return results
