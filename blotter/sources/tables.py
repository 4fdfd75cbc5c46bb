"""Reading tables by path or from the catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from blotter.config import Config

# What the marts need of Silver.
SILVER_REQUIRED = (
    "trade_id", "trader_id", "instrument", "direction", "notional_eur", "desk", "region",
    "trade_date", "risk_tier", "velocity_flag", "alert_level", "is_anomaly",
)


def read_table(spark: SparkSession, path: str, cfg: Config, schema: str | None = None) -> DataFrame:
    """A table by its folder. With a declared schema it is not inferred, and may have no rows yet."""
    reader = spark.read.format(cfg.table_format)
    return (reader.schema(schema) if schema else reader).load(path)


def read_path_sql(spark: SparkSession, path: str, cfg: Config) -> DataFrame:
    """The same table as a SQL path relation."""
    return spark.sql(f"SELECT * FROM {cfg.table_format}.`{path}`")


def table_exists(spark: SparkSession, path: str, cfg: Config) -> bool:
    """Whether a table was written at the path. A folder without data files holds none."""
    try:
        read_table(spark, path, cfg).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_gold(spark: SparkSession, table: str, cfg: Config) -> DataFrame:
    """A mart from where `sinks.tables.write_gold` puts it."""
    if cfg.gold_database:
        return spark.table(f"{cfg.gold_database}.{table}")
    return read_table(spark, cfg.gold_path(table), cfg)


class ContractError(ValueError):
    """A table lacks columns its readers need."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df
