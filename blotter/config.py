"""Settings of one run: thresholds, domains, table locations and sizes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from types import MappingProxyType

# Rate to EUR by instrument. Any other instrument converts at 1.
FX_RATES_TO_EUR: Mapping[str, Decimal] = MappingProxyType(
    {
        "EURUSD": Decimal("1.0"),
        "GBPUSD": Decimal("1.17"),
        "USDJPY": Decimal("0.0063"),
        "USDCHF": Decimal("1.08"),
    }
)

# The instruments, desks and regions of the trade domain.
INSTRUMENTS = (
    "EURUSD", "GBPUSD", "USDJPY", "USDCHF", "AAPL", "MSFT", "BRENT", "GOLD", "BMW.DE", "SAP.DE",
)
DESKS = ("FX", "Equities", "Commodities", "Fixed Income")
REGIONS = ("EMEA", "APAC", "AMER")

GOLD_TABLES = ("mart_daily_volume", "mart_risk_exposure", "mart_top_instruments")


@dataclass(frozen=True)
class Config:
    """Everything a run may vary. The defaults are the reference business rules."""

    # Folder of the lake. On a cluster this is shared storage (object store or HDFS).
    root: str
    # A file format with columns: parquet or orc.
    table_format: str = "parquet"
    # With a table name, Bronze is a catalog table bucketed by trade_id instead of a folder: inserting
    # then shuffles the arriving trades into its buckets and leaves Bronze where it is. Spark does so
    # if there are at least as many buckets as shuffle partitions.
    bronze_table: str | None = None
    bronze_buckets: int = 1024
    # Bronze as a folder partitioned by so many hex digits of its ids' MD5: 1 gives 16 partitions, 2 give
    # 256. Inserting then reads the partitions that arriving ids fall in, and no others.
    bronze_digits: int = 0
    # With a database the marts are catalog tables; without one they live under root.
    gold_database: str | None = None

    large_trade_eur: int = 1_000_000
    high_exposure_eur: int = 5_000_000
    velocity_max_trades: int = 10
    velocity_window_minutes: int = 60
    fx_rates: Mapping[str, Decimal] = field(default_factory=lambda: FX_RATES_TO_EUR)

    # A trader-hour with more rows than this is cut into time-ordered segments of about this size.
    segment_rows: int = 1_000_000
    # Every so many sampled rows become a cut, which evens out the segments.
    samples_per_cut: int = 8
    # A row finds its segment in two steps: its block of this many cuts, then its cut within.
    cuts_per_block: int = 128

    # Range-cluster Silver by trader and instrument within a date. It costs a sampling pass over
    # the finished rows; without it Spark only balances the files of each date.
    cluster_silver: bool = True
    # Cluster along a space-filling key, so that files and row groups are narrow in instruments too;
    # without it they are sorted by trader first, and by instrument only within a trader.
    zorder_silver: bool = True

    # Shuffle partitions are sized so that each holds about this many bytes.
    partition_bytes: int = 128 * 1024 * 1024

    def __post_init__(self) -> None:
        if self.bronze_digits and self.bronze_table is not None:
            raise ValueError("Bronze is either bucketed (bronze_table) or partitioned (bronze_digits)")

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/raw_trades"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/bronze/quarantine"

    @property
    def silver_path(self) -> str:
        return f"{self.root}/silver/trades_enriched"

    def gold_path(self, table: str) -> str:
        return f"{self.root}/gold/{table}"
