"""A trade table derived from the event, customer, nation and region test tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.config import INSTRUMENTS
from blotter.functions.money import AMOUNT, PRICE, RATE
from blotter.operators.validate import FIELDS

# The desk of an instrument; the rest are commodities.
FX_PAIRS = ("EURUSD", "GBPUSD", "USDJPY", "USDCHF")
EQUITIES = ("AAPL", "MSFT", "BMW.DE", "SAP.DE")

INGESTED_AT = "2024-01-01 00:00:00"
SOURCE = "trades_jsonl"

# The fault of an event whose id the number divides; the first one applies.
FAULTS = (
    (101, "notional", "-1"),
    (103, "trader_id", None),
    (107, "direction", "HOLD"),
    (109, "status", "UNKNOWN"),
    (113, "trade_timestamp", "not-a-time"),
    (127, "counterparty", None),
)


# The columns of the test tables that are used. Declared, they need no job to infer.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """One typed trade per event.

    Nation and region are fixed lists of 25 and 5 rows, so they are broadcast. Customers grow
    with the data: no hint, Spark broadcasts them only while their files are small and
    otherwise shuffles, splitting a customer that holds very many events.
    """
    table = lambda name: _table(spark, sf_dir, name)
    joined = (
        table("events")
        .join(table("customer"), F.col("user_id") == F.col("c_custkey"))
        .join(F.broadcast(table("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(table("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    )

    event = F.col("event_id")
    pad = lambda number, width: F.lpad(number.cast("string"), width, "0")
    pick = F.get_json_object("props", "$.k").cast("int") % len(INSTRUMENTS) + 1
    value = F.col("value").cast("decimal(18,2)")
    instrument = F.col("instrument")
    kind, area = F.col("event_type"), F.col("r_name")
    named = joined.withColumn(
        "instrument", F.element_at(F.array(*map(F.lit, INSTRUMENTS)), pick)
    )
    columns = {
        "trade_id": F.concat(F.lit("T"), pad(event, 10)),
        "trader_id": F.concat(F.lit("TDR_"), pad(F.col("user_id") % 50 + 1, 3)),
        "instrument": instrument,
        "direction": F.when(event % 2 == 0, "BUY").otherwise("SELL"),
        "notional": (value * 20000).cast(AMOUNT),
        "price": (value + 1).cast(PRICE),
        "desk": F.when(instrument.isin(*FX_PAIRS), "FX")
        .when(instrument.isin(*EQUITIES), "Equities")
        .otherwise("Commodities"),
        "region": F.when(area == "AMERICA", "AMER").when(area == "ASIA", "APAC").otherwise("EMEA"),
        "counterparty": F.col("c_name"),
        "status": F.when(kind == "error", "CANCELLED")
        .when(kind == "signup", "PENDING")
        .otherwise("EXECUTED"),
        "trade_timestamp": F.col("ts").cast("timestamp"),
        "is_anomaly": event % 47 == 0,
    }
    extra = ["event_id"] if keep_event_id else []
    return named.select(*extra, *[column.alias(name) for name, column in columns.items()])


def with_lineage(records: DataFrame) -> DataFrame:
    """The two lineage columns with values that do not change from run to run."""
    return records.withColumns(
        {"_ingested_at": F.lit(INGESTED_AT).cast("timestamp"), "_source": F.lit(SOURCE)}
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as a Bronze table."""
    return with_lineage(trades(spark, sf_dir))


def faulty_records(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """The trades as unchecked text records, some with a fault."""
    text = {name: F.col(name).cast("string") for name in FIELDS} | {
        "trade_timestamp": F.date_format("trade_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }
    records = trades(spark, sf_dir, keep_event_id=True).select(
        "event_id", *[column.alias(name) for name, column in text.items()]
    )
    fault = F.when(F.lit(False), 0)
    for divisor, *_ in FAULTS:
        fault = fault.when(F.col("event_id") % divisor == 0, divisor)
    marked = records.withColumn("_fault", F.coalesce(fault, F.lit(0)))
    for divisor, name, replacement in FAULTS:
        broken = F.lit(replacement).cast("string")
        if name == "trader_id":
            broken = F.replace(F.col(name), F.lit("TDR_"), F.lit("TRD_"))
        marked = marked.withColumn(
            name, F.when(F.col("_fault") == divisor, broken).otherwise(F.col(name))
        )
    return marked.select(*(["event_id"] if keep_event_id else []), *FIELDS)


# What is wrong with the landing line of an event, by its id modulo the first number.
LINE_FAULTS = 23
TRUNCATED, TWO_OBJECTS, NUMBER_FOR_TEXT, BLANK = 1, 2, 3, 4


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as JSON lines (`value`), some broken, blank or with a number for a text."""
    records = faulty_records(spark, sf_dir, keep_event_id=True)
    event = F.col("event_id")
    kind = event % LINE_FAULTS
    unquoted = ("notional", "price", "is_anomaly")

    def member(name: str) -> Column:
        quoted = F.concat(F.lit('"'), F.col(name), F.lit('"'))
        text = F.col(name) if name in unquoted else quoted
        if name == "counterparty":
            text = F.when(kind == NUMBER_FOR_TEXT, event.cast("string")).otherwise(text)
        return F.concat(F.lit(f'"{name}": '), F.coalesce(text, F.lit("null")))

    whole = F.concat(F.lit("{"), F.concat_ws(", ", *map(member, FIELDS)), F.lit("}"))
    line = (
        F.when(kind == TRUNCATED, F.expr("left(line, length(line) - 1)"))
        .when(kind == TWO_OBJECTS, F.concat("line", F.lit(" "), "line"))
        .when(kind == BLANK, F.lit("  "))
        .otherwise(F.col("line"))
    )
    return records.select("event_id", whole.alias("line")).select(line.alias("value"))


def counted_rates(trades: DataFrame) -> DataFrame:
    """A rate table (instrument, rate) that follows from the trades: hundredths of their number."""
    hundredths = (F.count(F.lit(1)) % 97 + 1).cast("decimal(10,0)")
    rate = (hundredths * F.lit(Decimal("0.01"))).cast(RATE)
    return trades.groupBy(F.lower("instrument").alias("instrument")).agg(rate.alias("rate"))
