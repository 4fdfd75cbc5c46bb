"""Streams give what the batch gives."""

from __future__ import annotations

from dataclasses import replace

from blotter.config import Config
from blotter.plans import jobs
from blotter.sources.tables import read_table
from blotter.streaming.landing import stream_ingest
from blotter.streaming.velocity import velocity_counts
from tests.conftest import line

LINES = [
    [line(trade_id="a"), line(trade_id="b", notional=-1)],
    [line(trade_id="a"), line(trade_id="c")],
    [line(trade_id="d"), "{oops", ""],
]


def write_files(folder, groups, start=0):
    folder.mkdir(exist_ok=True)
    for i, group in enumerate(groups, start):
        (folder / f"{i}.jsonl").write_text("\n".join(group) + "\n")


def ids(spark, cfg):
    return sorted(r.trade_id for r in read_table(spark, cfg.bronze_path, cfg).collect())


def test_stream_ingest_equals_batch_ingest(spark, cfg, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    write_files(folder, LINES)
    stream_ingest(spark, str(folder), cfg, checkpoint, "s", files_per_batch=1).awaitTermination()
    batch = replace(cfg, root=cfg.root + "-batch")
    jobs.ingest(spark, str(folder), batch)
    assert ids(spark, cfg) == ids(spark, batch) == ["a", "c", "d"]
    assert read_table(spark, cfg.quarantine_path, cfg).count() == 2

    # A later run takes up new files only; replaying everything adds nothing.
    write_files(folder, [[line(trade_id="e")]], start=3)
    stream_ingest(spark, str(folder), cfg, checkpoint, "s").awaitTermination()
    assert ids(spark, cfg) == ["a", "c", "d", "e"]
    for files_per_batch in (1, 2, None):  # however the files fall into batches
        replay = str(tmp_path / f"replay-{files_per_batch}")
        stream_ingest(spark, str(folder), cfg, replay, "s", files_per_batch).awaitTermination()
        assert ids(spark, cfg) == ["a", "c", "d", "e"]
        assert read_table(spark, cfg.quarantine_path, cfg).count() == 2


def test_two_streams_into_one_lake(spark, cfg, tmp_path):
    for name in ("one", "two"):
        write_files(tmp_path / name, [[line(trade_id=name), f"{{bad {name}"]])
        checkpoint = str(tmp_path / f"checkpoint-{name}")
        stream_ingest(spark, str(tmp_path / name), cfg, checkpoint, name).awaitTermination()
    bad = read_table(spark, cfg.quarantine_path, cfg).collect()
    assert sorted(r._raw for r in bad) == ["{bad one", "{bad two"]
    # A mended file takes its lines out again, and nobody else's.
    write_files(tmp_path / "one", [[line(trade_id="one")]])
    again = str(tmp_path / "again")
    stream_ingest(spark, str(tmp_path / "one"), cfg, again, "one").awaitTermination()
    bad = read_table(spark, cfg.quarantine_path, cfg).collect()
    assert [r._raw for r in bad] == ["{bad two"]


SCHEMA = "trade_id string, trader_id string, trade_timestamp timestamp"


def trades_csv(n, trader, minute, copies=1):
    return [
        f"{trader}-{minute}-{i},{trader},2026-01-05 09:{minute:02d}:{i:02d}"
        for i in range(n)
        for _ in range(copies)
    ]


def test_velocity_stream(spark, tmp_path):
    folder, out = tmp_path / "trades", str(tmp_path / "out")
    cfg = replace(Config(root="unused"), velocity_max_trades=10)

    def counts(df):
        return sorted(
            (r.trader_id, r.window_start.hour, r.trades_in_window, r.velocity_flag)
            for r in df.collect()
        )

    def arrive(number, *rows):
        """One more file, and a run of the stream until nothing is left to do."""
        write_files(folder, [rows], start=number)
        stream = spark.readStream.schema(SCHEMA).csv(str(folder))
        query = (
            velocity_counts(stream, cfg)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return counts(spark.read.parquet(out))

    first = trades_csv(11, "TDR_001", 10) + trades_csv(5, "TDR_002", 20, copies=3)
    assert arrive(0, *first) == []
    closed = [("TDR_001", 9, 11, True), ("TDR_002", 9, 5, False)]
    assert arrive(1, "z,TDR_009,2026-01-05 12:00:00") == closed
    # Its window is closed: too late.
    assert arrive(2, "late,TDR_001,2026-01-05 09:59:00") == closed
    final = arrive(3, "y,TDR_009,2026-01-05 15:00:00")
    assert final == [*closed, ("TDR_009", 12, 1, False)]

    table = spark.read.schema(SCHEMA).csv([str(folder / f"{i}.jsonl") for i in (0, 1)])
    assert counts(velocity_counts(table, cfg)) == final
