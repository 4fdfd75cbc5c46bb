"""Line dedup: of each line only the document with the smallest id keeps it.

1. Every line's 128-bit hash with its document and position, one narrow row a line.
2. Rows are range-partitioned and sorted by hash, document and position, so even a line that a
   third of all documents hold is spread over many partitions.
3. A partition is streamed once: the first document of a hash keeps the line, later ones drop
   it. A hash that began in an earlier partition has its first document from a table with one
   row per partition.
4. A document's dropped lines become a compressed keep bitmap. Text is never shuffled for the
   decision, only when the bitmaps are applied.

Defined cases: a null or empty text is one empty line, which is never dropped. Rows with the same
id are the same document for the count and are each filtered by their own text. A null id counts
as the smallest id. Lines shorter than `min_chars` code points after stripping always stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import SPACES, checkpointed, given_id, keyed, partitions, stored, with_key

MIN_CHARS = 10
_SORT = ("h1", "h2", "_id", "_th", "pos")


def line_key(line: bytes) -> bytes:
    """A-Z lower-cased and stripped of [\\x20\\x09-\\x0D]; other letters stay as they are."""
    return line.strip(SPACES.encode()).lower()


def _code_points(line: bytes) -> int:
    return len(line) if line.isascii() else len(line.decode())


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that can be dropped: h1, h2 (its hash), _id, _th, pos."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, pos, digests = [], [], bytearray()
            for row, text in enumerate(batch.column("_text")):
                for place, line in enumerate(text.as_py().encode().split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and _code_points(key) >= min_chars:
                        owner.append(row)
                        pos.append(place)
                        digests += xxhash.xxh3_128_digest(key)
            halves = np.frombuffer(bytes(digests), dtype="<i8").reshape(-1, 2)
            owners = pa.array(owner, pa.int64())
            yield pa.record_batch(
                {
                    "h1": np.ascontiguousarray(halves[:, 0]),
                    "h2": np.ascontiguousarray(halves[:, 1]),
                    "_id": batch.column("_id").take(owners),
                    "_th": batch.column("_th").take(owners),
                    "pos": pa.array(pos, pa.int32()),
                }
            )

    return keyed(docs).mapInArrow(hashes, "h1 long, h2 long, _id long, _th long, pos int")


def _last_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last hash of a partition and the first document that holds it there."""
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        h1, h2, doc = (batch.column(name).to_numpy() for name in ("h1", "h2", "_id"))
        same = (h1 == h1[-1]) & (h2 == h2[-1])
        first = int(np.argmax(same))  # sorted: equal hashes are one run up to the end
        if last is None or first > 0 or last[:2] != (h1[-1], h2[-1]):
            last = (h1[-1], h2[-1], doc[first])
    if last is not None:
        yield pa.record_batch({k: pa.array([int(v)], pa.int64()) for k, v in zip(("h1", "h2", "head"), last)})


def _later_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines whose hash was first seen in an earlier document."""
    carried = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        h1, h2, doc = (batch.column(name).to_numpy() for name in ("h1", "h2", "_id"))
        begins = np.ones(len(h1), dtype=bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        continues = carried is not None and carried[:2] == (h1[0], h2[0])
        starts = np.flatnonzero(begins)
        firsts = doc[starts]
        if continues:
            firsts[0] = carried[2]
        run = np.cumsum(begins) - 1
        head = firsts[run]
        earlier = batch.column("head")
        known = earlier.is_valid().to_numpy(zero_copy_only=False)
        head = np.where(known, earlier.fill_null(0).to_numpy(), head)
        carried = (h1[-1], h2[-1], firsts[-1])
        later = pa.array(np.flatnonzero(doc != head))
        yield pa.record_batch({name: batch.column(name).take(later) for name in ("_id", "_th", "pos")})


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """_id, _th and pos of every line to drop."""
    n = partitions(docs.sparkSession)
    # Stored once: finding the range bounds and dealing out the rows both read them.
    rows = stored(line_hashes(docs, min_chars))
    ordered = checkpointed(rows.repartitionByRange(n, *_SORT).sortWithinPartitions(*_SORT))
    heads = (
        ordered.mapInArrow(_last_heads, "h1 long, h2 long, head long")
        .groupBy("h1", "h2")
        .agg(F.min("head").alias("head"))
    )
    # At most one row per partition, whatever the data.
    marked = ordered.join(F.broadcast(heads), ["h1", "h2"], "left")
    return marked.select("h1", "h2", "_id", "_th", "pos", "head").mapInArrow(
        _later_copies, "_id long, _th long, pos int"
    )


def pack_keep(n_lines: int, dropped: np.ndarray) -> bytes:
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_keep(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per distinct document (_id, _th): n_lines, n_dropped and the keep bitmap.

    The bitmap has a bit per line, 1 for a line to keep, zlib-compressed; null keeps every line.
    """
    lost = (
        dropped_lines(docs, min_chars)
        .groupBy("_id", "_th")
        .agg(F.array_sort(F.collect_set("pos")).alias("lost"))
    )
    text = F.col("_text")
    size = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    lines = keyed(docs).select("_id", "_th", size.alias("n_lines")).distinct()

    @F.pandas_udf("binary")
    def bitmap(n_lines: pd.Series, lost: pd.Series) -> pd.Series:
        return pd.Series(
            [None if gone is None else pack_keep(n, gone) for n, gone in zip(n_lines, lost)], dtype=object
        )

    return lines.join(lost, ["_id", "_th"], "left").select(
        "_id",
        "_th",
        "n_lines",
        F.coalesce(F.size("lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
        bitmap("n_lines", "lost").alias("keep"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`_row` (the document as given), n_lines, n_dropped and `kept`, the text that stays."""

    @F.pandas_udf("string")
    def kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
        out = []
        for whole, bits in zip(text, bitmap):
            if whole is not None:
                lines = whole.split("\n")
                chosen = unpack_keep(bits, len(lines))
                whole = "\n".join([line for line, keep in zip(lines, chosen) if keep])
            out.append(whole)
        return pd.Series(out, dtype=object)

    joined = with_key(docs).join(bitmaps, ["_id", "_th"], "left")
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    cut = kept(F.when(F.col("keep").isNotNull(), text), F.col("keep"))
    return joined.select(
        "_row", "_id", "n_lines", "n_dropped", F.coalesce(cut, text).alias("kept")
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with every repeated line cut; `n_chars`, if there is one, follows the text."""
    done = apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
    new = {"text": F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(
            F.col("n_dropped") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("_row.n_chars"))
    return done.select(
        *[new.get(name, F.col("_row").getField(name)).alias(name) for name in docs.columns]
    )


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    done = apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
    return done.select(given_id(), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
