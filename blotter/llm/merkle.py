"""A Merkle manifest of a dataset: a tree per group, a tree over the groups, and every row's proof.

1. Rows are hashed in place. Their digests, narrow, are range-partitioned in order and numbered: the
   place in a partition plus the rows of the partitions before.
2. Blocks. A run of fanout**block_levels rows of a group is packed into one row, a partition of the tree
   with a subtree of its own, hashed where it is.
3. Butterfly exchange. In round j aligned sets of fanout blocks, those whose numbers differ in digit j
   only, swap the roots of their subtrees. Each block hashes the parent for itself and notes the
   siblings. After as many rounds as the tree has levels above the blocks, each block holds the
   root and the upper part of all its rows' proofs: nothing is sent down again. A key of the exchange
   has at most `fanout` rows, however large the group. At a ragged end the blocks of a subtree
   with too few stand in, in turn, for those that are missing.
4. The groups' roots are the leaves of one more such tree.
5. Each block opens once more, with its upper proof, and gives every row's proof and folded root.

A node is the SHA-256, in lowercase hex, of its children's hex digests one after the other; a last run
may have fewer children, even one. A single leaf is its tree's root.

Defined cases: a null group comes before all others, a null id before all ids of its group; rows of
one id are ordered by their digest, and equal rows by their place in storage, which no result
shows. A field that is null is hashed as `-`, and empty as `0:`. A null id is not tampered with. Extra
columns don't matter. An empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import NULL_ID, checkpointed, given_id, partitions, small_enough, stored

FANOUT = 3
# A block has fanout ** block_levels rows.
BLOCK_LEVELS = 7

# So many paths, of up to some kilobytes each, may be broadcast.
BROADCAST_PATHS = 5_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WHOLE_NUMBERS = ("doc_id", "n_chars")

_DIGEST = 32


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes and its value."""
    text = value.cast("string")
    tagged = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(tagged, F.lit("-"))


def leaf(fields: Iterable[Column]) -> Column:
    """The digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def _parent(digests: Sequence[bytes]) -> bytes:
    return sha256(b"".join(digests).hex().encode()).digest()


# ---- order ---------------------------------------------------------------------------------


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each row's place `k` among the rows of its group in this partition, sorted by group."""
    last, count = None, 0
    for batch in batches:
        groups = batch.column("g").to_pylist()
        places = np.empty(len(groups), dtype=np.int64)
        for row, group in enumerate(groups):
            if group != last:
                last, count = group, 0
            places[row] = count
            count += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(places)], names=[*batch.schema.names, "k"]
        )


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `i`, the place of a row in its group `g`, and `n`, the rows of the group.

    `rows` is a stored table. What the partitions before hold of a group is one short row per group
    and partition.
    """
    spark = rows.sparkSession
    file, row = F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    sort = ["g", *order, "_file", "_row"]
    placed = (
        rows.select("*", file, row)
        .repartitionByRange(partitions(spark), *sort)
        .sortWithinPartitions(*sort)
        .drop("_file", "_row")
    )
    kept = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    local = stored(
        placed.mapInArrow(_number, f"{kept}, k long").withColumn("part", F.spark_partition_id())
    )
    counted = local.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(
        counted.select(
            F.col("g").alias("_g"),
            F.col("part").alias("_part"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
            F.sum("rows").over(Window.partitionBy("g")).alias("n"),
        )
    )
    same = F.col("g").eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_part"))
    joined = local.join(small_enough(offsets), same)
    return joined.select(*rows.columns, (F.col("k") + F.col("offset")).alias("i"), "n")


# ---- blocks --------------------------------------------------------------------------------

# The rows of a block, column by column: ids, digests and the digests of tampered rows.
_PACKED = "g string, b long, n long, ids binary, leaves binary, changed binary, root binary"


def levels(n: int, fanout: int) -> int:
    """Levels above n nodes."""
    count = 0
    while n > 1:
        n = -(-n // fanout)
        count += 1
    return count


def _grow(nodes: list[bytes], n_levels: int, fanout: int) -> list[list[bytes]]:
    """The nodes of every level, from the leaves to the one above them all."""
    grown = [nodes]
    for _ in range(n_levels):
        nodes = [_parent(nodes[at : at + fanout]) for at in range(0, len(nodes), fanout)]
        grown.append(nodes)
    return grown


def _split(packed: bytes) -> list[bytes]:
    return [packed[at : at + _DIGEST] for at in range(0, len(packed), _DIGEST)]


def _pack(fanout: int, block_levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            leaves = rows["leaf"].to_pylist()
            changed = rows["changed"].to_pylist()
            root = _grow(leaves, min(levels(key[2], fanout), block_levels), fanout)[-1][0]
            row = {
                "g": key[0],
                "b": key[1],
                "n": key[2],
                "ids": rows["id"].to_numpy().astype("<i8").tobytes(),
                "leaves": b"".join(leaves),
                "changed": b"".join(changed),
                "root": root,
            }
            kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(list(zip(row, kinds))))

        for batch in batches:
            groups, blocks = batch.column("g").to_pylist(), batch.column("b").to_pylist()
            sizes = batch.column("n").to_pylist()
            start = 0
            for row in range(len(groups)):
                own = (groups[row], blocks[row], sizes[row])
                if own != key:
                    if row > start:
                        parts.append(batch.slice(start, row - start))
                    if parts:
                        yield block()
                    key, parts, start = own, [], row
            if len(groups) > start:
                parts.append(batch.slice(start))
        if parts:
            yield block()

    return pack


# ---- the exchange --------------------------------------------------------------------------


def _digit(b: Column, width: int, fanout: int) -> Column:
    return F.pmod(F.floor(b / width), F.lit(fanout)).cast("int")


def _round(blocks: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round: subtrees of `width` blocks swap roots within aligned sets of `fanout`."""
    col = F.col
    first = F.floor(col("b") / width) * width
    base = F.floor(col("b") / (width * fanout)) * (width * fanout)
    low = col("b") - first
    own_size = F.least(F.lit(width), col("blocks") - first)

    def targets(digit: Column) -> Column:
        """The blocks of a sibling subtree that this one tells its root."""
        there = base + digit * width
        size = F.least(F.lit(width), col("blocks") - there)
        places = F.when(low < size, F.sequence(low, size - 1, own_size))
        told = F.transform(F.coalesce(places, F.array().cast("array<bigint>")), lambda p: there + p)
        return F.when(digit != _digit(col("b"), width, fanout), told)

    every = F.flatten(F.array_compact(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), targets)))
    sent = blocks.where(col("blocks") > width).select(
        col("t").alias("_t"),
        F.struct(_digit(col("b"), width, fanout).alias("d"), F.hex("root").alias("h")).alias("said"),
        F.explode(every).alias("_b"),
    )
    heard = sent.groupBy("_t", "_b").agg(F.array_sort(F.collect_set("said")).alias("heard"))
    joined = blocks.join(heard, (col("t") == col("_t")) & (col("b") == col("_b")), "left")
    own = _digit(col("b"), width, fanout)
    heard_or_none = F.coalesce("heard", F.array().cast("array<struct<d: int, h: string>>"))
    side = lambda keep: F.lower(F.array_join(F.transform(F.filter(heard_or_none, keep), lambda s: s["h"]), ""))
    step = F.struct(side(lambda s: s["d"] < own).alias("l"), side(lambda s: s["d"] > own).alias("r"))
    grown = joined.select("t", "b", "blocks", "root", "path", step.alias("step"))
    above = F.concat("step.l", F.lower(F.hex("root")), "step.r")
    active = col("blocks") > width
    return grown.select(
        "t",
        "b",
        "blocks",
        F.when(active, F.unhex(F.sha2(above, 256))).otherwise(col("root")).alias("root"),
        F.when(active, F.concat("path", F.array("step"))).otherwise(col("path")).alias("path"),
    )


def _exchanged(blocks: DataFrame, fanout: int) -> DataFrame:
    """Blocks (t, b, blocks, root) with the root of their whole tree and `path`, the siblings on the
    way there as hex: those to the left and those to the right, level by level.
    """
    state = checkpointed(
        blocks.withColumn("path", F.array().cast("array<struct<l: string, r: string>>"))
    )
    most = state.agg(F.max("blocks")).first()[0] or 0
    for level in range(levels(most, fanout)):
        state = checkpointed(_round(state, fanout**level, fanout))
    return state


def _trees(rows: DataFrame, order: Sequence[str], fanout: int, block_levels: int) -> DataFrame:
    """Packed blocks of the rows (g, id, leaf, changed) with `top`, their tree's root, and `path`."""
    size = fanout**block_levels
    placed = numbered(rows, order).withColumn("b", F.floor(F.col("i") / size))
    dealt = placed.repartition(partitions(rows.sparkSession), "g", "b").sortWithinPartitions("g", "b", "i")
    packed = stored(dealt.select("g", "b", "n", "id", "leaf", "changed").mapInArrow(_pack(fanout, block_levels), _PACKED))
    tree = lambda group: F.struct(group.isNull().alias("none"), F.coalesce(group, F.lit("")).alias("name"))
    state = packed.select(
        tree(F.col("g")).alias("t"), "b", F.ceil(F.col("n") / size).alias("blocks"), "root"
    )
    grown = _exchanged(state, fanout).select(
        "t", F.col("b").alias("_b"), F.col("root").alias("top"), "path"
    )
    same = (tree(F.col("g")) == F.col("t")) & (F.col("b") == F.col("_b"))
    return packed.join(small_enough(grown, BROADCAST_PATHS), same).drop("t", "_b")


# ---- proofs --------------------------------------------------------------------------------

_PROOFS = "g string, id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _folded(digest: str, path: Iterable[tuple[str, str]]) -> str:
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def _open(fanout: int, block_levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with their upper path to rows with their proofs."""

    def proofs(row: dict) -> pa.RecordBatch:
        leaves, changed = _split(row["leaves"]), _split(row["changed"])
        grown = _grow(leaves, min(levels(row["n"], fanout), block_levels), fanout)[:-1]
        shown = [[node.hex() for node in level] for level in grown]
        above = [(step["l"], step["r"]) for step in row["above"]]
        upper = [(step["l"], step["r"]) for step in row["path"]] + above
        subroot = row["top"].hex()
        digests, folded = [], []
        for place in range(len(leaves)):
            path, at = [], place
            for level in shown:
                first = at - at % fanout
                path.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
                at //= fanout
            path += upper
            told = "".join([left + right for left, right in path])
            digests.append(sha256(told.encode()).hexdigest())
            folded.append(_folded(changed[place].hex(), path))
        n = len(leaves)
        text = lambda values: pa.array(values, pa.string())
        return pa.record_batch(
            {
                "g": text([row["g"]] * n),
                "id": pa.array(np.frombuffer(row["ids"], dtype="<i8")),
                "leaf": text([x.hex() for x in leaves]),
                "subroot": text([subroot] * n),
                "root": text([_folded(subroot, above)] * n),
                "proof_sha256": text(digests),
                "folded_root": text(folded),
            }
        )

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield proofs(batch.slice(row, 1).to_pylist()[0])

    return opened


def _group_paths(blocks: DataFrame, fanout: int) -> DataFrame:
    """Per group, by its `_name`, the siblings on the way from its subroot to the root of all."""
    subroots = stored(
        blocks.where(F.col("b") == 0).select(F.lit("").alias("g"), F.col("g").alias("name"), "top")
    )
    # Here every leaf is a block of its own, so that the exchange gives each its whole proof.
    placed = checkpointed(numbered(subroots, ["name"]))
    tree = F.struct(F.lit(False).alias("none"), F.col("g").alias("name")).alias("t")
    grown = _exchanged(
        placed.select(tree, F.col("i").alias("b"), F.col("n").alias("blocks"), F.col("top").alias("root")),
        fanout,
    )
    above = grown.select("b", F.col("path").alias("above"))
    return placed.join(above, F.col("i") == F.col("b")).select(F.col("name").alias("_name"), "above")


def manifest(
    rows: DataFrame,
    group: Column,
    row_id: Column,
    digest: Column,
    presented: Column,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Per row: g, id, leaf, subroot, root, proof_sha256 and folded_root, digests in hex.

    `digest` is the row's leaf, and `presented` the leaf that is held against the manifest: folded with
    the row's proof it gives the root only if nothing has changed.
    """
    narrow = stored(
        rows.select(
            group.cast("string").alias("g"),
            F.coalesce(row_id.cast("bigint"), F.lit(NULL_ID)).alias("id"),
            digest.alias("leaf"),
            presented.alias("changed"),
        )
    )
    blocks = stored(_trees(narrow, ["id", "leaf"], fanout, block_levels))
    above = small_enough(checkpointed(_group_paths(blocks, fanout)), BROADCAST_PATHS)
    joined = blocks.join(above, F.col("g").eqNullSafe(F.col("_name")))
    opened = joined.select("g", "n", "ids", "leaves", "changed", "top", "path", "above")
    return opened.mapInArrow(_open(fanout, block_levels), _PROOFS)


def document_manifest(
    docs: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """The manifest of `documents` by source, checked against rows that lost their line ends where 2
    divides the CRC of their id.
    """
    fields = [F.col(name).cast("bigint") if name in WHOLE_NUMBERS else F.col(name) for name in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("bigint").cast("string")) % 2 == 0
    text = F.col("text")
    tampered = F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    presented = leaf([*fields[:-1], tampered])
    found = manifest(
        docs, F.col("source"), F.col("doc_id"), leaf(fields), presented, fanout, block_levels
    )
    return found.select(
        given_id("id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
