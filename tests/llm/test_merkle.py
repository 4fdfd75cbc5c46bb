from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from blotter.llm import merkle
from tests.conftest import SMALL
from tests.llm.conftest import ODD_ROWS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    said = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[name] for name in FIELDS))
    return h("".join(said))


def climb(nodes: list[str], place: int, fanout: int) -> tuple[str, list[tuple[str, str]]]:
    path = []
    while len(nodes) > 1:
        first = place - place % fanout
        path.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + fanout])))
        nodes = [h("".join(nodes[at : at + fanout])) for at in range(0, len(nodes), fanout)]
        place //= fanout
    return nodes[0], path


def manifest(rows: list[dict], fanout: int = 3) -> list[tuple]:
    smallest = -(1 << 63)
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (smallest if r["doc_id"] is None else r["doc_id"], leaf(r)))
    leaves = {name: [leaf(r) for r in groups[name]] for name in names}
    subroots = [climb(leaves[name], 0, fanout)[0] for name in names]
    out = []
    for at, name in enumerate(names):
        root, above = climb(subroots, at, fanout)
        for place, row in enumerate(groups[name]):
            subroot, path = climb(leaves[name], place, fanout)
            changed = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"]:
                changed["text"] = row["text"].replace("\n", "")
            folded = leaf(changed)
            for left, right in path + above:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path + above))
            out.append((row["doc_id"], leaf(row), subroot, root, proof, folded, folded == root))
    return out


def check(docs, fanout: int = 3, block_levels: int = merkle.BLOCK_LEVELS) -> list[tuple]:
    found = [tuple(r) for r in merkle.document_manifest(docs, fanout, block_levels).collect()]
    want = manifest([r.asDict() for r in docs.select(*FIELDS).collect()], fanout)
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return found


def test_equals_brute_force(spark):
    found = check(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


@pytest.mark.parametrize(("levels", "rows"), [(0, 1), (0, 28), (1, 4), (1, 100), (2, 100)])
def test_many_blocks_and_ragged_ends(documents, levels, rows):
    """Blocks of 1, 3 and 9 rows, so that most of the tree is made by the exchange."""
    texts = [(n, f"line {n}\nline", "en", "a") for n in range(rows)]
    texts += [(1000 + n, f"other {n}", "en", f"source {n % 5}") for n in range(rows // 2)]
    check(documents(*texts), 3, levels)


def test_other_fanouts(documents):
    texts = [(n, f"line {n}\nline", "en", "a" if n % 3 else None) for n in range(47)]
    for fanout in (2, 5):
        check(documents(*texts), fanout, 1)


def test_every_round_has_small_keys(spark):
    """In the exchange a block hears from its siblings only, also where a group has very many blocks."""
    blocks = spark.range(100).select(
        F.struct(F.lit(False).alias("none"), F.lit("x").alias("name")).alias("t"),
        F.col("id").alias("b"),
        F.lit(100).cast("bigint").alias("blocks"),
        F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("root"),
        F.array().cast("array<struct<l: string, r: string>>").alias("path"),
    )
    for width in (1, 3, 9, 27, 81):
        blocks = merkle._round(blocks, width, 3)
    found = {r.b: r for r in blocks.collect()}
    nodes = [sha256(str(n).encode()).hexdigest() for n in range(100)]
    for place, row in found.items():
        root, path = climb(nodes, place, 3)
        assert row.root.hex() == root
        assert [(s.l, s.r) for s in row.path] == path


def test_odd_rows(documents):
    rows = [*ODD_ROWS, *[(7, "the same row", "en", "s")] * 30, (9, "long " * 50_000 + "\n", "en", "ü")]
    docs = documents(*rows)
    check(docs)
    assert check(docs.limit(0)) == []
