"""A quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by rates of its characters and words and by those of the lines beside it;
neighbouring labels are tied by transition weights. Lines inherit the label of their document
for training. A document's quality is the mean of its lines' forward-backward marginals,
weighted by their length.

The model is fitted on the driver to a sample of labelled documents whose size is bounded by
`SAMPLE_DOCS` and `SAMPLE_LINES`; whole texts of all documents are scored by the tasks, with no
shuffle. Labels, language, source and id are never features.

Defined cases: a null or empty text is one empty line and gets a score like any other. Labels that
are null are left out; of repeated labels the larger counts. Rows are scored each for itself. With
no labels at all every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import NULL_ID, given_id, keyed

# Labelled documents that the model is fitted to, and the most lines one of them may have.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 200
THRESHOLD = 0.3
# Texts are described in portions of about so many characters.
PORTION = 1 << 20

STEPS = 150
RATE = 0.1
PENALTY = 1e-3

# Which bytes are counted together.
KINDS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"#*$%&<>@^~=+_\\/",
    b"!?",
    b"|",
    b".,;:",
)
FEATURES = 4 + len(KINDS) + 3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, the lines' lengths, and the texts' numbers of lines."""
    joined = "\n".join(texts) + "\n"
    raw = np.frombuffer(joined.encode(), dtype=np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (sums[ends] - sums[starts]).astype(np.float32)

    kind = np.zeros(256, dtype=np.uint8)
    for number, members in enumerate(KINDS, start=1):
        kind[list(members)] = number
    kinds = kind[raw]
    chars = count((raw & 0xC0) != 0x80)
    split = [line.split() for line in joined.split("\n")[:-1]]
    words = np.array([len(line) for line in split], dtype=np.float32)
    distinct = np.array([len(set(line)) for line in split], dtype=np.float32)
    some, any_word = np.maximum(chars, 1), np.maximum(words, 1)
    closed = np.isin(raw[np.maximum(ends - 1, 0)], list(b".!?")) & (chars > 0)
    columns = [
        np.log1p(chars),
        np.log1p(words),
        chars / any_word / 10,
        np.where(words > 0, distinct / any_word, 1),
        *[count(kinds == number) / some for number in range(1, len(KINDS) + 1)],
        count(raw >= 0xC0) / some,
        closed,
        chars == 0,
    ]
    sizes = np.array([text.count("\n") + 1 for text in texts], dtype=np.int64)
    return np.column_stack(columns).astype(np.float32), chars, sizes


def with_neighbours(lines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of a line, of the one before and of the one after it (0 outside), and 1."""
    before, after = np.zeros_like(lines), np.zeros_like(lines)
    before[1:], after[:-1] = lines[:-1], lines[1:]
    ends = np.cumsum(sizes)
    before[ends - sizes] = 0
    after[ends - 1] = 0
    return np.hstack([lines, before, after, np.ones((len(lines), 1), dtype=lines.dtype)])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # what speaks for good
    ties: np.ndarray  # 2 x 2: from the label of a line to that of the next


def forward_backward(unary: np.ndarray, sizes: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward scores (lines x 2, logarithms), for all chains side by side."""
    scores = np.column_stack([np.zeros_like(unary), unary])
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = [int(np.searchsorted(-sizes, -step, side="left")) for step in range(longest)]
    alpha, beta = scores.copy(), np.zeros_like(scores)
    for step in range(1, longest):
        at = starts[: active[step]] + step
        came = alpha[at - 1]
        alpha[at] += np.logaddexp(came[:, :1] + ties[0], came[:, 1:] + ties[1])
    for step in range(longest - 2, -1, -1):
        at = starts[: active[step + 1]] + step
        follows = scores[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(ties[:, 0] + follows[:, :1], ties[:, 1] + follows[:, 1:])
    return scores, alpha, beta


def marginals(unary: np.ndarray, sizes: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Each line's probability to be good."""
    _, alpha, beta = forward_backward(unary, sizes, ties)
    both = alpha + beta
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))


def fit(lines: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> Model:
    """Maximum likelihood of the lines' labels, each document counting once, by Adam."""
    raw = with_neighbours(lines, sizes).astype(np.float64)
    mean, scale = raw.mean(axis=0), raw.std(axis=0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    x = (raw - mean) / scale
    y = np.repeat(good.astype(np.float64), sizes)
    weight = np.repeat(1 / sizes, sizes) / len(sizes)
    inner = np.ones(len(y), dtype=bool)  # lines that another line of the document follows
    inner[np.cumsum(sizes) - 1] = False
    first = np.flatnonzero(inner)
    joint = np.zeros((2, 2))
    labels = y.astype(int)
    np.add.at(joint, (labels[first], labels[first + 1]), weight[first])
    params = np.zeros(x.shape[1] + 4)
    slope, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, ties = params[:-4], params[-4:].reshape(2, 2)
        scores, alpha, beta = forward_backward(x @ weights, sizes, ties)
        both = alpha + beta
        total = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - total)
        pair = (
            alpha[first][:, :, None] + ties[None]
            + (scores[first + 1] + beta[first + 1])[:, None, :] - total[first][:, None, None]
        )
        expected = (np.exp(pair) * weight[first][:, None, None]).sum(axis=0)
        gradient = np.concatenate([x.T @ (weight * (y - p)), (joint - expected).ravel()])
        gradient -= PENALTY * params
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        params = params + RATE * (slope / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, params[:-4], params[-4:].reshape(2, 2))


def quality(model: Model, texts: list[str]) -> np.ndarray:
    """The length-weighted mean of the lines' marginals, per text."""
    lines, chars, sizes = line_features(texts)
    x = (with_neighbours(lines, sizes) - model.mean) / model.scale
    good = marginals(x @ model.weights, sizes, model.ties)
    starts = np.cumsum(sizes) - sizes
    length = np.maximum(chars, 1).astype(np.float64)
    return np.add.reduceat(good * length, starts) / np.add.reduceat(length, starts)


def _portions(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= PORTION:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from `labels` (doc_id, quality), held-out ids left out; None without any."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("_label_id"))
        .agg(F.max("quality").alias("good"))
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(SAMPLE_DOCS)
    )
    short = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) < SAMPLE_LINES

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, text in zip(batch.column("good").to_pylist(), batch.column("_text").to_pylist()):
                lines, _, _ = line_features([text])
                yield pa.record_batch(
                    {"good": pa.array([good], pa.int32()), "lines": pa.array([lines.tobytes()], pa.binary())}
                )

    # At most SAMPLE_DOCS rows, whatever the data.
    rows = (
        keyed(docs).where(short)
        .join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
        .select(F.col("good").cast("int").alias("good"), "_text")
        .mapInArrow(describe, "good int, lines binary")
        .limit(SAMPLE_DOCS)
        .collect()
    )
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (bytes(r.lines), r.good))  # whatever order they came in
    lines = [np.frombuffer(r.lines, dtype=np.float32).reshape(-1, FEATURES) for r in rows]
    sizes = np.array([len(part) for part in lines])
    return fit(np.vstack(lines), sizes, np.array([r.good > 0 for r in rows]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """_id and score of every row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            if model is None:
                scores = np.full(len(texts), 0.5)
            else:
                scores = np.concatenate([[], *(quality(model, part) for part in _portions(texts))])
            yield pa.record_batch({"_id": batch.column("_id"), "score": scores.astype(np.float64)})

    return keyed(docs).select("_id", "_text").mapInArrow(judge, "_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    scored = score(docs, train(docs, labels))
    known = F.when(F.col("_id") != NULL_ID, F.col("_id"))
    return scored.select(
        given_id(),
        held_out(known).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
