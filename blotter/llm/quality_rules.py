"""Quality rules with thresholds that follow the data instead of fixed cutoffs.

1. Every whole text is measured once, into a narrow table in shared storage.
2. Each (lang, source) gets mergeable quantile sketches (KLL) of its rates, combined in the map
   tasks, so a source with a third of all rows costs no more than another. A group with few
   rows takes the merged sketches of its language, or else of everything.
3. A threshold is the quartile plus a multiple of the distance from the median: what lies far out
   of its own group's distribution is rejected. `SLACK` is the least distance, so that a group
   whose values hardly vary does not reject what differs a little.
4. Measures join their group's thresholds.

Defined cases: a null text has no words. A null lang or source is a group of its own. A text without
words fails the base rule. Ties with a threshold are kept. Rows are judged each for itself, so
repeated rows get the same verdict. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import NULL_ID, SPACES, checkpointed, given_id, small_enough

# The base rule and the symbols it counts.
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# Rate: how far above the quartile, in distances from the median to it, and the least distance.
SPREAD = 8.0
SLACK = {"symbol_rate": 0.05, "dup_line_rate": 0.6, "repeat_rate": 0.3, "word_length": 3.0}
# A group with fewer rows borrows the sketches of its language, then of all rows.
LEAST_ROWS = 200
SKETCH_K = 400

_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """How many words lie in a window of `size` words that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = np.zeros(len(words), dtype=bool)
    twice = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
    for shift in range(size):
        covered[twice + shift] = True
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    filled = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(text.count(space) for space in SPACES),
        sum(text.count(symbol) for symbol in SYMBOLS),
        len(filled) - len(set(filled)),
        repeat_words(words),
        len(filled),
    )


def _measure_all(texts: pd.Series) -> pd.DataFrame:
    names = [field.split()[0] for field in _MEASURES.split(", ")]
    return pd.DataFrame([measure(text) for text in texts], columns=names)


def measures(text: Column) -> Column:
    return F.pandas_udf(_measure_all, _MEASURES)(text)


def rates() -> dict[str, Column]:
    """What is compared within a group; null where a text has no words."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    return {
        "symbol_rate": F.col("n_symbols") / F.when(F.col("word_chars") > 0, F.col("word_chars")),
        "dup_line_rate": F.col("n_dup_lines") / F.when(F.col("n_lines") > 0, F.col("n_lines")),
        "repeat_rate": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)


def measured(docs: DataFrame) -> DataFrame:
    """_id, lang, source and the measures of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"),
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        measures(text).alias("m"),
    )
    return rows.select("_id", "_lang", "_source", "m.*")


def _limits(sketch: Column, rate: str) -> tuple[Column, Column]:
    low, mid, high = (
        F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.5, 0.75)
    )
    slack = F.lit(SLACK[rate])
    above = high + F.greatest((high - mid) * SPREAD, slack)
    below = low - F.greatest((mid - low) * SPREAD, slack)
    return below, above


def thresholds(rows: DataFrame) -> DataFrame:
    """_lang, _source and one struct `limits` with the lowest and highest rate that pass.

    Only rows that pass the base rule count: a threshold describes ordinary documents.
    """
    sane = rows.where(~base_failed()).select("_lang", "_source", *[c.alias(n) for n, c in rates().items()])
    sketches = checkpointed(
        sane.groupBy("_lang", "_source").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.kll_sketch_agg_double(name, F.lit(SKETCH_K)).alias(name) for name in SLACK],
        )
    )
    merged = [F.kll_merge_agg_double(name).alias(name) for name in SLACK]
    by_lang = sketches.groupBy("_lang").agg(F.sum("n").alias("n"), *merged)
    overall = sketches.agg(F.sum("n").alias("n"), *merged)

    def limits(table: DataFrame, name: str) -> Column:
        both = []
        for rate in SLACK:
            below, above = _limits(F.col(rate), rate)
            both += [below.alias(f"{rate}_low"), above.alias(f"{rate}_high")]
        return F.struct(*both).alias(name)

    own = sketches.select("_lang", "_source", "n", limits(sketches, "own"))
    lang = by_lang.select(F.col("_lang").alias("_l"), F.col("n").alias("_ln"), limits(by_lang, "of_lang"))
    everything = overall.select(limits(overall, "of_all"))
    groups = rows.select("_lang", "_source").distinct()
    found = (
        groups.alias("g")
        .join(own.alias("o"), F.expr("g._lang <=> o._lang AND g._source <=> o._source"), "left")
        .select("g._lang", "g._source", "o.n", "o.own")
        .join(lang, F.expr("_lang <=> _l"), "left")
        .join(F.broadcast(everything))  # one row
    )
    chosen = (
        F.when(F.col("n") >= LEAST_ROWS, F.col("own"))
        .when(F.col("_ln") >= LEAST_ROWS, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    return found.select("_lang", "_source", chosen.alias("limits"))


def _passes() -> Column:
    """Every rate inside its group's limits; without limits (no sane document) nothing is outside."""
    inside = F.lit(True)
    for name, rate in rates().items():
        inside &= F.coalesce(rate >= F.col(f"limits.{name}_low"), F.lit(True))
        inside &= F.coalesce(rate <= F.col(f"limits.{name}_high"), F.lit(True))
    return inside


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed and kept to measured rows."""
    found = small_enough(checkpointed(limits))
    same_group = F.expr("r._lang <=> l._lang AND r._source <=> l._source")
    joined = rows.alias("r").join(found.alias("l"), same_group, "left").select("r.*", "l.limits")
    judged = joined.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & _passes()).drop("limits")


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the measures, base_failed, kept and the rates."""
    rows = checkpointed(measured(docs))
    judged = judge(rows, thresholds(rows))
    return judged.select(
        given_id(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, as they were given.

    The text is measured again in the pass that filters it: that moves no text, where a join by
    document would shuffle all of it.
    """
    limits = thresholds(checkpointed(measured(docs)))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        F.struct("*").alias("_row"),
        measures(text).alias("_m"),
    ).select("_lang", "_source", "_row", "_m.*")
    return judge(rows, limits).where("kept").select("_row.*")
