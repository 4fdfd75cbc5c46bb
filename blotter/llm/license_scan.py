"""Licence scan: headers and licence files by TF-IDF cosine, then inheritance down the directories.

1. How many documents hold each term of the templates is counted over all whole texts, combined in
   the tasks. The vocabulary is that of the templates, so these counts are a bounded table.
2. Compared with the templates, as sparse TF-IDF vectors, are every line, every run of lines about as
   long as a template, however a notice is wrapped or commented, and every whole text (a licence
   file). Words outside the vocabulary weigh as much as a term no document has. The best match of at
   least `LEAST` is the file's own licence. The most frequent terms of a template, as long as they alone
   can't reach `LEAST`, say nothing: lines without any other term of it are not compared.
3. A file of which at least `LICENCE_SHARE` is licence text speaks for its directory. A file without a
   licence of its own takes that of its nearest ancestor directory, by a join of directory paths.

Defined cases: a null or empty text has no licence of its own; a null path is the root. Rows with one
path are one file with the best of their matches. Equal similarities go to the licence, then the
path, that sorts last. A text of any length is scanned whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import checkpointed, small_enough

LEAST = 0.7
LICENCE_SHARE = 0.1

# The notices that licences ask to put on a work.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}

# Whole texts of licences that are short enough to stand at the head of a file.
LICENCE_TEXTS: dict[str, str] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN "
        "NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
}


def templates() -> list[tuple[str, str]]:
    """Licence and text of every template."""
    notices = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    return notices + list(LICENCE_TEXTS.items())


# Words may be broken at a hyphen, so that it divides terms.
_TERM = re.compile(r"[a-z0-9]+(?:[.+][a-z0-9]+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def document_counts(files: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """In how many texts each term of the vocabulary is, and how many texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            held[""] += batch.num_rows
            for text in batch.column("text"):
                held.update(vocabulary.intersection(terms(text.as_py())))
        yield pa.record_batch(
            {"term": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())}
        )

    rows = files.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(
        F.sum("n").alias("n")
    )
    counts = {row.term: row.n for row in rows.collect()}  # as many as the vocabulary has terms
    return counts, counts.pop("", 0)


class Matcher:
    """Texts against the templates."""

    def __init__(self, counts: Mapping[str, int], n_texts: int) -> None:
        self.idf = {term: self._idf(n, n_texts) for term, n in counts.items()}
        self.unknown = self._idf(0, n_texts)
        self.templates = [(name, *self._vector(terms(text)), len(terms(text))) for name, text in templates()]
        self.telling = [self._telling(vector, norm, counts) for _, vector, norm, _ in self.templates]
        self.any_telling = frozenset().union(*self.telling)

    @staticmethod
    def _telling(vector: dict[str, float], norm: float, counts: Mapping[str, int]) -> frozenset[str]:
        """A template's terms of which any match has one: the others alone stay below LEAST.

        A text that shares only the others has at most the cosine of their part of the template.
        """
        allowed = (LEAST * norm) ** 2 * (1 - 1e-9)
        silent: set[str] = set()
        for term in sorted(vector, key=lambda t: (-counts.get(t, 0), t)):
            allowed -= vector[term] ** 2
            if allowed <= 0:
                break
            silent.add(term)
        return frozenset(vector) - silent

    @staticmethod
    def _idf(n: int, n_texts: int) -> float:
        return math.log((1 + n_texts) / (1 + n)) + 1

    def _vector(self, words: list[str]) -> tuple[dict[str, float], float]:
        weights = {w: n * self.idf.get(w, self.unknown) for w, n in Counter(words).items()}
        return weights, math.sqrt(sum(x * x for x in weights.values()))

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """The largest cosine with a template, and that template's licence."""
        if self.any_telling.isdisjoint(words):
            return 0.0, None
        weights, norm = self._vector(words)
        found = (0.0, "")
        for number, (name, *_) in enumerate(self.templates):
            if not self.telling[number].isdisjoint(weights):
                found = max(found, (self._cosine(number, weights, norm), name))
        return found

    def _cosine(self, number: int, weights: dict[str, float], norm: float) -> float:
        _, other, other_norm, _ = self.templates[number]
        dot = sum(x * weights[w] for w, x in other.items() if w in weights)
        return round(dot / (norm * other_norm), 9)

    def _runs(self, lines: list[list[str]], number: int) -> Iterator[tuple[float, int, int]]:
        """Cosine, first and last line of the runs of at least two lines that are tried for a template.

        A run begins at any line and ends where it has as many terms as the template, a line earlier
        or a line later; it holds a telling term.
        """
        length, telling = self.templates[number][3], self.telling[number]
        sizes = [len(line) for line in lines]
        anchors = [n for n, line in enumerate(lines) if not telling.isdisjoint(line)]
        starts: set[int] = set()
        for anchor in anchors:
            start, size = anchor, 0
            while start >= 0 and size <= length:
                starts.add(start)
                size += sizes[start]
                start -= 1
        for start in sorted(starts):
            end, size = start, sizes[start]
            while size < length and end + 1 < len(lines):
                end += 1
                size += sizes[end]
            for last in (end - 1, end, end + 1):
                if start < last < len(lines):
                    words = [word for line in lines[start : last + 1] for word in line]
                    if not telling.isdisjoint(words):
                        yield self._cosine(number, *self._vector(words)), start, last

    def scan(self, text: str) -> tuple[str | None, float, float]:
        """A file's licence, its similarity, and the share of its words in matching lines."""
        whole = terms(text)
        if self.any_telling.isdisjoint(whole):
            return None, 0.0, 0.0
        best, name = self.best(whole)
        lines = [terms(line) for line in text.split("\n")]
        matched = set(range(len(lines))) if best >= LEAST else set()
        for number, words in enumerate(lines):
            found = self.best(words)
            if found[0] >= LEAST:
                matched.add(number)
                best, name = max((best, name or ""), found)
        for number, (licence, *_) in enumerate(self.templates):
            if not self.telling[number].isdisjoint(whole):
                for cosine, first, last in self._runs(lines, number):
                    if cosine >= LEAST:
                        matched.update(range(first, last + 1))
                        best, name = max((best, name or ""), (cosine, licence))
        if best < LEAST:
            return None, 0.0, 0.0
        return name, best, sum(len(lines[n]) for n in matched) / len(whole)


def own_licences(files: DataFrame) -> DataFrame:
    """path, licence, similarity and share of every file."""
    files = files.select(
        F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text")
    )
    vocabulary = frozenset(term for _, text in templates() for term in terms(text))
    matcher = Matcher(*document_counts(files, vocabulary))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matcher.scan(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch(
                {
                    "path": batch.column("path"),
                    "licence": pa.array([f[0] for f in found], pa.string()),
                    "similarity": np.array([f[1] for f in found], dtype=np.float64),
                    "share": np.array([f[2] for f in found], dtype=np.float64),
                }
            )

    scanned = files.mapInArrow(scan, "path string, licence string, similarity double, share double")
    best = F.max(F.struct("similarity", "licence", "share")).alias("b")
    return scanned.groupBy("path").agg(best).select("path", "b.licence", "b.similarity", "b.share")


def _directories(path: Column) -> Column:
    """All directories above a path, the root ("") first."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )


def licences(files: DataFrame) -> DataFrame:
    """Per path: licence, similarity, origin (own, inherited or null) and origin_path.

    `files` has path and text.
    """
    own = checkpointed(own_licences(files))
    speaks = own.where(F.col("licence").isNotNull() & (F.col("share") >= LICENCE_SHARE))
    parent = F.element_at(_directories(F.col("path")), -1)
    of_directory = speaks.groupBy(parent.alias("directory")).agg(
        F.max(F.struct("similarity", "licence", "path")).alias("l")
    )
    known = small_enough(checkpointed(of_directory))
    above = own.where(F.col("licence").isNull()).select(
        "path", F.posexplode(_directories(F.col("path"))).alias("depth", "directory")
    )
    inherited = (
        above.join(known, "directory")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "l")).alias("near"))
        .select("path", "near.l.licence", "near.l.similarity", F.col("near.l.path").alias("origin_path"))
        .withColumn("origin", F.lit("inherited"))
    )
    of_itself = own.where(F.col("licence").isNotNull()).select(
        "path", "licence", "similarity", F.col("path").alias("origin_path"), F.lit("own").alias("origin")
    )
    found = of_itself.unionByName(inherited)
    return own.select("path").join(found, "path", "left").select(
        "path", "licence", "similarity", "origin", "origin_path"
    )
