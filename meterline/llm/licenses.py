"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

Every line of every text is compared, every window of a template's number of terms wherever lines end, and every text as a
whole, so a notice is found wherever it stands.

1. Document frequencies of the templates' terms are counted over all documents (lines for the header weights, texts for the
   file weights); they number no more than the terms of the templates, whatever the corpus. A term that no template has
   weighs like one that no document has.
2. The scan scores, per text, its lines and windows. A template's window is as many terms as it has, at every place of the text
   (the whole text where that is shorter). Dot products are differences of running sums, norms are advanced term by term. Lines and
   windows of cosine ``HEADER`` or more are hits; of a template's windows that overlap, the best is kept, from its first
   template term to its last. Hits go into spans best first: one that overlaps a span of its licence widens it, one with half or more
   of it in spans of other licences is left out, any other is a span. Spans are in code points, by start, and those of different
   licences may overlap at their edges. The text's own best template is kept if its cosine is ``FILE_COSINE`` or more. Vectors are
   sparse: only terms that a template has enter the products, all terms enter the norms. A text is only scored against templates
   that it can reach: by Cauchy-Schwarz no line or window has a higher cosine than the root of the summed squares of the
   template's weights that occur in the text. Texts as a whole are compared to the licences in ``license_texts/`` and to the
   templates of ``FULL_SIZE`` terms or more; windows of a whole licence's length count as hits from ``FILE_COSINE`` on, with the
   file weights. A licence without a text there is only known by its notices.
3. A licence file is one named like one (``FILE_NAMES``) with a notice in it, or one that is a template's text as a whole. It
   licenses its directory. Directories, each only once, are joined to all their ancestors by path; the nearest one with
   a licence file is inherited. Then files are joined to their directory. A file's own notice comes first.

Defined cases. Null text counts as empty; a null path has no directory and inherits nothing. Ties go to the template first by
name, and of several licence files in a directory to the highest cosine, then the template first by name. Paths are split at
``/``; the directory of a path without one is the root, "". Rows that repeat are reported each. Texts are read whole. Other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import ROW, named, stored, whole_text, with_row_key

HEADER = 0.6
FILE_COSINE = 0.8
FILE_NAMES = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.\-_].*)?$"
FULL_SIZE = 40  # templates of so many terms are the text of a licence, shorter ones are notices

# Notices and short licence texts, as published.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND',
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited"),
]

# The texts of whole licences, one file each, as published, without copyright lines.
TEXTS = Path(__file__).with_name("license_texts")

_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def vocabulary(templates: list[tuple[str, str]]) -> frozenset[str]:
    return frozenset(t for _, text in templates for t in terms(text))


def licence_texts() -> list[tuple[str, str]]:
    return [(path.stem, path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]


# --- weights --------------------------------------------------------------------------------------


def frequencies(texts: DataFrame, known: frozenset[str]) -> tuple[int, int, dict[str, tuple[int, int]]]:
    """Number of lines and of texts, and for each known term the number of lines and of texts that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: Counter = Counter()
        whole: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen: set[str] = set()
                for line in text.split("\n"):
                    found = known.intersection(terms(line))
                    lines.update(found)
                    lines[""] += 1
                    seen |= found
                whole.update(seen)
                whole[""] += 1
        names = list(lines)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([lines[n] for n in names], pa.int64()), pa.array([whole[n] for n in names], pa.int64())],
            names=["term", "lines", "texts"],
        )

    summed = texts.mapInArrow(count, "term string, lines long, texts long").groupBy("term").agg(F.sum("lines").alias("lines"), F.sum("texts").alias("texts"))
    table = {r["term"]: (r["lines"], r["texts"]) for r in summed.collect()}  # one row per template term
    lines, whole = table.pop("", (0, 0))
    return lines, whole, table


class Matcher:
    """Cosine of sparse TF-IDF vectors to the templates."""

    def __init__(self, templates: list[tuple[str, str]], total: int, having: dict[str, int]):
        known = vocabulary(templates)
        self.idf = {t: math.log((1 + total) / (1 + having.get(t, 0))) + 1 for t in known}
        self.unknown = math.log(1 + total) + 1
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.names = [name for name, _ in templates]
        for i, (_, text) in enumerate(templates):
            weights = {t: n * self.idf[t] for t, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.postings.setdefault(t, []).append((i, w / norm))

    def best(self, text: str) -> tuple[float, int]:
        """The highest cosine and its template; ties go to the name first in order, then to the first template."""
        words = Counter(terms(text))
        if self.postings.keys().isdisjoint(words):
            return 0.0, -1
        dots: dict[int, float] = {}
        square = 0.0
        for t, n in words.items():
            w = n * self.idf.get(t, self.unknown)
            square += w * w
            for i, weight in self.postings.get(t, ()):
                dots[i] = dots.get(i, 0.0) + w * weight
        i = min(dots, key=lambda i: (-round(dots[i], 12), self.names[i], i))
        return dots[i] / math.sqrt(square), i


class Windows:
    """Cosine of every window of a text to templates of the window's number of terms."""

    def __init__(self, templates: list[tuple[str, str]], total: int, having: dict[str, int]):
        self.place = {t: i for i, t in enumerate(sorted(vocabulary(templates)))}
        self.idf = np.array([math.log((1 + total) / (1 + having.get(t, 0))) + 1 for t in self.place])
        self.unknown = math.log(1 + total) + 1
        self.names = [name for name, _ in templates]
        counted = [Counter(terms(text)) for _, text in templates]
        self.lengths = [sum(c.values()) for c in counted]
        self.weights = np.zeros((len(templates), len(self.place)))
        for row, c in zip(self.weights, counted, strict=True):
            for t, n in c.items():
                row[self.place[t]] = n * self.idf[self.place[t]]
            row /= np.sqrt((row * row).sum()) or 1.0
        self.squares = self.weights**2

    def reachable(self, words: list[str], least: float) -> np.ndarray:
        """The templates that some part of the text may meet with cosine ``least``."""
        known = [self.place[t] for t in self.place.keys() & set(words)]
        return np.flatnonzero(self.squares[:, known].sum(axis=1) >= least * least - 1e-9)

    def hits(self, words: list[str], least: float, reach: np.ndarray) -> list[tuple[float, int, int, int]]:
        """(cosine, template, first term, last term) of the best windows of each template in ``reach``."""
        own: dict[str, int] = {}
        ids = np.array([own.setdefault(t, len(own)) for t in words], np.int64)
        n, place = len(ids), np.array([self.place.get(t, -1) for t in own], np.int64)
        square = np.where(place >= 0, self.idf[place], self.unknown) ** 2
        order = np.argsort(ids, kind="stable")
        keys = ids[order] * (n + 1) + order
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        norms: dict[int, np.ndarray] = {}
        found = []
        for i in reach.tolist():
            size = min(self.lengths[i], n)
            if size not in norms:
                out, into = np.arange(n - size), np.arange(size, n)
                leaving = np.searchsorted(keys, ids[out] * (n + 1) + out + size) - rank[out]  # how often the term is in the window
                coming = rank[into] - np.searchsorted(keys, ids[into] * (n + 1) + into - size + 1)
                step = square[ids[into]] * (2 * coming + 1) - square[ids[out]] * (2 * leaving - 1)
                norms[size] = np.cumsum(np.concatenate([[(np.bincount(ids[:size]) ** 2 * square[: ids[:size].max() + 1]).sum()], step]))
            weight = np.where(place >= 0, self.weights[i][place] * self.idf[place], 0.0)[ids]
            sums = np.concatenate([[0.0], np.cumsum(weight)])
            cosine = np.round((sums[size:] - sums[: n - size + 1]) / np.sqrt(np.maximum(norms[size], 1e-9)), 9)
            left = np.flatnonzero(cosine >= least)
            while len(left):
                start = left[np.argmax(cosine[left])]
                meant = start + np.flatnonzero(weight[start : start + size])
                found.append((float(cosine[start]), i, int(meant[0]), int(meant[-1])))
                left = left[np.abs(left - start) >= size]
        return found


def places(text: str) -> list[tuple[int, int]]:
    """Start and end of every term, in code points of the text."""
    low = text.lower()
    found = [m.span() for m in _TERM.finditer(low)]
    if len(low) == len(text):
        return found
    at = [i for i, c in enumerate(text) for _ in c.lower()]  # some letters have two in lower case
    return [(at[a], at[b - 1] + 1) for a, b in found]


def spans_of(hits: list[tuple[float, int, str, int, int]]) -> list[dict]:
    """Spans of hits (cosine, 0 for a line and 1 for a window, licence, start, end), by start."""
    spans: list[dict] = []
    for cosine, _, name, start, end in sorted(hits, key=lambda h: (-round(h[0], 9), *h[1:])):
        meets = [s for s in spans if s["start"] < end and start < s["end"]]
        if 2 * sum(min(end, s["end"]) - max(start, s["start"]) for s in meets if s["license"] != name) >= max(end - start, 1):
            continue
        same = [s for s in meets if s["license"] == name]
        best = same[0] if same else {"start": start, "end": end, "license": name, "cosine": cosine}
        best["start"] = min([start, *(s["start"] for s in same)])
        best["end"] = max([end, *(s["end"] for s in same)])
        spans = [s for s in spans if not any(s is other for other in same)] + [best]
        spans.sort(key=lambda s: -s["cosine"])
    return sorted(spans, key=lambda s: (s["start"], s["end"], s["license"]))


# --- notices --------------------------------------------------------------------------------------


def notices(rows: DataFrame, templates: list[tuple[str, str]], texts: list[tuple[str, str]], header: float, file_cosine: float) -> DataFrame:
    """``rows`` (row key, path, text) with ``found``: spans (start, end, license, cosine), and the best whole match; stored."""
    lines, whole, having = frequencies(rows.select("text"), vocabulary(templates + texts))
    full = texts + [(name, text) for name, text in templates if len(terms(text)) >= FULL_SIZE]
    licences = len(texts)
    line_weights = templates, lines, {t: n for t, (n, _) in having.items()}
    text_weights = full, whole, {t: n for t, (_, n) in having.items()}
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("cosine", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_line, by_text = Matcher(*line_weights), Matcher(*text_weights)
        by_window, by_long_window = Windows(*line_weights), Windows(*text_weights)

        def notice(text: str, words: list[str], whole: np.ndarray) -> list[dict]:
            reach, long = by_window.reachable(words, header), whole[whole < licences]
            hits, at = [], 0
            for line in text.split("\n") if len(reach) else []:
                cosine, i = by_line.best(line)
                if cosine >= header:
                    hits.append((cosine, 0, by_line.names[i], at, at + len(line)))
                at += len(line) + 1
            inside = [(by_window.names[i], c, a, b) for c, i, a, b in by_window.hits(words, header, reach)] if len(reach) else []
            inside += [(by_long_window.names[i], c, a, b) for c, i, a, b in by_long_window.hits(words, file_cosine, long)] if len(long) else []
            spots = places(text) if inside else []
            return spans_of(hits + [(cosine, 1, name, spots[a][0], spots[b][1]) for name, cosine, a, b in inside])

        for batch in batches:
            found, names, cosines = [], [], []
            for text in batch.column(3).to_pylist():
                words = terms(text)
                whole = by_long_window.reachable(words, file_cosine)
                found.append(notice(text, words, whole))
                cosine, i = by_text.best(text) if len(whole) else (0.0, -1)
                names.append(by_text.names[i] if cosine >= file_cosine else None)
                cosines.append(cosine if cosine >= file_cosine else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, kind), pa.array(names, pa.string()), pa.array(cosines, pa.float64())],
                names=[*ROW, "path", "found", "whole", "whole_cosine"],
            )

    schema = (
        f"{ROW[0]} long, {ROW[1]} long, path string, found array<struct<start:bigint,end:bigint,license:string,cosine:double>>, "
        "whole string, whole_cosine double"
    )
    return stored(rows.select(*ROW, "path", "text").mapInArrow(scan, schema), "notices")


def _own() -> tuple[Column, Column]:
    """The file's own licence and its cosine: the whole text's, or that of its best line."""
    best = F.array_min(F.transform("found", lambda f: F.struct((-f["cosine"]).alias("c"), f["license"].alias("license"))))
    return F.coalesce("whole", best["license"]), F.coalesce("whole_cosine", -best["c"])


# --- directories ----------------------------------------------------------------------------------


def directory(path: Column) -> Column:
    """The directory of a path, "" for the root."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def inherited(files: DataFrame) -> DataFrame:
    """``dir, from_dir, license`` for every directory below one with a licence file: the nearest one's."""
    named_so = F.rlike(F.regexp_extract("path", "[^/]*$", 0), F.lit(FILE_NAMES))
    order = F.struct((-F.col("cosine")).alias("c"), "license")
    licensed = files.where((named_so | F.col("whole").isNotNull()) & F.col("license").isNotNull() & F.col("dir").isNotNull())
    licensed = licensed.groupBy(F.col("dir").alias("from_dir")).agg(F.min(order).alias("best")).select("from_dir", F.col("best.license").alias("license"))
    dirs = files.where(F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("from_dir")))
    climbed = dirs.select("dir", F.explode(ancestors).alias("a")).select("dir", "a.depth", "a.from_dir")
    nearest = climbed.join(licensed, "from_dir").groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "license")).alias("n"))
    return nearest.select("dir", F.col("n.from_dir").alias("from_dir"), F.col("n.license").alias("license"))


def license_scan(
    docs: DataFrame,
    path: Column,
    templates: list[tuple[str, str]] | None = None,
    header: float = HEADER,
    file_cosine: float = FILE_COSINE,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per document: doc_id, path, notices (spans), own_license, cosine, inherited_license, inherited_from, license."""
    keyed = with_row_key(docs)
    rows = keyed.select(*ROW, path.cast("string").alias("path"), whole_text().alias("text"))
    own, cosine = _own()
    files = notices(rows, templates or TEMPLATES, licence_texts() if texts is None else texts, header, file_cosine)
    files = stored(files.select(*ROW, "path", directory(F.col("path")).alias("dir"), "found", "whole", own.alias("license"), cosine.alias("cosine")), "files")
    above = inherited(files).select("dir", F.col("license").alias("inherited_license"), F.col("from_dir").alias("inherited_from"))
    ids = keyed.select(*ROW, named("doc_id").cast("bigint").alias("doc_id"))
    return files.join(above, "dir", "left").join(ids, ROW).select(
        "doc_id", "path", F.col("found").alias("notices"), F.col("license").alias("own_license"), "cosine",
        "inherited_license", "inherited_from", F.coalesce("license", "inherited_license").alias("license"),
    )
