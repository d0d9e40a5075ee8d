"""Licence scan: TF-IDF cosine of headers, statements and whole files to templates, and inheritance along directories.

Texts are compared as sequences of words, so line breaks and comment marks do not matter. Of each text these
passages are compared: the whole file; its header, that is its leading comment or first paragraph; its runs, the
parts of which most neighbouring words are neighbours in a template too; and its sentences with a licence cue,
joined with cue sentences next to them. Each passage is a sparse vector of term counts times idf, the same for the
templates (notices and full texts), and takes the template of the largest cosine if that is at least THRESHOLD.
Idf counts all documents and the templates. A reservation of all rights counts only where no other licence
matches, as it also opens the notices of free licences. A document whose matched words, those of all its
matched passages together, make up most of its words is a licence file of its directory; of a header or a whole
file only the words that its template has are matched. A document without a statement of its own takes the
licence of the nearest directory above it that has a licence file, by joining its ancestors with those
directories.

Defined cases: null and empty texts have no licence of their own; a null path has no directory and
inherits nothing; of several licence files in a directory the best match counts, then the smallest path,
then the smallest id; of equal cosines the first template by name; repeated rows are scanned each; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.flat import slices
from gridseries.llm.license_texts import FULL_TEXTS
from gridseries.llm.tables import stored

THRESHOLD = 0.55
FILE_SHARE = 0.6
RUN_LEAD = 3
RESERVED = "Proprietary"
CUES = ("license", "licence", "copyright", "spdx", "permission is hereby granted", "redistribution and use", "public domain",
        "all rights reserved")

# fixed values: openings, notices and full texts of public licences
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
                     "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
                     "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without permission."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    *FULL_TEXTS,
]

_TERM = re.compile(r"\w+(?:[.-]\w+)*")
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?;](?=\s)|$)", re.MULTILINE)
_LINE = re.compile(r"[^\n]*\n?")
_MARK = re.compile(r"\s*(?:[#*;%!]|//|--|<!--|/\*|\"\"\"|\'\'\'|\(\*|\{-)")
_WORD_MARK = re.compile(r"^[ \t]*(?:@?rem|dnl)(?!\S)", re.MULTILINE)
_BLOCKS = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''", "(*": "*)", "{-": "-}"}


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def passage_spans(text: str) -> list[tuple[int, int]]:
    """Where sentences with a cue are, joined with cue sentences that follow directly."""
    low = text.lower()
    if not any(cue in low for cue in CUES):
        return []
    out, after = [], False
    for found in _SENTENCE.finditer(text):
        sentence = found.group().strip()
        if not sentence:
            continue
        has = any(cue in sentence.lower() for cue in CUES)
        if has and after:
            out[-1].append(found.span())
        elif has:
            out.append([found.span()])
        after = has
    # a passage of several sentences is compared whole and by sentence
    return [(p[0][0], p[-1][1]) for p in out] + [s for p in out if len(p) > 1 for s in p]


def passages(text: str) -> list[str]:
    """Sentences with a cue, joined with cue sentences that follow directly."""
    return [text[a:b].strip() for a, b in passage_spans(text)]


def header_end(text: str) -> int:
    """Where the leading comment ends, or else the first paragraph."""
    comment, close, end = None, None, 0
    for found in _LINE.finditer(text):
        line = found.group().strip()
        if not found.group():
            break
        if comment is None:
            if line:
                comment = bool(_MARK.match(line))
        if close is None and comment and line:
            mark = _MARK.match(line)
            if not mark:
                break
            close = _BLOCKS.get(mark.group().strip())
            line = line[mark.end():]
        if close and close in line:
            close = None
        if comment is False and not line:
            break
        end = found.end()
    return end


class Matcher:
    """Template vectors by term, for cosines with any passage."""

    def __init__(self, counts: dict[str, int], documents: int, templates=None):
        templates = templates or TEMPLATES
        words = [terms(text) for _, text in templates]
        own = Counter(t for found in words for t in set(found))
        self.all = documents + len(templates)
        self.idf = {t: self._idf(n + counts.get(t, 0)) for t, n in own.items()}
        self.rare = self._idf(0)
        self.pairs = {pair for found in words for pair in zip(found, found[1:])}
        self.names, self.by_term, self.vocabulary = [name for name, _ in templates], {}, {}
        for i, found in enumerate(words):
            self.vocabulary.setdefault(self.names[i], set()).update(found)
            vector = self.weights(found)
            norm = math.sqrt(sum(w * w for w in vector.values()))
            for term, weight in vector.items():
                self.by_term.setdefault(term, []).append((i, weight / norm))

    def _idf(self, n: int) -> float:
        return math.log((1 + self.all) / (1 + n)) + 1

    def weights(self, words: list[str]) -> dict[str, float]:
        idf, rare = self.idf, self.rare
        return {t: (1 + math.log(n)) * idf.get(t, rare) if n > 1 else idf.get(t, rare) for t, n in Counter(words).items()}

    def closest(self, words: list[str], least: float = 0.0) -> tuple[str | None, float]:
        """The template of the largest cosine; none if no cosine can reach `least`."""
        weights = self.weights(words)
        known = [(t, w) for t, w in weights.items() if t in self.by_term]
        total = sum(w * w for w in weights.values())
        # no cosine is above the share of the terms that templates have
        if not known or sum(w * w for _, w in known) < (least * least - 1e-9) * total:
            return None, 0.0
        cosine, norm = [0.0] * len(self.names), math.sqrt(total)
        for term, weight in known:
            for i, other in self.by_term[term]:
                cosine[i] += weight / norm * other
        at = min(range(len(cosine)), key=lambda i: (-round(cosine[i], 12), self.names[i]))
        return self.names[at], round(cosine[at], 12)

    def best(self, text: str) -> tuple[str | None, float]:
        return self.closest(terms(text))

    def runs(self, words: list[str]) -> list[tuple[int, int]]:
        """Ranges of words of which most neighbouring pairs are a template's.

        A pair counts 1 if a template has it and -1 otherwise; the ranges are the maximal scoring
        ones of that sequence (Ruzzo and Tompa) that score at least RUN_LEAD.
        """
        known, pairs = [], self.pairs
        for k, pair in enumerate(zip(words, words[1:])):
            if pair in pairs:
                if known and known[-1][1] == k:
                    known[-1][1] = k + 1
                else:
                    known.append([k, k + 1])
        # found ranges: sum before, sum after, start, end, and the place of the last one of a smaller sum before
        out, total, last = [], 0, 0
        for start, end in known:
            low = total - (start - last)
            total, last = low + end - start, end
            high = total
            while True:
                at = len(out) - 1
                while at >= 0 and out[at][0] >= low:
                    at = out[at][4]
                if at < 0 or out[at][1] >= high:
                    out.append((low, high, start, end, at))
                    break
                low, start = out[at][0], out[at][2]
                del out[at:]
        return [(start, end + 1) for low, high, start, end, _ in out if high - low >= RUN_LEAD]

    def scan(self, text: str, threshold: float = THRESHOLD) -> tuple[str | None, float | None, float]:
        """Licence, cosine, and the share of the text's words in matched passages."""
        low = text.lower()
        if _WORD_MARK.match(low):
            low = _WORD_MARK.sub("#", low)
        words = terms(low)
        ranges = self.runs(words)
        cues = passage_spans(low)
        if cues:
            begins = [m.start() for m in _TERM.finditer(low)]
            ranges += [(bisect_left(begins, a), bisect_left(begins, b)) for a, b in cues]
        blocks = {(0, len(words)), (0, len(terms(low[:header_end(low)])))}
        found, covered = (False, 0.0, None), bytearray(len(words))
        for a, b in {*ranges, *blocks}:
            name, cosine = self.closest(words[a:b], threshold)
            if not name or cosine < threshold:
                continue
            if (a, b) in blocks:
                covered[a:b] = bytes(c or t in self.vocabulary[name] for c, t in zip(covered[a:b], words[a:b]))
            else:
                covered[a:b] = b"\1" * (b - a)
            found = max(found, (name != RESERVED, cosine, name), key=lambda f: (f[0], f[1], f[2] or ""))
        if found[2] is None:
            return None, None, 0.0
        return found[2], found[1], sum(covered) / max(1, len(words))


def _term_counts(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Documents with each term of the templates, and all documents. Terms are words of letters and digits in the count."""
    known = set(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]):
        total, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                n += 1
                if text.is_valid:
                    total.update(known.intersection(terms(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([*total, None], pa.string()), pa.array([*total.values(), n], pa.int64())], ["term", "n"])

    rows = files.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return {t: n for t, n in counts.items() if t is not None}, counts.get(None, 0)


def own_licenses(files: DataFrame, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """id, path, own_license, own_score, is_file of files (id, path, text)."""
    templates = templates or TEMPLATES
    counts, documents = _term_counts(files, sorted({t for _, text in templates for t in terms(text)}))
    shared = files.sparkSession.sparkContext.broadcast(Matcher(counts, documents, templates))

    def scan(batches: Iterator[pa.RecordBatch]):
        matcher = shared.value
        for batch in slices(batches, "text"):
            found = [matcher.scan(t.as_py() or "", threshold) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("path"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] >= FILE_SHARE for f in found], pa.bool_())],
                ["id", "path", "own_license", "own_score", "is_file"])

    rows = files.select(F.col("id").cast("long"), F.col("path").cast("string"), "text")
    return rows.mapInArrow(scan, "id long, path string, own_license string, own_score double, is_file boolean")


def directory(path: str) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """id, path, license, score, via (own, inherited or null) and licensed_by, the path the licence comes from."""
    found = stored(own_licenses(files, threshold, templates), "licenses")
    # the best score, then the smallest path, then the smallest id, none last
    order = F.struct(-F.col("own_score"), "path", F.col("id").isNull(), "id")
    best = F.min_by(F.struct("own_license", "own_score", "path"), order)
    holders = (found.where("is_file and path is not null").withColumn("holder", directory("path"))
               .groupBy("holder").agg(best.alias("law")))
    # stored, so that the join below has a shuffle of its own: every file has the root above it
    holders = stored(holders, "holders")
    # a file's ancestors: its directory and all above it, up to the empty one
    open_ = found.where("own_license is null and path is not null").select("path").distinct()
    parts = F.split(directory("path"), "/")
    above = open_.select("path", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts"))
    above = above.select("path", "depth", F.concat_ws("/", F.slice("parts", F.lit(1), F.col("depth"))).alias("holder"))
    nearest = above.join(holders, "holder").groupBy("path").agg(F.max_by("law", "depth").alias("law"))
    joined = found.join(nearest, "path", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        "id", "path", F.when(own, F.col("own_license")).otherwise(F.col("law.own_license")).alias("license"),
        F.when(own, F.col("own_score")).otherwise(F.col("law.own_score")).alias("score"),
        F.when(own, F.lit("own")).when(F.col("law").isNotNull(), F.lit("inherited")).alias("via"),
        F.when(own, F.col("path")).otherwise(F.col("law.path")).alias("licensed_by"))
