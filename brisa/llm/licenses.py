"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A text's headers are its sentences that name a licence in any way, and its paragraphs and comment blocks with their lines joined
and freed of comment signs; the cosine of each to every notice template decides the text's own licence. A text that as a whole is
close to a licence's text or notice is a licence file, and speaks for its directory. ``license_texts`` holds whole texts: most are
the files of Debian's base-files, CC-BY-SA-4.0 that of nftables; MIT and ISC are the usual texts; AGPL-3.0, CC-BY-4.0, CC-BY-NC-4.0
and BSD-2-Clause are made from their sister licences by the clauses that differ, so they are near their originals, not equal.
Document frequencies of the templates' words are counted over all texts. Inheritance is by joins on directories:
each distinct directory meets its own ancestors, and files join their directory, so neither a deep tree nor a
directory with a third of all files is gathered anywhere.

Edge cases: a null or empty text has no licence of its own and may inherit one; a null path inherits none. Of equal
scores the first template's name wins; a directory with several licence files has the best scored (then first by name) of
them. Repeated rows are scored alike. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only, slices
from brisa.session import share, write_out

# Notices by which files name their licence, and the opening or operative words of licence texts.
NOTICES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright; CC0 1.0 Universal license", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
}
# The standard notices at the head of a file, by licence and what they say of a version.
_GNU = "is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, "
_LATER = "either version {} of the License, or (at your option) any later version."
_GNU_NAMES = {
    "AGPL-3.0": ("Affero General Public License", "3"),
    "GPL-1.0": ("General Public License", "1"),
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.0": ("Library General Public License", "2"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
}
HEADERS = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for '
        "additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public "
        "domain worldwide. This software is distributed without any warranty.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    **{
        name: [
            *[f"This {what} {_GNU.format(full)}{_LATER.format(version)}" for what in ("program", "library")],
            f"you can redistribute it and/or modify it under the terms of the GNU {full} version {version} as published by the Free Software Foundation",
            f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {full}, version {version}, as published by the "
            "Free Software Foundation.",
            *[f"SPDX-License-Identifier: {name}{which}" for which in ("", "-only", "-or-later")],
        ]
        for name, (full, version) in _GNU_NAMES.items()
    },
    **{name: [f"SPDX-License-Identifier: {name}"] for name in ("Artistic-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "ISC", "MPL-1.1")},
}
# Whole texts: in 400 words and more, mere prose is up to 0.75 like them when all words weigh the same.
WHOLE, WHOLE_SHORT, SHORT_WORDS = 0.9, 0.75, 400
TEXTS = {
    "Apache-2.0": "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Everyone is permitted to copy and distribute verbatim copies of this license document, "
    "but changing it is not allowed.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the "
    "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies.",
}
# Every notice and text above has one of these, so a sentence or text without any is close to none.
SIGNS = ("licen", "copyright", "spdx", "permission", "redistribution")
HEADER, FILE = 0.75, 0.6
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_SENTENCE = re.compile(r"(?<=[.;!?])\s+|\n+")


def terms(text: str) -> Counter:
    """Words and word pairs of a text."""
    words = _WORD.findall(text.lower())
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def templates() -> list[tuple[str, Counter]]:
    """All notices and opening words by name of licence."""
    notices = [(name, text) for found in (NOTICES, HEADERS) for name, texts in sorted(found.items()) for text in texts]
    return [(name, terms(text)) for name, text in [*notices, *sorted(TEXTS.items())]]


def whole_texts() -> list[tuple[str, Counter]]:
    """Whole licences by name."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [(file.stem, terms(file.read_text(encoding="utf-8"))) for file in files]


# What begins the lines of comments, and what ends them.
_LEAD = re.compile(r"(?:/\*+|\*+/|\*+|//+!?|#+|--+|;+|%+|<!--+|(?:rem|dnl)\b|\.\.)[ \t]*", re.I)
_ENDS = ("*/", "-->")


def _bare(line: str) -> str:
    """A line without its comment signs."""
    line = line.strip()
    if lead := _LEAD.match(line):
        line = line[lead.end() :]
    for end in _ENDS:
        line = line.removesuffix(end).rstrip()
    return line


def headers(text: str) -> Iterator[str]:
    """What may name a licence: sentences, and paragraphs and comment blocks as one line each with their sentences."""
    seen = set()
    for sentence in _SENTENCE.split(text):
        if sentence not in seen and signed(sentence):
            seen.add(sentence)
            yield sentence
    for full, lines in groupby(map(_bare, text.split("\n")), bool):
        joined = " ".join(lines) if full else ""
        if signed(joined):
            for part in (joined, *_SENTENCE.split(joined)):
                if part not in seen and signed(part):
                    seen.add(part)
                    yield part


def signed(text: str) -> bool:
    lowered = text.lower()
    return any(sign in lowered for sign in SIGNS)


class Scorer:
    """Cosine of TF-IDF vectors to the templates', through an index from terms to weights in templates."""

    def __init__(self, frequency: dict[str, int], documents: int, given: list[tuple[str, Counter]], least: list[float]):
        self.documents = documents
        self.idf = {term: math.log((1 + documents) / (1 + n)) + 1 for term, n in frequency.items()}
        self.rare = math.log(1 + documents) + 1  # a word of no template
        self.names, self.index, self.least = [], {}, least
        for place, (name, found) in enumerate(given):
            self.names.append(name)
            vector = {term: count * self.idf.get(term, self.rare) for term, count in found.items()}
            norm = math.sqrt(sum(v * v for v in vector.values()))
            for term, value in vector.items():
                self.index.setdefault(term, []).append((place, value / norm))

    def best(self, found: Counter) -> tuple[float, str | None]:
        """The best score of the templates that are near enough, and its licence."""
        dots = [0.0] * len(self.names)
        square = 0.0
        for term, count in found.items():
            weight = count * self.idf.get(term, self.rare)
            square += weight * weight
            for place, value in self.index.get(term, ()):
                dots[place] += weight * value
        norm = math.sqrt(square)
        near = [place for place, dot in enumerate(dots) if dot and dot / norm >= self.least[place]]
        if not near:
            return 0.0, None
        top = max(near, key=lambda place: (round(dots[place], 12), -place))
        return dots[top] / norm, self.names[top]


def _frequencies(texts: DataFrame) -> tuple[dict[str, int], int]:
    """Document frequencies of the templates' terms over all texts, and the number of texts."""
    known = sorted({term for _, found in templates() + whole_texts() for term in found})
    place = {term: i for i, term in enumerate(known)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                words = _WORD.findall(text.lower())
                seen = {place[w] for w in words if w in place}
                if len(seen) > 1:
                    seen |= {place[p] for p in map(" ".join, zip(words, words[1:])) if p in place}
                counts[list(seen)] += 1
                counts[-1] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    # One row for each term of the templates.
    found = texts.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {row["term"]: row["n"] for row in found}
    return {term: counts.get(i, 0) for term, i in place.items()}, counts.get(len(known), 0)


def own_licenses(files: DataFrame) -> DataFrame:
    """``files(path, doc_id, text)`` as ``(doc_id, path, license, score, is_file)``: what each text says itself."""
    configure_arrow(files.sparkSession)
    shared = share(files.sparkSession, (*_frequencies(files), whole_texts()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, documents, wholes = shared.value
        short = templates()
        notices = Scorer(frequency, documents, short, [HEADER] * len(short))
        openings = Scorer(frequency, documents, short, [FILE] * len(short))
        whole = Scorer(frequency, documents, wholes, [WHOLE_SHORT if sum(found.values()) < 2 * SHORT_WORDS else WHOLE for _, found in wholes])
        for batch in slices(batches, "text"):
            out = []
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                best, name, is_file = 0.0, None, False
                if signed(text):
                    for header in headers(text):
                        score, found = notices.best(terms(header))
                        if found and score > best:
                            best, name = score, found
                    words = terms(text)
                    for scorer in (openings, whole):
                        score, found = scorer.best(words)
                        if found:
                            # A whole text names licences in its sentences: what it is as a whole comes first.
                            if scorer is whole or score > best:
                                best, name = score, found
                            is_file = True
                out.append((name, best if name else None, is_file))
            names, scores, marks = zip(*out)
            columns = [batch.column("doc_id"), batch.column("path"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(marks)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "path", "license", "score", "is_file"])

    kind = files.schema["doc_id"].dataType.simpleString()
    return files.select("doc_id", "path", "text").mapInArrow(run, f"doc_id {kind}, path string, license string, score double, is_file boolean")


def _directory(path: Column) -> Column:
    """Everything before the last slash; the root is empty."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def with_inherited(own: DataFrame) -> DataFrame:
    """``own`` with ``inherited`` and ``inherited_from``: the licence of the nearest directory at or above a file's that has one."""
    own = own.withColumn("directory", _directory(F.col("path")))
    files = own.where("is_file and directory is not null")
    # The best licence file of each directory: highest score, then first name.
    best = files.groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("rank"), "license")).alias("best"))
    best = best.select(F.col("directory").alias("above"), F.col("best.license").alias("inherited"))
    parts = F.split("directory", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    ancestors = own.where("directory is not null").select("directory").distinct().select("directory", F.explode(F.array_distinct(above)).alias("above"))
    nearest = ancestors.join(best, "above").groupBy("directory").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "inherited")).alias("near"))
    nearest = nearest.select("directory", "near.inherited", F.col("near.above").alias("inherited_from"))
    return own.join(nearest, "directory", "left").drop("directory")


def scan(files: DataFrame) -> DataFrame:
    """``(doc_id, path, license, score, is_file, inherited, inherited_from, effective)`` per row of ``files(doc_id, path, text)``."""
    own = write_out(own_licenses(only(files, "doc_id", "path", "text")), "licenses")
    return with_inherited(own).withColumn("effective", F.coalesce("license", "inherited"))
