"""Licence scan: lines of a text and all runs of consecutive lines, the whole text among them, are compared with licence
templates by the cosine of their sparse TF-IDF vectors; a file without a licence of its own takes that of the nearest
directory above it."""

from __future__ import annotations

import math
import re
from collections import Counter, OrderedDict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import pick, small_side

# Header and opening texts of common licences. "BSD" is what the clauses' opening alone tells.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("Proprietary", "Copyright. All rights reserved."),
]
# The GNU licences and their versions.
_GNU = [("GPL", "General", "3"), ("GPL", "General", "2"), ("LGPL", "Lesser General", "3"), ("LGPL", "Lesser General", "2.1"), ("AGPL", "Affero General", "3")]
for _short, _title, _version in _GNU:
    _name = f"{_short}-{_version if '.' in _version else _version + '.0'}"
    for _start in ("This work is licensed under the ", "Licensed under the ", ""):
        TEMPLATES.append((_name, f"{_start}GNU {_title} Public License, version {_version}."))
# The parts of the Creative Commons licences, their kinds and versions, and identifiers of licences.
_PARTS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
_KINDS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
_PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
IDENTIFIERS = ["MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0", "BSD-3-Clause", "BSD-2-Clause", "ISC", "Unlicense", "MPL-2.0", "EPL-2.0", "CC0-1.0"]
for _version, _port in _PORTS.items():
    for _kind in _KINDS:
        _name = f"CC-{_kind.upper()}-{_version}"
        TEMPLATES += [
            (_name, f"Licensed under CC {_kind.upper()} {_version}."),
            (_name, f"CC {_kind.upper()} {_version}"),
            (_name, f"This work is licensed under a Creative Commons {'-'.join(_PARTS[p] for p in _kind.split('-'))} {_version} {_port} License."),
        ]
        IDENTIFIERS.append(_name)
for _name in IDENTIFIERS:
    TEMPLATES.append((_name, f"SPDX-License-Identifier: {_name}"))
    if "GPL" in _name:
        TEMPLATES += [(_name, f"SPDX-License-Identifier: {_name}-{which}") for which in ("only", "or-later")]
#: A licence file's base name.
LICENSE_FILE = r"(?i)^(un)?licen[sc]e(\..*)?$|^copying(\..*)?$|^notice(\..*)?$"
#: Least cosine of a run of lines and a template.
COSINE = 0.75
#: By how much the best licence must lead the next other one: a version's number in a long header weighs little.
MARGIN = 0.0001

_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: What a version's number is read together with, as "version 2.0", "v2" and "GPL-2.0" are: the number alone is too common.
_VERSION = re.compile(r"(?<![a-z0-9])(version|v|license|[al]?gpl|mpl|epl|apache|bsd|by|sa|nc|nd|cc0|attribution|sharealike|noncommercial|noderivatives)([^a-z0-9]{0,4})([0-9]+(?:\.[0-9]+)*?)(?:\.0)*(?![0-9a-z]|\.[0-9])")


def versioned(text: str) -> str:
    """Lower-cased text in which a version's number has moved to the word before it, without ".0" at its end, and
    "version" before one is "v". Line ends stay."""
    return _VERSION.sub(lambda m: ("v" if m[1] == "version" else m[1]) + m[3] + m[2], text.lower())


def terms(text: str) -> list[str]:
    """Lower-cased terms of a text: letters and digits, with version numbers kept whole and with the word before."""
    return _TERM.findall(versioned(text))


VOCABULARY = sorted({t for _, text in TEMPLATES for t in terms(text)})


def document_frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each term of the templates occurs, and the number of documents; all documents count.

    Each task counts its own rows, so what is summed is one row a task and term.
    """
    known = frozenset(VOCABULARY)

    def run(batches):
        seen = dict.fromkeys(known, 0)
        rows = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                for t in known.intersection(terms(text or "")):
                    seen[t] += 1
        yield pa.RecordBatch.from_arrays([pa.array(["", *seen]), pa.array([rows, *seen.values()], pa.int64())], names=["term", "n"])

    rows = pick(docs, "text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row a template term
    counts = {r.term: r.n for r in rows}
    return counts, counts.pop("", 0)


class Scorer:
    """Cosines of the TF-IDF vectors of lines and templates. Compared with a template, lines have each of its terms that
    they hold as often as the template has it, and every other term once: so a run of lines is as near as its set of
    terms. A term of no template has the weight of an unseen term."""

    def __init__(self, frequencies: dict[str, int], documents: int) -> None:
        self.idf = {t: math.log((1 + documents) / (1 + frequencies.get(t, 0))) + 1 for t in VOCABULARY}
        self.unseen = math.log(1 + documents) + 1
        self.names = [name for name, _ in TEMPLATES]
        self.held: list[frozenset[str]] = []
        self.squares: list[float] = []
        #: By term: the template, the share of its squared length, and what its repeats add to the square of the lines.
        self.index: dict[str, list[tuple[int, float, float]]] = {}
        for i, (_, text) in enumerate(TEMPLATES):
            weights = {t: ((1 + math.log(c)) * self.idf[t]) ** 2 for t, c in Counter(terms(text)).items()}
            self.squares.append(sum(weights.values()))
            self.held.append(frozenset(weights))
            for t, x in weights.items():
                self.index.setdefault(t, []).append((i, x / self.squares[i], x - self.idf[t] ** 2))

    def cosine(self, i: int, share: float, squares: float) -> float:
        """The cosine with template ``i`` of lines that hold a share of its squared length, rounded to 12 places."""
        return round(share * math.sqrt(self.squares[i] / squares), 12)

    def best(self, words: list[str]) -> tuple[float, str, float, str | None, bool]:
        """The highest cosine and its licence, those of the best other licence (0 and None if no other shares a term),
        and whether the words tell the first from the other: by a term that it alone has, or by all its terms while they
        lack one of the other's. Equal cosines go to the template named first."""
        had = frozenset(words)
        plain = sum(self.idf.get(w, self.unseen) ** 2 for w in sorted(had))
        shares: dict[int, list[float]] = {}
        for w in sorted(had):
            for i, share, extra in self.index.get(w, ()):
                s = shares.setdefault(i, [0.0, plain])
                s[0] += share
                s[1] += extra
        cosines = {i: self.cosine(i, *s) for i, s in shares.items()}
        order = sorted(cosines, key=lambda i: (-cosines[i], i))
        first = order[0]
        other = next((i for i in order if self.names[i] != self.names[first]), None)
        if other is None:
            return cosines[first], self.names[first], 0.0, None, True
        told = not self.held[first] & had <= self.held[other] or (self.held[first] <= had and not self.held[other] <= had)
        return cosines[first], self.names[first], cosines[other], self.names[other], told

    def reachable(self, words: set[str], cosine: float) -> list[int]:
        """Templates that some run of lines of these terms could reach: by Cauchy's inequality the cosine is at most the
        length of the template's vector over the terms both hold."""
        held: dict[int, float] = {}
        for w in words:
            for i, share, _ in self.index.get(w, ()):
                held[i] = held.get(i, 0.0) + share
        return [i for i, x in held.items() if x >= cosine * cosine - 1e-9]

    def scan(self, text: str, cosine: float) -> tuple[float, str, float, str | None, bool, int] | None:
        """Of all runs of consecutive lines, of every length, the one nearest to a template, if its cosine is at least
        ``cosine``: what ``best`` gives for it, and its first line. Of equal ones the one of the template named first,
        then the one that ends first, then the shortest.

        For each end, the terms are walked from the last seen back: a run that begins at some line holds just the terms
        seen last there or later, so runs between two such lines needn't be looked at. The walk stops where the terms
        weigh so much that no template of the text can make up for it, at the same number of terms in a text of any
        length; so the work is linear in the text and no run is left out.
        """
        flat = versioned(text)
        near = frozenset(self.reachable(self.index.keys() & set(_TERM.findall(flat)), cosine))
        if not near:
            return None
        lines = [(n, list(dict.fromkeys(words))) for n, line in enumerate(flat.split("\n")) if (words := _TERM.findall(line))]
        native = {w: held for w, all_held in self.index.items() if (held := [h for h in all_held if h[0] in near])}
        limit = max(self.squares[i] for i in near) / cosine**2 * (1 + 1e-9) if cosine > 0 else math.inf
        top, found = (round(cosine, 12), -len(TEMPLATES)), None
        last: OrderedDict[str, int] = OrderedDict()
        for b, (_, words) in enumerate(lines):
            for w in words:
                last[w] = b
                last.move_to_end(w)
            if native.keys().isdisjoint(words):
                continue  # a run that ends with a line without any term of a template is worse than the run without it
            shares: dict[int, list[float]] = {}
            squares, start, fresh = 0.0, b, False
            for w, line in [*self._back(last, limit), (None, -1)]:
                if line != start:
                    if fresh:
                        rank = max((self.cosine(i, share, squares + extra), -i) for i, (share, extra) in shares.items())
                        if rank > top:
                            top, found = rank, (start, b)
                    start, fresh = line, False
                if w is not None:
                    squares += self.idf.get(w, self.unseen) ** 2
                    for i, share, extra in native.get(w, ()):
                        s = shares.setdefault(i, [0.0, 0.0])
                        s[0] += share
                        s[1] += extra
                        fresh = True
        if found is None:
            return None
        return (*self.best([w for _, words in lines[found[0] : found[1] + 1] for w in words]), lines[found[0]][0])

    def _back(self, last: OrderedDict[str, int], limit: float):
        """Terms and the lines they were last seen in, from the last back, of all lines whose terms fit the limit."""
        squares, line, held = 0.0, -1, []
        for w, at in reversed(last.items()):
            if at != line:
                yield from held
                line, held = at, []
            squares += self.idf.get(w, self.unseen) ** 2
            if squares > limit:
                return
            held.append((w, at))
        yield from held


def scan_licenses(docs: DataFrame, cosine: float = COSINE, margin: float = MARGIN) -> DataFrame:
    """Per row of ``docs`` (doc_id, path, text): doc_id, path, license, license_score, license_line, runner_up,
    runner_up_score, unclear.

    Every line of the whole text is a candidate header, and so is every run of consecutive lines up to the whole text
    (``Scorer.scan``). The best wins; license_line is its first line, runner_up the next other licence for the same
    lines. If that one is less than ``margin`` behind, or no term tells the two apart (``Scorer.best``), the lines don't
    say which licence it is: license is null and unclear true. Null or empty text, or none near enough: no licence, score 0, not unclear. Other columns play no part,
    whatever their names.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(document_frequencies(docs))
    nothing = (0.0, None, None, None, None, None)

    def run(batches):
        score = Scorer(*scorer.value)
        for batch in batches:
            found = [(text and score.scan(text, cosine)) or nothing for text in batch.column(2).to_pylist()]
            unclear = [f[1] is not None and (f[0] - f[2] < margin or not f[4]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([None if u else f[1] for f, u in zip(found, unclear)], pa.string()), pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[5] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()), pa.array(unclear, pa.bool_()),
                ],
                names=["doc_id", "path", "license", "license_score", "license_line", "runner_up", "runner_up_score", "unclear"],
            )

    return pick(docs, "doc_id", "path", "text").mapInArrow(run, "doc_id long, path string, license string, license_score double, license_line int, runner_up string, runner_up_score double, unclear boolean")


def inherit(files: DataFrame) -> DataFrame:
    """``files`` (doc_id, path, license, ...) with effective_license and inherited_from.

    A file's own licence holds; else that of the licence file in the nearest directory at or above it. Where ``files``
    has ``unclear``, a file whose own header is unclear inherits nothing, and an unclear licence file stands for its
    directory: what lies below has no licence rather than one from farther above. Directories are
    resolved once each: their ancestors are joined with the directories that hold a licence file. Two licence files in
    one directory: the first by name, then by licence. A null path inherits nothing. All columns come back as they came,
    whatever their names, but for two named like the new ones, which these replace.
    """
    names = files.columns
    plain = files.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(names)])
    path, own = (F.col(f"in_{names.index(n)}") for n in ("path", "license"))
    plain = plain.withColumn("directory", F.regexp_replace(path, "/?[^/]*$", ""))
    name = F.regexp_extract(path, "[^/]*$", 0)
    unclear = F.coalesce(F.col(f"in_{names.index('unclear')}"), F.lit(False)) if "unclear" in names else F.lit(False)
    holders = plain.where((own.isNotNull() | unclear) & path.isNotNull() & name.rlike(LICENSE_FILE))
    holders = holders.groupBy(F.col("directory").alias("holder")).agg(F.min_by(own, F.struct(name.alias("n"), own.alias("l"))).alias("holder_license"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("holder")))
    directories = plain.where(path.isNotNull()).select("directory").distinct()
    nearest = (
        directories.select("directory", F.inline(above)).distinct().join(small_side(holders), "holder")
        .groupBy("directory").agg(F.max_by(F.struct("holder", "holder_license"), "depth").alias("nearest"))
    )
    made = {"effective_license": F.when(unclear, own).otherwise(F.coalesce(own, "nearest.holder_license")), "inherited_from": F.when(own.isNull() & ~unclear & F.col("nearest.holder_license").isNotNull(), F.col("nearest.holder"))}
    kept = [F.col(f"in_{i}").alias(n) for i, n in enumerate(names) if n not in made]
    return plain.join(nearest, "directory", "left").select(*kept, *[c.alias(n) for n, c in made.items()])


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a file tree ``<thousand>/<hundred>/<source>/<number>.txt``; each hundredth document is the
    licence file of its directory and each thousandth that of the directory above."""
    text = lambda name: F.coalesce(F.col(name), F.lit("none"))
    number = F.col("doc_id")
    group = F.floor(number / 1000).cast("string")
    path = (
        F.when(number % 1000 == 0, F.concat_ws("/", group, F.lit("LICENSE")))
        .when(number % 100 == 0, F.concat_ws("/", group, F.floor(number / 100).cast("string"), F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", group, F.floor(number / 100).cast("string"), text("source"), F.concat(number.cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")
