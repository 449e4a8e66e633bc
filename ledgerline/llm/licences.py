"""Licence scans: TF-IDF similarity of headers and licence files to templates, inherited by directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, shipped

#: Notices that the licences ask for or that are in common use.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)
#: The form in which source files name their licence by its identifier.
SPDX = tuple((name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(n for n, _ in NOTICES) if name != "proprietary")
#: Whole licence texts.
BODIES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
            "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
            "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
            "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
            "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
            "the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
            "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
)
TEMPLATES = NOTICES + SPDX + BODIES
#: Words that make another licence of the same family.
QUALIFIERS = frozenset("lesser affero sharealike noncommercial sa nc".split())
#: Terms from which a template counts as a licence text that a whole file can be.
BODY_TERMS = 40
#: Least cosine of a header (a sentence, a line or a paragraph), and of a whole text that is a licence text.
HEADER = 0.75
WHOLE = 0.75
LICENCE_NAME = re.compile(r"(?i)^(licen[cs]e|copying|copyright|notice|unlicense)([._-].*)?$")
#: Terms that ordinary prose is full of, and what they weigh beside others: templates are too few to tell them by their idf.
COMMON_WEIGHT = 0.2
COMMON = frozenset("so is a above action all an and any are as at be but by can claim copy deal do either event following for form free from general if in it its kind later "
                   "limited list may met must name names neither no nor not of on or other out own person persons project public purpose that the these this to use whether with "
                   "without work you your".split())
_TERM = re.compile(r"[^\W_]+(?:\.\d+)*")
_NUMBER = re.compile(r"\d+(?:\.\d+)*$")
_VERSION = re.compile(r"(?<![^\W_])(?:v|ver)\.?\s?(?=\d)")
_SENTENCE_END = re.compile(r"[.!?;]\s")


def terms_of(text: str) -> Counter:
    """The terms of a lower-cased text; "v2" counts as "version 2", and "3.0" as "3"."""
    counts = Counter(_TERM.findall(_VERSION.sub("version ", text)))
    for t in [t for t in counts if t.endswith(".0") and _NUMBER.match(t)]:
        counts[t[:-2]] += counts.pop(t)
    return counts


class Templates:
    """Sparse unit TF-IDF vectors of the templates; a term's idf counts templates, unknown terms have the highest."""

    def __init__(self, templates: Sequence[tuple[str, str]], header: float = HEADER, whole: float = WHOLE):
        self.names, self.header, self.whole = [n for n, _ in templates], header, whole
        counts = [terms_of(t.lower()) for _, t in templates]
        self.body = [sum(c.values()) >= BODY_TERMS for c in counts]
        # Numbers of the licence's name and qualifiers must stand in a unit too: another version is another licence.
        self.required = [[] if body else [n.removesuffix(".0") for n in re.findall(r"\d+(?:\.\d+)*", name) if n.removesuffix(".0") in c] + sorted(QUALIFIERS & set(c)) for (name, _), c, body in zip(templates, counts, self.body, strict=True)]
        in_templates = Counter(t for c in counts for t in c)
        n = len(counts)
        self.unknown = math.log(1 + n) + 1
        self.idf = {t: (math.log((1 + n) / (1 + k)) + 1) * (COMMON_WEIGHT if t in COMMON else 1) for t, k in in_templates.items()}
        self.vectors = []
        for c in counts:
            norm = math.sqrt(sum((k * self.idf[t]) ** 2 for t, k in c.items()))
            self.vectors.append({t: k * self.idf[t] / norm for t, k in c.items()})
        self.holders: dict[str, list[int]] = {}
        for i, v in enumerate(self.vectors):
            for t in v:
                self.holders.setdefault(t, []).append(i)
        self.triggers = sorted(self._triggers())
        self.trigger = re.compile("(?<![^\\W_])(?:" + "|".join(map(re.escape, self.triggers)) + ")(?![^\\W_])")

    def _triggers(self) -> set[str]:
        """Terms of which any text that may match has one: without its triggers, a template's remaining terms
        cannot reach the cosine asked of it (as a header, or as a whole text where the
        template is one). Terms rare in prose come first."""
        out: set[str] = set()
        for v, body in zip(self.vectors, self.body, strict=True):
            least = min(self.header, self.whole) if body else self.header
            left = sum(x * x for t, x in v.items() if t not in out)
            for t, x in sorted(v.items(), key=lambda p: (p[0] in COMMON or p[0][0].isdigit(), -p[1], p[0])):
                if left < least * least - 1e-9:
                    break
                if t not in out:
                    out.add(t)
                    left -= x * x
        return out

    def best(self, text: str, bodies: bool = False) -> tuple[float, int]:
        """Highest cosine with a template (of ``bodies``: with a licence text), and which one (the first of equals)."""
        terms = terms_of(text)
        dots: dict[int, float] = {}
        norm = 0.0
        for t, k in terms.items():
            idf = self.idf.get(t, self.unknown)
            norm += (k * idf) ** 2
            for i in self.holders.get(t, ()):
                dots[i] = dots.get(i, 0.0) + k * idf * self.vectors[i][t]
        dots = {i: d for i, d in dots.items() if (self.body[i] or not bodies) and all(n in terms for n in self.required[i])}
        if not dots:
            return 0.0, -1
        score, which = max((d, -i) for i, d in dots.items())
        return score / math.sqrt(norm), -which

    def scan(self, text: str | None, path: str | None) -> tuple[str | None, float, bool]:
        """(licence, cosine, licence file?) of a whole text: its best sentence, line or paragraph, or itself."""
        text = (text or "").lower()
        hits = [m.start() for m in self.trigger.finditer(text)] if any(t in text for t in self.triggers) else []
        if not hits:
            return None, 0.0, False
        found, units, seen, said = (0.0, -1), set(), -1, -1
        for at in hits:
            if at >= seen:
                start, seen = text.rfind("\n", 0, at) + 1, text.find("\n", at)
                seen = len(text) if seen < 0 else seen
                units.add(text[start:seen])
            if at >= said:  # the sentence around it, within the line
                begin = max(start, said)
                for m in _SENTENCE_END.finditer(text, begin, at):
                    begin = m.end()
                after = _SENTENCE_END.search(text, at, seen)
                said = after.end() if after else seen
                units.add(text[begin:said])
        for at in hits[:1] + [b for a, b in zip(hits, hits[1:], strict=False) if "\n\n" in text[a:b]]:
            first, end = text.rfind("\n\n", 0, at) + 1, text.find("\n\n", at)
            units.add(text[first : len(text) if end < 0 else end])
        for u in units:
            got = self.best(u)
            if got[0] > found[0] or (got[0] == found[0] and got[1] < found[1]):
                found = got
        whole = self.best(text, bodies=True)
        named = LICENCE_NAME.match((path or "").rsplit("/", 1)[-1]) is not None
        if whole[0] >= self.whole and (whole[0] >= found[0] or found[0] < self.header):
            found = whole
        elif found[0] < self.header:
            return None, found[0], False
        return self.names[found[1]], found[0], named or whole[0] >= self.whole


def scan_texts(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, header: float = HEADER, whole: float = WHOLE) -> DataFrame:
    """``files`` (path, text, others) without text, with own_licence, cosine and licence_file."""
    model = shipped(files.sparkSession, Templates(templates, header, whole))
    own = {"own_licence": T.StringType(), "cosine": T.DoubleType(), "licence_file": T.BooleanType()}
    schema = T.StructType([f for f in files.schema if f.name not in own and f.name != "text"])
    for name, kind in own.items():
        schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scanner, arrow = model(), to_arrow_schema(schema)
        for batch in batches:
            rows = [scanner.scan(t.as_py(), p.as_py()) for t, p in zip(batch.column("text"), batch.column("path"), strict=True)]
            made = dict(zip(own, zip(*rows, strict=True) if rows else ((), (), ()), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in arrow], schema=arrow)

    return files.mapInArrow(run, schema)


def parent(path: Column) -> Column:
    """The directory of a path, "" at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, down to "", with their depth."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("directory")))


def licence_files(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, header: float = HEADER, whole: float = WHOLE) -> DataFrame:
    """``files`` (path, text, other columns) without text, with own_licence, cosine, licence_file,
    licence and inherited_from.

    A text's own licence is the template nearest, by cosine of TF-IDF vectors, to
    one of its sentences, lines or paragraphs (from ``header`` on) or, if it is a licence text,
    to the whole (from ``whole`` on); numbers in a licence's name must stand in the notice. A
    licence file is a licence text, or a file named like LICENSE or COPYING with a
    notice in it (a notice in a source file is for that file alone); its licence holds for its
    directory (the highest cosine, then the smaller path). A file without a licence
    of its own takes that of its nearest ancestor directory, found by joining the
    paths of all its ancestors.

    Defined cases: null and empty texts have no own licence but inherit; a null path
    neither gives nor inherits; slashes at either end or doubled count once; repeated
    rows stay; columns of ``files`` named like results are replaced.
    """
    own = ("own_licence", "cosine", "licence_file", "licence", "inherited_from")
    kept = [c for c in files.columns if c not in own]
    clean = F.regexp_replace(F.regexp_replace(F.col("path"), "/+", "/"), "^/|/$", "")
    scanned = materialise(scan_texts(files.select(*[F.col(f"`{c}`") for c in kept]), templates, header, whole).withColumn("__dir", parent(clean)), "licence_scan")
    given = scanned.where("licence_file and __dir is not null").groupBy(F.col("__dir").alias("__given_by")).agg(
        F.min_by("own_licence", F.struct(-F.col("cosine"), F.col("path"), F.col("own_licence"))).alias("given"))
    given = materialise(given, "licence_given")
    dirs = materialise(scanned.where("own_licence is null and __dir is not null").select(F.col("__dir").alias("__of")).distinct(), "licence_dirs")
    up = dirs.select("__of", F.explode(ancestors(F.col("__of"))).alias("a")).select("__of", "a.depth", "a.directory")
    nearest = up.join(given, F.col("directory") == F.col("__given_by")).groupBy("__of").agg(
        F.max_by(F.struct("given", F.col("__given_by").alias("given_by")), "depth").alias("__nearest"))
    nearest = materialise(nearest, "licence_nearest")
    out = scanned.join(nearest, (F.col("__dir") == F.col("__of")) & F.col("own_licence").isNull(), "left")
    return out.select(*[F.col(f"`{c}`") for c in kept if c != "text"], "own_licence", "cosine", "licence_file",
                      F.coalesce("own_licence", "__nearest.given").alias("licence"), F.col("__nearest.given_by").alias("inherited_from"))
