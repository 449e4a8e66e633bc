import math
import random
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm.licences import BODIES, COMMON, COMMON_WEIGHT, HEADER, QUALIFIERS, TEMPLATES, WHOLE, Templates, licence_files


def cosine_by_hand(text, template):
    find = lambda t: Counter(re.sub(r"^(\d+)\.0$", r"\1", w) for w in re.findall(r"[^\W_]+(?:\.\d+)*", re.sub(r"\bv(er)?\.? ?(?=\d)", "version ", t.lower())))
    docs = [find(t) for _, t in TEMPLATES]
    known = lambda t: any(t in d for d in docs)
    idf = lambda t: (math.log((1 + len(docs)) / (1 + sum(t in d for d in docs))) + 1) * (COMMON_WEIGHT if t in COMMON and known(t) else 1)
    a, b = ({t: k * idf(t) for t, k in find(x).items()} for x in (text, template))
    dot = sum(x * b.get(t, 0) for t, x in a.items())
    return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())) if dot else 0.0


def test_cosine_against_brute_force():
    model = Templates(TEMPLATES)
    for text in ("licensed under the apache license, version 2.0", "released mit", "all rights", "the quick brown fox", "gnu public license version 3 for this work",
                 "cc by-nc 4.0 cc", "this work is not licensed", "this work is licensed under a creative commons attribution 4.0 international license today"):
        score, which = model.best(text)
        words = set(re.findall(r"[a-z]+|\d+", text))
        fits = [i for i, (name, t) in enumerate(TEMPLATES) if len(t.split()) > 60 or (
            all(v in words for v in re.findall(r"\d+", name)[:1] if v in re.findall(r"\d+", t)) and QUALIFIERS & set(re.findall("[a-z]+", t.lower())) <= words)]
        want = max((cosine_by_hand(text, TEMPLATES[i][1]), -i) for i in fits)
        assert abs(score - want[0]) < 1e-9
        assert not want[0] or model.names[which] == TEMPLATES[-want[1]][0] or abs(cosine_by_hand(text, TEMPLATES[which][1]) - want[0]) < 1e-9


def test_triggers_miss_no_line():
    model = Templates(TEMPLATES)
    for _, t in TEMPLATES:
        terms = re.findall(r"[^\W_]+(?:\.\d+)*", t.lower())
        for drop in range(len(terms)):
            line = " ".join(terms[:drop] + terms[drop + 1 :])
            if line and model.best(line)[0] >= HEADER:
                assert model.trigger.search(line), line


def test_inheritance_from_nearest_directory(spark):
    apache, mit, gpl = (next(t for n, t in TEMPLATES if n == x) for x in ("Apache-2.0", "MIT", "GPL-3.0"))
    rows = [("LICENSE", f"words before\n{apache}\nand many more words after it that make the rest of it longer than that"), ("a/x.py", "code"),
            ("a/b/COPYING.txt", mit), ("a/b/y.py", "code"), ("a/b/c/d/z.py", ""), ("a/b/c/own.py", f"# {gpl}\n{" ".join(chr(97 + i % 26) * 4 for i in range(200))}"), ("/a//b/w.py/", None),
            ("a/bc/v.py", "code"), (None, mit), (None, "x"), ("q/NOTICE", "no licence here"), ("a/b/y.py", "code"), ("e/LICENSE", apache), ("e/licence.md", apache + " x"), ("e/f", "t")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "k long, path string, text string").withColumn("licence", F.lit("clash")).withColumn("dir", F.lit(1))
    got = {r["k"]: (r["own_licence"], r["licence"], r["inherited_from"]) for r in licence_files(df).collect()}
    assert got == {0: ("Apache-2.0", "Apache-2.0", None), 1: (None, "Apache-2.0", ""), 2: ("MIT", "MIT", None), 3: (None, "MIT", "a/b"), 4: (None, "MIT", "a/b"),
                   5: ("GPL-3.0", "GPL-3.0", None), 6: (None, "MIT", "a/b"), 7: (None, "Apache-2.0", ""), 8: ("MIT", "MIT", None), 9: (None, None, None),
                   10: (None, "Apache-2.0", ""), 11: (None, "MIT", "a/b"), 12: ("Apache-2.0", "Apache-2.0", None), 13: ("Apache-2.0", "Apache-2.0", None), 14: (None, "Apache-2.0", "e")}
    assert licence_files(df.limit(0)).count() == 0


def test_notices_among_other_words_and_versions_apart():
    model = Templates(TEMPLATES)
    cases = {"Copyright 2020 Example Ltd. Licensed under the Apache License, Version 2.0. Thanks.": "Apache-2.0", "// SPDX-License-Identifier: MIT": "MIT",
             "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "/* SPDX-License-Identifier: BSD-3-Clause */": "BSD-3-Clause",
             "This project is licensed under the MIT License": "MIT", "Licensed under the GNU General Public License v2": "GPL-2.0",
             "Licensed under the GNU General Public License v3.0": "GPL-3.0", "Licensed under the GNU Lesser General Public License, version 3.0": "LGPL-3.0",
             "Licensed under the Apache License, Version 1.1.": None, "Licensed under CC BY 2.5.": None, "we met under the old general licence of 1920": None,
             "the rights of the public in version 3 of the work are not met": None}
    for text, name in cases.items():
        assert model.scan(text, "a/x.py")[0] == name, text
        assert model.scan("Lorem ipsum dolor.\n\n" + text + "\n\ncode = 1", "a/x.py")[0] == name, text
        assert model.scan(text, "a/x.py")[2] is False  # a notice in a source file is no licence file
        assert model.scan(text, "a/LICENSE")[2] is (name is not None)


def test_licence_texts_are_licence_files_whatever_their_name():
    model = Templates(TEMPLATES)
    for name, body in BODIES:
        wrapped = "\n".join(textwrap.wrap(f"{name} License\n\nCopyright (c) 2021 Some One\n\n" + body, 70))
        assert model.scan(wrapped, "docs/about.txt") [::2] == (name, True)
        words = body.split()
        for drop in range(0, len(words), 7):
            assert model.scan(" ".join(words[:drop] + words[drop + 10 :]), "x")[::2] == (name, True)


def test_triggers_miss_no_whole_text():
    model = Templates(TEMPLATES)
    rng = random.Random(8)
    for _, body in BODIES:
        words = body.lower().split()
        for _ in range(200):
            text = " ".join(rng.sample(words, rng.randrange(1, len(words))) + ["prose"] * rng.randrange(30))
            if model.best(text, bodies=True)[0] >= WHOLE:
                assert model.trigger.search(text)


def test_very_long_text_is_read_whole():
    model = Templates(TEMPLATES)
    text = "word and word. " * 200_000 + "\nReleased under the MIT License.\n" + "more words " * 100_000
    assert model.scan(text, "a.txt")[:2] == ("MIT", 1.0) or model.scan(text, "a.txt")[0] == "MIT"
