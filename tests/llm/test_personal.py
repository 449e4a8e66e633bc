import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest

from ledgerline.llm.personal import KINDS, Mapped, find_personal_data, find_spans, identifiers, listed, plain, transduced
from ledgerline.llm.registry import QUERIES
from tests.conftest import SF_SMALL

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def by_hand(text):
    """The plain identifiers by the patterns as they are written down."""
    out = []
    for order, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), order, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def test_plain_identifiers_by_the_patterns():
    rng = random.Random(11)
    bits = ["@", ".", "a", "b.c", "-", " ", "1", "25", "300", "+1 (017) 555-7713", "4012888888881881", "1.2.3.4", "..", "+", "(", ")", "x@y.z", "\n", "é", "_", "0007"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        assert ordered(identifiers(text)) == by_hand(text), text


@pytest.mark.parametrize("shown, kind, reading", [
    ("jane.doe (at) mail4 [dot] example (dot) com", "email", "jane.doe@mail4.example.com"),
    ("bob dot smith AT mail9 DOT example DOT com", "email", "bob.smith@mail9.example.com"),
    ("inthe.55 at mail9.example.com", "email", "inthe.55@mail9.example.com"),
    ("maría arroba correo punto es", "email", None),
    ("maria arroba correo punto es", "email", "maria@correo.es"),
    ("x{at}y{dot}org", "email", "x@y.org"),
    ("jаne.55@mаil4.example.com", "email", "jane.55@mail4.example.com"),
    ("ｊａｎｅ＠ｍａｉｌ．ｃｏｍ", "email", "jane@mail.com"),
    ("user@exam​ple.com", "email", "user@example.com"),
    ("𝐣𝐚𝐧𝐞@𝐦𝐚𝐢𝐥.𝐜𝐨𝐦", "email", "jane@mail.com"),
    ("192[.]168[.]1[.]77", "ip", "192.168.1.77"),
    ("10 dot 0 dot 0 dot 255", "ip", "10.0.0.255"),
    ("nine seven dot five one dot one seven dot one seven three", "ip", "97.51.17.173"),
    ("plus one five five five zero one two three four five six", "phone", "+15550123456"),
    ("plus 1 017 555 7713", "phone", "+1 017 555 7713"),
    ("＋1 (017) 555–7713", "phone", "+1 (017) 555-7713"),
    ("٤٠١٢٨٨٨٨٨٨٨٨١٨٨١", "card", "4012888888881881"),
    ("4O12 8888 8888 l88l", "card", "4012 8888 8888 1881"),
    ("vier null eins zwei acht acht acht acht acht acht acht acht eins acht acht eins", "card", "4012888888881881"),
    ("quatre zéro un deux huit huit huit huit huit huit huit huit un huit huit un", "card", "4012888888881881"),
])
def test_disguises_map_back(shown, kind, reading):
    for before, after in (("", ""), ("Word ", ", word."), ("éа \U0001f600 (see: ", ")\n"), ("one at a time. ", " and two dots")):
        found = [s for s in find_spans(before + shown + after) if not s[3]]
        if reading is None:  # a name that no identifier can have is found from its plain letters on
            assert [(before + shown)[a:b] for _, a, b, _, _ in found] == [shown[4:]]
            continue
        assert found == [(kind, len(before), len(before) + len(shown), False, reading)]


@pytest.mark.parametrize("text", [
    "look at example.com and at the dot", "one two three four five", "on dot at dot", "4012888888881882", "1.2.3.256", "the four of 12 at 5 dot 6", "At. Dot com at",
    "mañana a las nueve", "x² + y³ ½ ª º", "", " ", "Дом на улице, тел.", "+1 23", "l0 O1 I2", "he sat at home.com is down", "seven at nine dot five"])
def test_clean_texts_are_left_alone(text):
    assert find_spans(text) == []


def test_plain_ones_stay_beside_disguised_ones():
    text = "a.b@c.de x 1.2.3.4 a (at) b (dot) de +1 (017) 555-7713 4012888888881881 5[.]6[.]7[.]8"
    spans = find_spans(text)
    assert [(k, a, b) for k, a, b, p, _ in spans if p] == by_hand(text)
    assert [(k, text[a:b]) for k, a, b, p, _ in spans if not p] == [("email", "a (at) b (dot) de"), ("ip", "5[.]6[.]7[.]8")]


def test_rewriting_keeps_the_way_back():
    rng = random.Random(4)
    for _ in range(500):
        source = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40)))
        m, origin = Mapped.of(source), [(i, i + 1) for i in range(len(source))]
        for _ in range(3):
            cuts = sorted(rng.sample(range(len(m.text) + 1), min(len(m.text) + 1, 2 * rng.randrange(4)) // 2 * 2))
            found = [(a, b, rng.choice(["", "X", "YZ"])) for a, b in zip(cuts[::2], cuts[1::2]) if a < b]
            new, at = [], 0
            for a, b, s in found:
                first, last = origin[a][0], origin[b - 1][1]
                new += origin[at:a] + ([(first + i, first + i + 1) for i in range(len(s))] if last - first == len(s) else [(first, last)] * len(s))
                at = b
            origin = new + origin[at:]
            m = m.rewrite(iter(found))
            if not m.text:
                break
            assert len(m.text) == len(origin)
            for _ in range(5):
                a = rng.randrange(len(m.text))
                b = rng.randrange(a, len(m.text)) + 1
                start, stop = m.back(a, b)
                assert start <= origin[a][0] and stop >= origin[b - 1][1] and (start, stop) == (min(start, origin[a][0]), max(stop, origin[b - 1][1]))
                if all(y - x == 1 for x, y in origin[a:b]):
                    assert (start, stop) == (origin[a][0], origin[b - 1][1])


def test_single_characters():
    assert [plain(c) for c in "а９＠．​٣éñß中"] == ["a", "9", "@", ".", "", "3", "é", "ñ", "ß", "中"]
    assert transduced("all plain, at last. Done") is None


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1 " * 150_000, "one two " * 60_000, "a dot b " * 50_000, "(at) " * 60_000, "а" * 300_000):
        find_spans(text)
    late = "x " * 300_000 + "jane (at) mail (dot) com"
    assert [(late[a:b]) for _, a, b, _, _ in find_spans(late)] == ["jane (at) mail (dot) com"]


def test_columns_and_defined_cases(spark):
    rows = [(1, None, "o", "m"), (2, "", "o", "m"), (3, "call +1 (017) 555-7713 or a@b.c!", "o", "m"), (3, "call +1 (017) 555-7713 or a@b.c!", "o", "m"), (None, "1[.]2[.]3[.]4", "o", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, masked_text string")
    out = find_personal_data(docs)
    assert out.columns == ["doc_id", "text", "spans", "masked_text"]
    got = out.select("doc_id", "masked_text", listed(out["spans"]).alias("l")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, None, ""), (2, "", ""), *[(3, "call <phone> or <email>!", "phone:5:22,email:26:31")] * 2, (None, "<ip>", "ip:0:13")]))
    assert find_personal_data(docs.limit(0)).collect() == []


def test_query_against_the_patterns(spark):
    texts = dict(zip(*(pq.read_table(f"{SF_SMALL}/documents.parquet").column(c).to_pylist() for c in ("doc_id", "text"))))
    rows = QUERIES["op12_personal"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_hand(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"] == joined
