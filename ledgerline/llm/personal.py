"""Personal data, also behind disguises, with spans in the characters of the source."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import _by_size

KINDS = ("email", "ip", "card", "phone")

# What counts as an identifier (fixed values). Repetition is possessive where nothing can be given
# back, so that long runs of letters or digits are read once.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3,}+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Disguises (fixed values): names of digits and signs in the languages of the corpus.
_DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_AT_NAMES = ("at", "arroba", "arobase", "klammeraffe")
_DOT_NAMES = ("dot", "punkt", "point", "punto")
_PLUS_NAMES = ("plus", "más")
#: Ends of host names that an undisguised dot must lead to after a bare "at".
_ENDS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "eu", "uk", "ch", "at")
#: Letters of other scripts that look like a Latin one; compatibility forms and digits follow by rule.
_LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅԚԜοανρικυγΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡɑ",
    "aeopcyxijshdqwABEKMHOPCTYXIJSQWoavpikuyABEZHIKMNOPTYXiga", strict=True))
_SIGNS = {"․": ".", "。": ".", "｡": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "⁃": "-"}
_UNSEEN = "­​‌‍⁠﻿"


@lru_cache(maxsize=1 << 16)
def plain(ch: str) -> str:
    """The ASCII character that ``ch`` stands for, nothing for an unseen one, else ``ch`` itself."""
    if ch in _UNSEEN:
        return ""
    if ch in _LOOKALIKES or ch in _SIGNS:
        return _LOOKALIKES.get(ch) or _SIGNS[ch]
    kind = unicodedata.category(ch)
    if kind == "Nd":
        return str(unicodedata.digit(ch))
    if kind == "Zs":
        return " "
    same = unicodedata.normalize("NFKC", ch)
    return same if len(same) == 1 and same.isascii() else _LOOKALIKES.get(same, ch)


class Mapped:
    """A text that transducers rewrote, with the way back to the characters of the source.

    It is a row of stretches: each has its place in the new text and in the source, and
    goes with it character by character if it is as long, else as a whole.
    """

    def __init__(self, text: str, at: list[int], start: list[int], stop: list[int]):
        self.text, self.at, self.start, self.stop = text, at, start, stop

    @classmethod
    def of(cls, source: str) -> Mapped:
        return cls(source, [0], [0], [len(source)])

    def rewrite(self, found: Iterator[tuple[int, int, str]]) -> Mapped:
        """With the stretches ``found`` (start, stop, new text; in order) replaced."""
        out, at, start, stop, size, done = [], [], [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal size
            i = bisect_right(self.at, a) - 1
            while a < b:
                end = self.at[i + 1] if i + 1 < len(self.at) else len(self.text)
                part = self.text[a : min(b, end)]
                if part:
                    exact = self.stop[i] - self.start[i] == end - self.at[i]
                    at.append(size)
                    start.append(self.start[i] + (a - self.at[i]) if exact else self.start[i])
                    stop.append(start[-1] + len(part) if exact else self.stop[i])
                    out.append(part)
                    size += len(part)
                a, i = min(b, end), i + 1

        for a, b, new in found:
            copy(done, a)
            if new:
                at.append(size)
                first, last = self.back(a, b)
                start.append(first)
                stop.append(last)
                out.append(new)
                size += len(new)
            done = b
        copy(done, len(self.text))
        return Mapped("".join(out), at or [0], start or [0], stop or [0])

    def back(self, a: int, b: int) -> tuple[int, int]:
        """The stretch of the source that [a, b) of this text comes from."""
        i, j = bisect_right(self.at, a) - 1, bisect_right(self.at, b - 1) - 1
        end = self.at[j + 1] if j + 1 < len(self.at) else len(self.text)
        exact_first = self.stop[i] - self.start[i] == (self.at[i + 1] if i + 1 < len(self.at) else len(self.text)) - self.at[i]
        exact_last = self.stop[j] - self.start[j] == end - self.at[j]
        return (self.start[i] + (a - self.at[i]) if exact_first else self.start[i],
                self.start[j] + (b - self.at[j]) if exact_last else self.stop[j])


def _names(names) -> str:
    return "|".join(sorted(map(re.escape, names), key=len, reverse=True))


_OPEN, _CLOSE = r"[(\[{<]\s{0,2}", r"\s{0,2}[)\]}>]"
_ODD = re.compile("[^\x00-\x9f¡-©«¬®¯±´-¶¸»-İĲ-ɐɒ-ɠɢ-ͯ‖-‿₠-⃏]")
#: Brackets around "at" or "dot", as words or signs, with blanks around.
_BRACKETED = re.compile(rf"\s{{0,2}}{_OPEN}(?:(?P<at>{_names(_AT_NAMES)}|@)|(?P<dot>{_names(_DOT_NAMES)}|\.)){_CLOSE}\s{{0,2}}", re.I)
_SAID = rf"(?:{_names(_DIGIT_NAMES)})"
_BLANK = r"[ \t\n-]{1,2}"
#: Two names of digits or more in a row.
_SPOKEN = re.compile(rf"(?<![^\W_])(?:(?:{_names(_PLUS_NAMES)}){_BLANK})?{_SAID}(?:{_BLANK}{_SAID})+(?![^\W_])", re.I)
_NAMED_PLUS = re.compile(rf"(?<![^\W_])(?:{_names(_PLUS_NAMES)})[ ]{{0,2}}(?=[0-9])", re.I)
_NAME = r"[A-Za-z0-9_%+-]{1,64}"
_DOT_WORD = rf"\s{{1,2}}(?:{_names(_DOT_NAMES)})\s{{1,2}}"
_AT_WORD = rf"\s{{1,2}}(?:{_names(_AT_NAMES)}|@)\s{{1,2}}"
#: Bare words: names joined by "dot", "at", and names joined by "dot".
_WORDED = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:{_DOT_WORD}{_NAME}){{0,4}}(?:{_AT_WORD}|@)[A-Za-z0-9-]{{1,64}}(?:{_DOT_WORD}[A-Za-z0-9-]{{1,64}}){{0,6}}{_DOT_WORD}(?!{_SAID}\b)[A-Za-z]{{2,24}}(?![\w-])", re.I)
#: A bare "at" before a host name with real dots, behind a name with a digit or sign in it.
_AT_HOST = re.compile(rf"(?<![A-Za-z0-9._%+-])(?=[A-Za-z]{{0,64}}[0-9._%+-])[A-Za-z0-9._%+-]{{2,64}}(?P<at>{_AT_WORD})(?:[A-Za-z0-9-]{{1,64}}\.){{1,6}}(?:{_names(_ENDS)})(?![\w-])", re.I)
_SPOKEN_DOTS = re.compile(rf"(?<=[0-9])\s{{1,2}}(?:{_names(_DOT_NAMES)})\s{{1,2}}(?=[0-9])", re.I)
_INNER_DOT, _INNER_AT = re.compile(_DOT_WORD, re.I), re.compile(_AT_WORD, re.I)
#: Letters among digits that are read as digits.
_MIXED = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl|]{0,3}[0-9])[0-9OoIl|]{2,}+(?![A-Za-z0-9])")
_AS_DIGIT = str.maketrans("OoIl|", "00111")
_HAS_LETTER = re.compile(r"[0-9][OoIiLl|]|[OoIiLl|][0-9]")


def _characters(m: Mapped) -> Mapped:
    """Homoglyphs, compatibility forms, digits of other scripts and unseen characters."""
    found = ((x.start(), x.end(), p) for x in _ODD.finditer(m.text) if (p := plain(x[0])) != x[0])
    return m.rewrite(found)


def _digit_names(m: Mapped) -> Mapped:
    """Rows of digit names to digits without blanks; "plus" before digits to its sign."""

    def spoken() -> Iterator[tuple[int, int, str]]:
        for x in _SPOKEN.finditer(m.text):
            names = re.split(r"[ \t\n-]+", x[0].lower())
            yield x.start(), x.end(), "".join(_DIGIT_NAMES.get(w, "+") for w in names)

    m = m.rewrite(spoken())
    m = m.rewrite((x.start(), x.end(), "+") for x in _NAMED_PLUS.finditer(m.text))
    m = m.rewrite((x.start(), x.end(), ".") for x in _SPOKEN_DOTS.finditer(m.text))
    return m.rewrite((x.start(), x.end(), x[0].translate(_AS_DIGIT)) for x in _MIXED.finditer(m.text) if _HAS_LETTER.search(x[0]))


def _signs(m: Mapped) -> Mapped:
    """Disguised "at" and "dot": in brackets anywhere, as bare words where they make an address."""
    m = m.rewrite((x.start(), x.end(), "@" if x["at"] else ".") for x in _BRACKETED.finditer(m.text))

    def worded() -> Iterator[tuple[int, int, str]]:
        for x in _WORDED.finditer(m.text):
            inner = [(a.start(), a.end(), s) for p, s in ((_INNER_DOT, "."), (_INNER_AT, "@")) for a in p.finditer(x[0])]
            for a, b, sign in sorted(inner):
                yield x.start() + a, x.start() + b, sign

    m = m.rewrite(worded())
    return m.rewrite((*x.span("at"), "@") for x in _AT_HOST.finditer(m.text))


# Quick looks at the lower-cased text that tell most texts without disguise.
_ANY_BRACKET = re.compile(rf"[(\[{{<]\s{{0,2}}(?:{_names(_AT_NAMES)}|{_names(_DOT_NAMES)}|[@.]){_CLOSE}")
_ANY_DOT = re.compile(rf"\s(?:{_names(_DOT_NAMES)})\s")
_ANY_HOST = re.compile(rf"\.(?:{_names(_ENDS)})(?![\w-])")
_TWO_NAMES = re.compile(rf"{_SAID}[ \t\n-]{{1,2}}{_SAID}")
_ANY_DIGIT = re.compile("[0-9]")


def _says_signs(low: str) -> bool:
    return bool(_ANY_BRACKET.search(low) or (any(w in low for w in _DOT_NAMES) and _ANY_DOT.search(low)) or (_ANY_HOST.search(low) and _AT_HOST.search(low)))


def _says_digits(low: str) -> bool:
    return bool(_TWO_NAMES.search(low) or (_ANY_DIGIT.search(low) and (_HAS_LETTER.search(low) or any(w in low for w in _PLUS_NAMES))))


def transduced(text: str) -> Mapped | None:
    """The text with all disguises undone, or none where there is nothing to undo."""
    m = Mapped.of(text)
    if not text.isascii() and _ODD.search(text):
        m = _characters(m)
    low = m.text.lower()
    signs = _says_signs(low)
    if signs:
        m = _signs(m)
    if signs or _says_digits(low):
        m = _digit_names(m)
    return m if m.text != text else None


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of the plain identifiers in a text, leftmost and without overlap within a kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", a, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _DOTTED.finditer(text):
        parts, a = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            b = a + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                out.append(("ip", a, b))
            a = b + 1
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def find_spans(text: str | None) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, stop, plain, reading) of all identifiers in a text, in order.

    Plain ones are read off the source. Then the transducers' text is read in the same
    way, and what it shows only through a disguise is mapped back and added.
    """
    if not text:
        return []
    base = identifiers(text)
    found = {(k, a, b): (True, text[a:b]) for k, a, b in base}
    if (m := transduced(text)) is not None:
        for kind, a, b in identifiers(m.text):
            start, stop = m.back(a, b)
            reading = m.text[a:b]
            if text[start:stop] != reading and not any(k == kind and x <= start and stop <= y for k, x, y in base):
                found.setdefault((kind, start, stop), (False, reading))
    return [(k, a, b, *found[k, a, b]) for k, a, b in sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
                     T.StructField("plain", T.BooleanType()), T.StructField("reading", T.StringType())])


def find_personal_data(docs: DataFrame, masked: bool = True) -> DataFrame:
    """``docs`` (text and other columns) with ``spans`` and, if asked for, ``masked_text``.

    ``spans`` is an array of (kind, start, stop, plain, reading) by start and kind: code
    points of ``text``, stop exclusive. Kinds are email, ip, card and phone. Plain spans
    are identifiers as they stand. The others are found after transducers have undone
    homoglyphs (letters of other scripts, wide and other compatibility forms, unseen
    characters), names of digits and disguises of "at" and "dot"; ``reading`` is what
    was read. ``masked_text`` has each stretch that spans cover replaced by its kind.

    Defined cases: null text has no spans and stays null; empty text has none; texts of
    any length are read whole; repeated rows get the same spans; an empty table stays
    empty; existing columns of these names are replaced.
    """
    names = ("spans", "masked_text")
    schema = T.StructType([f for f in docs.schema if f.name not in names]).add("spans", T.ArrayType(SPAN))
    schema = schema.add("masked_text", T.StringType()) if masked else schema

    def mask(text: str | None, spans: list[tuple[str, int, int, bool, str]]) -> str | None:
        if not spans:
            return text
        out, at = [], 0
        for kind, start, stop, *_ in spans:
            if stop > at:
                out += [text[at:start] if start > at else "", f"<{kind}>" if start >= at else ""]
                at = stop
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for batch in _by_size(whole, "text"):
                texts = batch.column("text").to_pylist()
                found = [find_spans(t) for t in texts]
                rows = [[dict(zip(SPAN.names, s, strict=True)) for s in spans] for spans in found]
                new = {"spans": pa.array(rows, arrow.field("spans").type)}
                if masked:
                    new["masked_text"] = pa.array(map(mask, texts, found), pa.string()).cast(arrow.field("masked_text").type)
                yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
