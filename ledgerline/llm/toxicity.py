"""Toxicity by a support vector machine on gapped character subsequences, with Nyström landmarks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shipped

#: Bounds of the training sample: documents of each class, characters of one of them.
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
LANDMARKS = 64
THRESHOLD = 0.7
#: Subsequences of 3 characters that span up to SPAN + 1 places; each place costs a factor DECAY.
SPAN, DECAY = 5, 0.6
#: Similarities below this are taken as none.
FLOOR = 0.35
#: Letters of a token scored at once; longer tokens are read in overlapping windows.
WINDOW = 24
CACHE_WORDS = 400_000
#: Strings whose similarities are computed at once.
BATCH = 4_000

_SYMBOLS = 48  # 0 nothing, 1..26 a-z, 27 another letter, 28 the edge of a token, from 29 on Latin letters with marks
_SENTENCE = re.compile(r"[.!?\n]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"(?<!\w)[^\W\d_](?:[\s.*_-]{1,3}[^\W\d_]){2,}(?!\w)")
_GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN + 1 - a)]


def _symbol(code: int) -> int:
    """Letter to symbol; letters with marks keep apart from plain ones, as they make other words."""
    ch = chr(code).lower()[0]
    return ord(ch) - 96 if "a" <= ch <= "z" else 29 + ord(ch) % 19 if ch.isalpha() else 27


#: Symbols of the code points with Latin letters; all later ones are other letters.
_LATIN = np.array([_symbol(i) for i in range(0x250)] + [27], np.int32)


def tokens(word: str) -> list[str]:
    """What a white-space word may spell: its letter runs, and all its letters without what stands between."""
    if word.isalpha():
        return [word]
    runs = _LETTERS.findall(word)
    if len(runs) <= 1:
        return runs
    return list({"".join(runs), *(r for r in runs if len(r) > 2)})


def spelled_out(text: str) -> list[str]:
    """Words spelled letter by letter, as in ``w o r d``."""
    return ["".join(_LETTERS.findall(m)) for m in _SPELLED.findall(text)]


def _windows(token: str) -> list[str]:
    return [token] if len(token) <= WINDOW else [token[i : i + WINDOW] for i in range(0, len(token) - WINDOW // 2, WINDOW // 2)]


def _matrix(strings: list[str]) -> np.ndarray:
    """A row of symbols for each string, an edge on either side, then padding."""
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = _LATIN[np.minimum(np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32), 0x250)]
    m = np.zeros((len(strings), int(size.max()) + 2 + SPAN), np.int32)
    at = np.arange(m.shape[1])
    m[(at > 0) & (at <= size[:, None])] = flat
    m[:, 0] = m[np.arange(len(strings)), size + 1] = 28
    return m


def _gapped(m: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """Weight and number of each row's subsequences, a block for each pair of gaps; those into padding end in symbol 0."""
    width = m.shape[1] - SPAN
    for a, b in _GAPS:
        yield DECAY ** (a + b - 2), (m[:, :width] * _SYMBOLS + m[:, a : a + width]) * _SYMBOLS + m[:, a + b : a + b + width]


def _features(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse unit vectors of the subsequence kernel's feature space: (row, subsequence, value)."""
    keys, weights = [], []
    for weight, sub in _gapped(m):
        row, col = np.nonzero(sub % _SYMBOLS)
        keys.append(row * _SYMBOLS**3 + sub[row, col])
        weights.append(np.full(len(row), weight))
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(back, np.concatenate(weights), len(key))
    row, sub = key // _SYMBOLS**3, key % _SYMBOLS**3
    norm = np.sqrt(np.bincount(row, value * value, len(m)))
    return row, sub, value / np.maximum(norm[row], 1e-12)


@dataclass
class Model:
    """Landmark table (subsequence by landmark), weights on squared similarities, and the calibration."""

    landmarks: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def __post_init__(self):
        sub, self.marks = np.nonzero(self.landmarks)
        self.values = self.landmarks[sub, self.marks]
        self.peak = self.landmarks.max(axis=1)
        self.counts = np.bincount(sub, minlength=len(self.landmarks))
        self.starts = np.r_[0, np.cumsum(self.counts)[:-1]]
        self.landmarks = self.landmarks[:0]  # held as lists from here on

    def similar(self, strings: list[str]) -> np.ndarray:
        """Squared normalised kernel of each string with each landmark; similarities below FLOOR count as none.

        A bound on the similarity to any landmark, without the sort that exact
        values need, settles most strings.
        """
        out = np.zeros((len(strings), self.landmarks.shape[1]), np.float32)
        if not strings:
            return out
        m = _matrix(strings)
        most, norm = np.zeros(len(m), np.float32), np.zeros(len(m), np.float32)
        for weight, sub in _gapped(m):
            most += weight * self.peak[sub].sum(axis=1)
            norm += weight * weight * (sub % _SYMBOLS > 0).sum(axis=1)
        near = np.flatnonzero(most >= FLOOR * np.sqrt(norm) - 1e-3)
        if len(near):
            row, sub, value = _features(m[near])
            n = self.counts[sub]  # landmarks that hold each subsequence
            at = np.repeat(self.starts[sub] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            sims = np.bincount(np.repeat(row, n) * out.shape[1] + self.marks[at], np.repeat(value, n) * self.values[at], len(near) * out.shape[1])
            sims = sims.reshape(len(near), -1)
            out[near] = np.where(sims >= FLOOR, sims * sims, 0)
        return out

    def margins(self, strings: list[str]) -> np.ndarray:
        order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
        out = np.empty(len(strings))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            out[part] = self.similar([strings[k] for k in part]) @ self.weights + self.bias
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60)))


def _landmark_table(strings: list[str]) -> np.ndarray:
    row, sub, value = _features(_matrix(strings))
    out = np.zeros((_SYMBOLS**3, len(strings)), np.float32)
    out[sub, row] = value
    return out


def _fit_svm(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    active = np.ones(len(x), bool)
    for _ in range(50):
        xa, ca = x[active], c[active]
        w = np.linalg.solve((xa * ca[:, None]).T @ xa + ridge, (xa * ca[:, None]).T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's calibration with smoothed targets and even class weights."""
    pos, neg = max(1, (y > 0).sum()), max(1, (y <= 0).sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, 0.5 / pos, 0.5 / neg)
    a, b = 1.0, 0.0
    x = np.c_[margin, np.ones(len(margin))]
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (p - target)) + 1e-4 * np.array([a - 1, b]))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(max(a, 1e-3)), float(b)


def _witnesses(bag: list[list[str]], score) -> list[str]:
    """The most toxic token of a toxic text's worst sentence, and of its other sentences that are half as bad."""
    tops = [max(s, key=lambda t: (score(t), t)) for s in bag]
    worst = max(map(score, tops))
    return [t for t in tops if score(t) == worst or (worst > 0 and score(t) >= worst / 2)]


def _excess(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Standard errors by which a token's share of toxic texts exceeds its share of clean ones."""
    p = (toxic + clean) / (n_toxic + n_clean)
    return (toxic / n_toxic - clean / n_clean) / np.sqrt(max(p * (1 - p), 1e-12) * (1 / n_toxic + 1 / n_clean))


def _supported(witness: Counter, leading: list[str], odds: dict[str, float]) -> Counter:
    """Witnesses among the leading tokens, or much like one and rarer in clean texts; all, if there are none."""
    names = sorted(witness, key=lambda t: (-witness[t], t))
    probe = Model(_landmark_table(leading), np.zeros(len(leading)), 0.0, 1.0, 0.0)
    near = np.concatenate([probe.similar(names[i : i + BATCH]).max(axis=1) for i in range(0, len(names), BATCH)])
    own = set(leading)
    return Counter({t: witness[t] for t, x in zip(names, near, strict=True) if t in own or (x >= 0.36 and odds[t] > np.log(2.5))}) or witness


def _inserted(token: str, rng: np.random.Generator, n: int) -> list[str]:
    """Variants of a token with a letter put in, as evasive spellings have."""
    out = []
    for _ in range(n):
        at = int(rng.integers(1, len(token)))
        out.append(token[:at] + chr(97 + int(rng.integers(0, 26))) + token[at:])
    return out


def fit(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS, seed: int = 5, rounds: int = 3, threshold: float = THRESHOLD) -> Model:
    """Train on labelled texts, sentence by sentence.

    A toxic text is a bag of sentences of which one at least is toxic, a sentence
    a bag of tokens: each round takes the most toxic tokens of each toxic text's
    worst sentences as positive examples, and tokens of clean sentences as
    negative ones, the hardest among them always. The first round goes by how
    far a token's share of toxic texts exceeds its share of clean ones. Positive tokens are repeated
    with inserted letters. Labels may be wrong: a token has to stand
    in clearly more toxic texts than clean ones, or be like one that does, and texts whose label the supported
    tokens contradict are left out of the calibration, in which even odds of the classes give
    ``threshold``. Landmarks are the leading positive tokens and clean
    tokens; weights are learnt in the Nyström feature space of the kernel.
    """
    rng = np.random.default_rng(seed)
    bags = []
    beside: dict[str, set[int]] = {}  # hashes of the words before and after each token of a toxic text
    for text, label in zip(texts, toxic, strict=True):
        text = (text or "").lower()
        if label:
            words = ["", *text.split(), ""]
            for before, word, after in zip(words, words[1:], words[2:], strict=False):
                for t in tokens(word):
                    for w in _windows(t):
                        beside.setdefault(w, set()).add(hash((before, after)))
        said = [sorted({w for word in s.split() for t in tokens(word) for w in _windows(t)}) for s in _SENTENCE.split(text)]
        bags.append([s for s in [*said, sorted(set(spelled_out(text)))] if s])
    y = np.asarray(toxic)
    seen = [Counter(), Counter()]
    for bag, label in zip(bags, y, strict=True):
        seen[label].update({t for s in bag for t in s})
    # Copies of one text say the same thing once: a token counts as often as it stands between other words.
    seen[1] = Counter({t: min(c, len(beside.get(t, "1"))) for t, c in seen[1].items()})
    del beside
    n = [max(1, (y == 0).sum()), max(1, (y == 1).sum())]
    clean = sorted(seen[0])
    if not clean or not seen[1]:  # nothing to tell apart: every text scores 0.5
        return Model(np.zeros((_SYMBOLS**3, 1), np.float32), np.zeros(1), 0.0, 1.0, 0.0)
    odds = {t: np.log((c + 0.5) / n[1]) - np.log((seen[0][t] + 0.5) / n[0]) for t, c in seen[1].items()}
    excess = {t: _excess(c, seen[0][t], n[1], n[0]) for t, c in seen[1].items()}
    leading = sorted(excess, key=lambda t: (-excess[t], t))
    leading = [t for t in leading if excess[t] >= 5 and odds[t] >= np.log(20)][:400] or leading[:20]
    score = excess.__getitem__
    frequent = [t for t, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0]))]
    model = None
    hard: list[str] = []
    for _ in range(rounds):
        witness = Counter(t for bag, label in zip(bags, y, strict=True) if label == 1 and bag for t in _witnesses(bag, score))
        witness = _supported(witness, leading, odds)
        sure = {t for t in witness if odds[t] > np.log(5)}
        found = [t for t, _ in sorted(witness.items(), key=lambda x: (-x[1], x[0]))]
        marks = found[: landmarks // 2]
        marks += [t for t in dict.fromkeys([*hard[: landmarks // 4], *frequent[: landmarks // 4]]) if t not in marks][: landmarks - len(marks)]
        table = _landmark_table(marks)
        probe = Model(table, np.zeros(len(marks)), 0.0, 1.0, 0.0)
        positive = [(t, c) for t, c in witness.items()] + [(v, c / 4) for t, c in witness.items() if len(t) > 3 and c > 2 for v in _inserted(t, rng, 8)]
        negative = [t for t in dict.fromkeys([*hard, *frequent[:3000], *(clean[i] for i in rng.permutation(len(clean))[:6000])]) if t not in sure]
        names = [t for t, _ in positive] + negative
        among = probe.similar(marks).astype(float)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
        sims = np.concatenate([probe.similar(names[i : i + BATCH]) for i in range(0, len(names), BATCH)]).astype(float)
        share = np.array([c for _, c in positive], float)
        cost = np.r_[200 * share / share.sum() * len(positive) ** 0.5, np.full(len(negative), 1.0)]
        w = _fit_svm(sims @ whiten, np.r_[np.ones(len(positive)), -np.ones(len(negative))], cost)
        model = Model(table, whiten @ w[:-1], float(w[-1]), 1.0, 0.0)
        every = sorted({t for bag in bags for s in bag for t in s})
        margin = dict(zip(every, model.margins(every), strict=True))
        score = margin.__getitem__
        hard = sorted(set(clean) - sure, key=lambda t: (-margin[t], t))[:1500]
    of_text = np.array([max([model.bias, *(margin[t] for s in bag for t in s)]) for bag in bags])
    told = np.array([any(t in sure for s in bag for t in s) for bag in bags]) == (y == 1)
    fair = told if (told & (y == 1)).any() and (told & (y == 0)).any() else np.ones(len(y), bool)
    model.slope, model.offset = _fit_sigmoid(of_text[fair], y[fair])
    model.offset += float(np.log(threshold / (1 - threshold)))
    return model


class Scorer:
    """Scores whole texts: the highest margin of any token, calibrated. Keeps words already scored."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def _learn(self, new: set[str]) -> None:
        found = [(word, s) for word in new for t in tokens(word) for s in _windows(t)]
        margins = self.model.margins([s for _, s in found])
        best = dict.fromkeys(new, self.model.bias)
        for (word, _), m in zip(found, margins.tolist(), strict=True):
            if m > best[word]:
                best[word] = m
        self.cache.update(best)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = []
        bags = []
        for text in texts:
            text = (text or "").lower()
            bag = set(text.split())
            bag.update(spelled_out(text))
            bags.append(bag)
        new = set().union(*bags).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = set().union(*bags)
        self._learn(new)
        for bag in bags:
            out.append(max(map(self.cache.__getitem__, bag), default=self.model.bias))
        return self.model.probability(np.array(out, float))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, **options) -> Model:
    """Fit on a bounded sample: of each class the ``sample_docs`` labelled documents with the
    smallest hash of doc_id, those of up to ``sample_chars`` characters. Held-out rows
    (crc32 of doc_id modulo 3 is 1) and labels other than 0 and 1 are left out."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    picked = None
    for label in (0, 1):
        part = known.where(F.col("__toxic") == label).orderBy(F.xxhash64("__id"), "__id").limit(sample_docs)
        picked = part if picked is None else picked.unionByName(part)
    # At most 2 * sample_docs ids: a proven bound for the broadcast and for what reaches the driver.
    rows = (docs.select("doc_id", "text").where(F.char_length("text") <= sample_chars)
            .join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("__toxic").alias("toxic")).orderBy("doc_id").limit(2 * sample_docs).collect())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], **options)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (text and other columns) with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Defined cases: null and empty texts have the score of a text without any
    token; whole texts of any length are read; repeated rows get equal scores; columns
    named score or predicted are replaced, all others kept.
    """
    shared = shipped(docs.sparkSession, model)
    own = ("score", "predicted")
    schema = T.StructType([f for f in docs.schema if f.name not in own]).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scorer, arrow = Scorer(shared()), to_arrow_schema(schema)
        for batch in batches:
            texts, parts, at = batch.column("text"), [], 0
            while at < batch.num_rows:
                part, size = [], 0
                while at < batch.num_rows and (not part or size < 2_000_000):
                    part.append(texts[at].as_py())
                    size += len(part[-1] or "")
                    at += 1
                parts.append(scorer.scores(part))
            score = pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([score if f.name == "score" else batch.column(f.name) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
