import hashlib
import math
import re
import zlib
from collections import Counter

from ledgerline.llm.importance import WindowBuckets, importance_resample, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def features(text, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


def by_hand(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    found = [(d, *features(t, longest)) for d, t in docs]
    s, t = Counter(f % buckets for _, fs, _ in found for f in fs), Counter(f % buckets for x in target for f in features(x, longest)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * (S + buckets)) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)}
    rows = []
    for d, fs, n in found:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f % buckets] for f in fs)
        rows.append((d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((-r[3], r[0] is None, r[0] or 0) for r in rows if r[4] >= least)
    fit = fit[: len(fit) * percent // 100]
    return rows, fit


def test_draw_equals_brute_force(spark, docs_of, lorem):
    rows = [(i, lorem(i, 10 + i % 40, 300)) for i in range(200)] + [(1000, None), (1001, ""), (1002, "Ä ñ x9 A.B")]
    target = [lorem(i, 60, 40) for i in range(5)]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for longest in (1, 3):
        out = importance_resample(docs_of(rows), aim, longest=longest, keep=["doc_id"]).collect()
        want, fit = by_hand(rows, target, longest)
        assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in out) == sorted(w[:4] for w in want)
        drawn = sorted((r["rank"], r["doc_id"]) for r in out if r["rank"] is not None)
        assert [d for _, d in drawn] == [d for *_, d in fit] and [k for k, _ in drawn] == list(range(1, len(fit) + 1))


def test_windows_cross_slices(monkeypatch):
    import ledgerline.llm.importance as M

    text = "Aa bb  cc-dd ee ff GG é9 " * 40
    whole = {k: sorted(WindowBuckets(k, 1 << 30).of(text)[1].tolist()) for k in (1, 2, 4)}
    monkeypatch.setattr(M, "SLICE_CHARS", 7)
    for k, want in whole.items():
        n, got = WindowBuckets(k, 1 << 30).of(text)
        assert n == 8 * 40 and sorted(got.tolist()) == want == sorted(f % (1 << 30) for f in features(text, k)[0])


def test_offsets_point_at_words():
    text = "It’s ONE two\tthree x1é!"
    (part, pairs), = WindowBuckets().offsets(text)
    assert [part[a:b] for a, b in pairs] == WORD.findall(text.translate(LOWER))


def test_ties_repeats_and_extra_columns(spark, lorem):
    text = lorem(3, 50)
    rows = [(i % 3 if i < 60 else None, text, "old", "x") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string, weight string")
    out = importance_resample(docs, docs.select("text"), percent=50)
    assert out.columns == ["doc_id", "text", "n_features", "weight", "score", "rank"]
    got = out.collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 46))
    first = [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    _, fit = by_hand([(r[0], r[1]) for r in rows], [text] * 90, percent=50)
    assert first == [None if null else d for _, null, d in fit]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance_resample(none, none.select("text")).collect() == []
    one = importance_resample(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none.select("text")).first()
    assert (one["n_features"], one["rank"]) == (2, None)


def test_long_text_is_read_whole(spark, lorem):
    text = lorem(1, 300_000)
    docs = spark.createDataFrame([(1, text), (2, "w1x")], "doc_id long, text string")
    assert importance_resample(docs, docs.select("text"), keep=["doc_id"]).where("doc_id = 1").first()["n_features"] == 300_000


def test_rank_needs_no_single_task(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id"))
    out = ranked(df, [F.col("k").desc(), F.col("id")]).collect()
    assert sorted((r["rank"], r["k"], r["id"]) for r in out) == [(i + 1, 1 - i // 2500, 2 * (i % 2500) + 1 - i // 2500) for i in range(5000)]
