import math
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm.common import words
from ledgerline.llm.quality import judge_quality, log_ratios, ngram_buckets, text_measures

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


TEXTS = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z x", "l1\nl1\nl1\n\n \nl2", "#*$%&|<> a# b\x0bc\x0cd\re", "é ü w 日本 😀",
         "Of " * 400, "p q r s " * 3 + "t", "\nsame\nsame \nsame", "a b c d b c d a b c"]


def test_measures_against_brute_force(spark, docs_of, lorem):
    texts = [*TEXTS, *(lorem(i, 300, vocabulary=12) for i in range(20))]
    rows = text_measures(docs_of(list(enumerate(texts)))).collect()
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == measures_by_hand(texts[r["doc_id"]]), repr(texts[r["doc_id"]])[:60]


def test_ratios_and_verdicts_against_brute_force(spark, docs_of, lorem):
    rows = [(i, lorem(i, 80)) for i in range(30)] + [(100 + i, " ".join(f"{w}%%%" for w in lorem(i, 90).split())) for i in range(12)]
    rows += [(None, lorem(1, 70)), (200, None), (201, "too short"), (202, "x y z " * 40), (3, lorem(3, 80)), (203, "")]
    docs = docs_of(rows).withColumn("llr", F.lit("clash")).withColumn("bucket", F.lit(1))
    trusted = spark.createDataFrame([(i,) for i in range(20)] + [(None,), (5,)], "doc_id long")
    out = judge_quality(docs, trusted, buckets=512).collect()
    assert len(out) == len(rows)
    grams = {(r["doc_id"], r["text"]): r["g"] for r in docs.select("doc_id", "text", ngram_buckets(words(F.col("text")), (1, 2), 512).alias("g")).collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        if t:
            raw.update(grams[i, t])
            if i is not None and i < 20:
                target.update(grams[i, t])
    n, m = sum(raw.values()), sum(target.values())
    ratio = [math.log((target[b] + 1) / (m + 512)) - math.log((raw[b] + 1) / (n + 512)) for b in range(512)]
    got = log_ratios(docs.select("doc_id", "text"), trusted, buckets=512).first()["ratios"]
    assert max(abs(a - b) for a, b in zip(got, ratio, strict=True)) < 1e-9
    for r in out:
        n_words = len(WORD.findall(r["text"] or ""))
        failed = n_words < 50 or 100 * r["n_repeat_words"] > 50 * n_words
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["llr"] >= -0.1)
    assert all(r["kept"] for r in out if r["doc_id"] is not None and r["doc_id"] < 20)
    mean = lambda rows: sum(r["llr"] for r in rows) / len(rows)
    named = [r for r in out if r["doc_id"] is not None]
    assert mean([r for r in named if r["doc_id"] < 20]) > 0 > mean([r for r in named if 100 <= r["doc_id"] < 112])
    assert judge_quality(docs.limit(0), trusted).count() == 0
    assert judge_quality(docs, trusted.limit(0)).count() == len(rows)
