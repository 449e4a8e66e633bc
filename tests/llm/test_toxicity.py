import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.toxicity import _SYMBOLS, Scorer, _features, _matrix, fit, held_out, score_toxicity, spelled_out, tokens, train

DECAY, SPAN = 0.6, 5


def kernel_by_hand(s, t):
    def features(x):
        x = "^" + x + "^"
        out = {}
        for i in range(len(x)):
            for j in range(i + 1, len(x)):
                for k in range(j + 1, len(x)):
                    if k - i <= SPAN:
                        out[x[i], x[j], x[k]] = out.get((x[i], x[j], x[k]), 0) + DECAY ** (k - i - 2)
        return out

    a, b = features(s), features(t)
    dot = sum(v * b.get(u, 0) for u, v in a.items())
    return dot / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))


def test_kernel_against_brute_force():
    words = ["idiot", "idxiot", "idiotic", "banana", "aaaa", "ab", "abc", "scum"]
    row, sub, value = _features(_matrix(words))
    dense = np.zeros((len(words), _SYMBOLS**3))
    dense[row, sub] = value
    got = dense @ dense.T
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert abs(got[i, j] - kernel_by_hand(s, t)) < 1e-9, (s, t)
    assert np.allclose(np.diag(got), 1) and got[0, 1] > 0.5 > got[0, 3]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    syllables = ["ta", "ro", "ni", "sel", "ko", "mun", "dra", "pe", "li", "vo", "gas", "ter"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    bad = ["blorgwit", "zinkface", "humptard"]
    texts, toxic = [], []
    for i in range(400):
        said = [" ".join(word() for _ in range(8)) for _ in range(5)]
        if i % 4 == 0:
            for _ in range(2):
                said[int(rng.integers(0, 5))] += " " + bad[int(rng.integers(0, 3))]
        texts.append(". ".join(said).capitalize())
        toxic.append(int(i % 4 == 0))
    return fit(texts, toxic)


def test_insults_with_gaps_and_insertions(model):
    scorer = Scorer(model)
    score = lambda t: float(scorer.scores([t])[0])
    clean = "Taro nisel kodra munli. Voter gaspe"
    assert score(clean) < 0.3 and score("") < 0.3 and score(None) == score("")
    for insult in ("blorgwit", "BLORGWIT!", "blorg-wit", "b.l.o.r.g.w.i.t", "b l o r g w i t", "blor*gwit", "zinkface,", "humptard?"):
        assert score(f"{clean} {insult} ronili.") >= 0.7, insult
    for insult in ("blorxgwit", "zinkfface", "humptaard"):
        assert score(f"{clean} {insult} ronili.") > score(clean) + 0.2, insult
    assert score(clean + " " + "taro " * 20000 + " blorgwit") >= 0.7


def test_tokens_and_spelled_words():
    assert tokens("word") == ["word"] and tokens("!!") == [] and tokens("(word),") == ["word"]
    assert set(tokens("big-word")) == {"bigword", "big", "word"}
    assert spelled_out("see i d i o t and x y") == ["idiot"]


def test_held_out_accuracy_and_columns(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = score_toxicity(docs.withColumn("score", F.lit("clash")), train(docs, labels))
    assert scored.columns == [*docs.columns, "score", "predicted"]
    rows = scored.join(labels.select("doc_id", "toxic"), "doc_id").where(held_out()).select("score", "predicted", "toxic").collect()
    assert len(rows) > 1000
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) >= 0.94  # some labels of this table are wrong
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_nulls_repeats_and_empty_tables(spark, docs_of, model):
    docs = docs_of([(None, "blorgwit"), (1, None), (1, None), (2, ""), (3, "taro"), (3, "taro")])
    out = score_toxicity(docs, model).collect()
    assert len(out) == 6 and [r["predicted"] for r in out if r["doc_id"] is None] == [1]
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2)}) == 1
    assert score_toxicity(docs.limit(0), model).count() == 0
    none = train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert score_toxicity(docs, none).where("predicted = 1").count() == 0
