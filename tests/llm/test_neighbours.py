import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm.neighbours import nearest
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, q, k):
    own = dict(rows)
    scored = sorted((-float(np.dot(np.array(v, np.float32).astype(float), np.array(own[q], np.float32).astype(float))), i) for i, v in rows if i != q)
    return scored[:k]


def recall(spark, rows, queries, k=20, **options):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], SCHEMA)
    got = {}
    for r in nearest(df, df.where(F.col("vec_id").isin(queries)), k=k, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in queries:
        want = exact(rows, q, k)
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(want) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        score = {i: -s for s, i in exact(rows, q, len(rows))}
        assert all(abs(score[i] - s) < 1e-9 for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in want}) / max(1, len(want))
    return hits / len(queries)


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(3000, 32))
    v[:1500] = v[rng.integers(1500, 1520, 1500)] + 0.05 * rng.normal(size=(1500, 32))  # half of all crowd around a few
    v *= rng.uniform(0.5, 2, (3000, 1))  # lengths differ, so the largest product is not the smallest angle
    rows = list(enumerate(v.astype(np.float32)))
    assert recall(spark, rows, list(range(0, 3000, 60))) >= 0.9


def test_every_candidate_of_a_small_table_and_ties(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(10)] + [(20, [0.0, 2.0, 0.0]), (21, [-1.0, 0.0, 1.0])]
    assert recall(spark, rows, [0, 9, 20, 21]) == 1.0
    assert recall(spark, rows, [0], k=3) == 1.0


def test_defined_cases(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [1.0]), (9, []), (None, [1.0, 1.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("clash")).withColumn("rank", F.lit(0))
    out = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(df, df).collect()]
    assert sorted(out) == [(1, 1, 2, 0.5), (1, 2, 10, -1.0), (2, 1, 1, 0.5), (2, 2, 10, -0.5), (10, 1, 2, -0.5), (10, 2, 1, -1.0)]
    assert nearest(df.limit(0), df).count() == 0
    assert nearest(df.where("vec_id = 1"), df).count() == 0


def test_recall_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    assert recall(spark, rows, [i for i, _ in rows if i % 20 == 0]) >= 0.9
