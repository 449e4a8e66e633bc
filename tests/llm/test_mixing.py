from pyspark.sql import functions as F

from ledgerline.llm.mixing import source_targets, taken_documents, weighted_fair_mix


def targets_by_hand(sizes, weights, cap):
    """Reshare the excess of capped sources until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def test_targets_are_water_filled(spark):
    for sizes in ({"a": 10, "b": 500, "c": 3, None: 40, "é": 70}, {"a": 1000, "b": 1}, {"a": 0, "b": 5}, {"x": 7}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in source_targets(df, (5, 2, 1), 1.0, 3).collect()}
        want = targets_by_hand(sizes, (5, 2, 1), 3)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-6 for k in want), (got, want)


def test_mix_meets_targets_and_cap(spark, docs_of, lorem):
    rows = [(i, lorem(i, 5 + i % 40), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(None, None, None), (901, "", "hot"), (902, " \n", None), (5, lorem(5, 10), "s5"), (5, lorem(5, 10), "s5")]
    out = weighted_fair_mix(docs_of(rows).withColumn("size", F.lit("clash"))).collect()
    assert len(out) == len(rows)
    assert sum(r["taken"] for r in out) <= sum(r["size"] for r in out)
    for source in {r["source"] for r in out}:
        mine = [r for r in out if r["source"] == source]
        taken, target = sum(r["taken"] for r in mine), mine[0]["target"] or 0
        assert abs(taken - target) <= 2 * max(r["size"] for r in mine) + 1
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in mine)
    again = weighted_fair_mix(docs_of(rows).repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), r["text"] or "", str(r["source"]), r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_finish_times_by_brute_force(spark, docs_of):
    """Equal targets: every source is taken to the same virtual time."""
    rows = [(i, "a " * (1 + i % 9), f"s{i % 4}") for i in range(400)]
    out = weighted_fair_mix(docs_of(rows), weights=(1,)).collect()
    per = {}
    for r in out:
        per.setdefault(r["source"], [0, 0])[0] += r["taken"]
        per[r["source"]][1] = r["target"]
    assert all(abs(t - g) <= 9 for t, g in per.values())


def test_mixture_rows_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "one two three", "a"), (2, "four", "b"), (3, None, "b")])
    copies = {r["doc_id"]: r["copies"] for r in weighted_fair_mix(docs).collect()}
    rows = taken_documents(docs)
    assert rows.columns == docs.columns
    got = [r["doc_id"] for r in rows.collect()]
    assert {k: got.count(k) for k in copies} == copies
    assert weighted_fair_mix(docs.limit(0)).count() == 0
    assert taken_documents(docs.limit(0)).count() == 0
