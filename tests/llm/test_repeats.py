from ledgerline.llm.repeats import remove_repeats


def by_hand(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def test_against_brute_force(spark, docs_of, lorem):
    shared, other = lorem("p", 70), lorem("q", 50)
    rows = [(i, lorem(i, 40 + i)) for i in range(40)]
    rows += [(100 + i, f"{lorem(f'a{i}', i)} {shared} {lorem(f'b{i}', 9 * i % 31)}") for i in range(30)]
    rows += [(200 + i, f"{shared} {other}" if i % 2 else f"{other}\n{lorem(i, 3)} {shared}") for i in range(10)]
    rows += [(300 + i, lorem("copy", 120)) for i in range(40)]
    rows += [(400, "a " * 300), (401, "a " * 200), (402, "a " * 49), (403, lorem("near", 60)), (404, lorem("near", 59) + " zz"),
             (405, lorem("near", 49)), (None, shared), (100, shared), (100, shared), (500, None), (501, ""), (502, " \t\n"), (503, "x y  z")]
    got = remove_repeats(docs_of(rows)).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows, 50)
    small = [(i, t) for i, t in rows if i is None or i < 320]
    got = remove_repeats(docs_of(small), window=4, keep=["doc_id"]).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(small, 4)


def test_columns_and_empty_table(spark, docs_of, lorem):
    from pyspark.sql import functions as F

    docs = docs_of([(1, lorem(1, 60)), (2, lorem(1, 60))]).withColumn("n_words", F.lit("clash")).withColumn("spans", F.lit(1)).withColumn("doc", F.lit(2))
    out = remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "doc", "kept_text", "n_words", "n_removed"]
    assert {r["doc_id"]: (r["n_removed"], r["text"] == lorem(1, 60)) for r in out.collect()} == {1: (0, True), 2: (60, True)}
    assert remove_repeats(docs.limit(0)).count() == 0
