from tests.conftest import SF_SMALL


def test_stages_chain_and_keep_columns(spark):
    import corpus_pipeline as P
    from ledgerline.llm.common import materialise

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "mixing", "sentencepiece"]
    for name, stage in P.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF_SMALL), f"test_{name}")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    out = P.STAGES[-1][1](spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_empty_table_and_nulls(spark, docs_of, lorem):
    import corpus_pipeline as P
    from ledgerline.llm.common import materialise

    rows = [(i, lorem(i, 70), f"s{i % 2}") for i in range(20)] + [(None, lorem(50, 60), None), (30, None), (31, ""), (32, lorem(1, 70)), (1, lorem(1, 70), "s1")]
    for docs in (docs_of(rows), docs_of(rows).limit(0)):
        for name, stage in P.STAGES:
            docs = materialise(stage(spark, docs, SF_SMALL), f"test_{name}")
        ids = [r["doc_id"] for r in docs.collect()]
        assert 32 not in ids


def test_copies_of_a_document_are_cut_apart(spark, docs_of, lorem):
    import corpus_pipeline as P

    docs = docs_of([(1, lorem(1, 300))] * 3 + [(2, lorem(2, 300)), (None, lorem(3, 300)), (None, lorem(3, 300))])

    def cuts(docs):
        return sorted((str(r["doc_id"]), tuple(r["piece_ids"])) for r in P.to_pieces(spark, docs, SF_SMALL).collect())

    got = cuts(docs)
    assert len(got) == len(set(got)) == 6
    assert cuts(docs.repartition(3)) == got


def test_stages_against_plain_versions(spark, docs_of, lorem):
    """Every stage on what its predecessor kept: near copies and repeats by brute force, mixing by its bounds, pieces read back.
    With a very long text, repeated rows, and columns named like the operators' own."""
    from pyspark.sql import functions as F

    import corpus_pipeline as P
    from ledgerline.llm.common import materialise, table
    from ledgerline.llm.pieces import decode_pieces
    from ledgerline.llm.toxicity import score_toxicity, train
    from tests.llm.test_jaccard import by_hand as groups_by_hand
    from tests.llm.test_jaccard import edited
    from tests.llm.test_repeats import by_hand as cuts_by_hand

    passage = lorem("passage", 60)
    rows = [(i, lorem(i, 60 + i), f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, edited(lorem("base", 150), 0.01, i), "s0") for i in range(8)] + [(100, edited(lorem("base", 150), 0.01, 0), "s0")]
    rows += [(200 + i, f"{lorem(f'a{i}', 80)} {passage} {lorem(f'b{i}', 80)}", "s1") for i in range(6)]
    rows += [(300, lorem("long", 120_000), "s2"), (301, None), (302, ""), (None, lorem("none", 70), None)]
    docs = docs_of(rows).withColumn("size", F.lit("old")).withColumn("node", F.lit(1)).withColumn("piece_ids", F.lit(0))

    scored = score_toxicity(docs, train(docs, table(spark, SF_SMALL, "labels"))).where("predicted = 0")
    kept = materialise(P.drop_toxic(spark, docs, SF_SMALL), "test_toxic")
    assert kept.columns == docs.columns
    key = lambda r: (str(r["doc_id"]), r["text"] or "")
    assert sorted(map(key, kept.collect())) == sorted(map(key, scored.collect()))

    before = [(r["doc_id"], r["text"]) for r in kept.collect()]
    firsts = {d for d, _, c in groups_by_hand(before) if d is None or d == c}
    once = materialise(P.drop_near_copies(spark, kept, SF_SMALL), "test_near")
    got = [(r["doc_id"], r["text"]) for r in once.collect()]
    assert once.columns == docs.columns and sorted(got, key=str) == sorted({x for x in before if x[0] in firsts}, key=str)

    cut = materialise(P.drop_repeats(spark, once, SF_SMALL), "test_repeats")
    want = sorted(((d, k if gone else t) for (d, t), (_, _, gone, k) in zip(sorted(got, key=lambda x: str((x[0], len((x[1] or "").split())))), sorted(cuts_by_hand(got, 50), key=lambda x: str((x[0], x[1]))), strict=True)
                   if not gone or k), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=str) == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in cut.collect())

    mixed = materialise(P.mix_sources(spark, cut, SF_SMALL), "test_mixed")
    copies = {}
    for r in mixed.collect():
        copies[r["doc_id"], r["text"]] = copies.get((r["doc_id"], r["text"]), 0) + 1
    texts = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert mixed.columns == docs.columns and copies.keys() <= texts and max(copies.values()) <= 3
    words = {k: len((k[1] or "").split()) for k in texts}
    total = sum(words.values())
    assert total - max(words.values()) <= sum(n * words[k] for k, n in copies.items()) <= total

    back = decode_pieces(P.to_pieces(spark, mixed, SF_SMALL)).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in back) == sorted((str(d), t) for (d, t), n in copies.items() for _ in range(n))
    assert all(r["n_pieces"] == len(r["piece_ids"]) for r in back)
