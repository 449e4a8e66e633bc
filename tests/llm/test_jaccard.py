import random

import numpy as np
import pytest

from ledgerline.llm.jaccard import jaccard_components, one_of_each_group, parity, t_occurrence

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k=5):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def by_hand(rows, percent=80):
    sets = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            n = len(a & b)
            if n and 100 * n >= percent * (len(a) + len(b) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), None if d is None else least[find(i)]) for i, (d, s) in enumerate(sets)), key=str)


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def make_rows(lorem):
    line = lorem("line", 12)
    rows = [(i, lorem(i, 20 + 5 * i % 90) + (" " + line if i % 2 else "")) for i in range(90)]
    base = lorem("base", 120)
    rows += [(200 + i, edited(base, (i % 12) / 200, i)) for i in range(110)]
    rows += [(400 + i, base) for i in range(40)]
    rows += [(500, "a b c"), (501, "A B c"), (502, "a b d"), (503, ""), (504, None), (505, " \n"), (506, "a b c d e"), (507, "a b c d e a b c d e"),
             (508, "É b c d e f"), (509, "é b c d e f"), (None, base), (200, lorem("again", 30)), (200, lorem("again", 30))]
    return rows


def test_components_against_brute_force(spark, docs_of, lorem):
    rows = make_rows(lorem)
    docs = docs_of(rows).withColumnRenamed("doc_id", "doc").repartition(6)
    got = jaccard_components(docs).select("doc", "n", "component").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows)


@pytest.mark.parametrize("crowd, hubs", [(20_000, 3), (1, 0)])
def test_components_with_long_lists_in_pieces(spark, docs_of, lorem, monkeypatch, crowd, hubs):
    from ledgerline.llm import jaccard

    for name, value in (("LONGEST", 20), ("BLOCK", 2), ("SHORT", 3), ("CROWD", crowd), ("HUBS", hubs)):
        monkeypatch.setattr(jaccard, name, value)
    rows = make_rows(lorem)
    got = jaccard_components(docs_of(rows).withColumnRenamed("doc_id", "doc").repartition(6)).select("doc", "n", "component").collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows)


def test_one_of_each_group(spark, docs_of, lorem):
    from pyspark.sql import functions as F

    rows = [r for r in make_rows(lorem) if r[0] is not None]
    docs = docs_of(rows).withColumn("node", F.lit("clash")).withColumn("component", F.lit(1))
    out = one_of_each_group(docs)
    assert out.columns == docs.columns
    want = {d for d, _, c in by_hand(rows) if d == c}
    got = [r["doc_id"] for r in out.collect()]
    assert set(got) == want
    assert got.count(400) == 0 and got.count(503) == 1
    assert one_of_each_group(docs.limit(0)).count() == 0


def test_t_occurrence_counts_what_brute_force_counts():
    rng = np.random.default_rng(1)
    for _ in range(50):
        query = np.unique(rng.integers(0, 300, 60).astype(np.uint64))
        members = [np.unique(np.r_[rng.choice(query, rng.integers(1, len(query))), rng.integers(0, 300, 10).astype(np.uint64)]) for _ in range(12)]
        least = int(rng.integers(1, len(query)))
        want = [len(np.intersect1d(query, m)) for m in members]
        assert t_occurrence(query, members, least).tolist() == [n if n >= least else 0 for n in want]


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 700)).astype(np.uint64))
        b = np.unique(np.r_[rng.choice(a, max(1, len(a) * 8 // 10), replace=False), rng.integers(0, 2**63, 20).astype(np.uint64)])
        x, y = (np.frombuffer(parity(s), np.uint64) for s in (a, b))
        while len(x) != len(y):
            long_, short = (x, y) if len(x) > len(y) else (y, x)
            half = len(long_) // 2
            x, y = long_[:half] ^ long_[half:], short
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_null_ids_and_ids_with_two_texts_keep_their_links(spark, docs_of, lorem):
    base = [lorem(f"b{i}", 120) for i in range(6)]
    near = [b + " end" for b in base]
    # Alone in their partition, copies without an id; ids 2, 3 and 20 with two texts each.
    lone = [(None, base[0]), (None, base[1]), (None, base[1])]
    rest = [(1, base[0]), (10, near[0]), (11, near[1]), (2, base[2]), (2, base[3]), (12, near[2]), (13, near[3]),
            (3, base[4]), (3, lorem("other", 120)), (20, near[4]), (20, base[5]), (21, near[5]), (30, lorem("clean", 120))]
    parts = [docs_of(rows).coalesce(1).withColumnRenamed("doc_id", "doc") for rows in (lone, rest)]
    for first, second in (parts, parts[::-1]):
        docs = first.unionByName(second)
        got = jaccard_components(docs).select("doc", "n", "component").collect()
        assert sorted(map(tuple, got), key=str) == by_hand(lone + rest)


def test_a_node_has_one_text(spark, docs_of, lorem, monkeypatch):
    from ledgerline.llm import jaccard

    kept, write = {}, jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, tag: kept.setdefault(tag, []).append(write(df, tag)) or kept[tag][-1])
    monkeypatch.setattr(jaccard, "discard", lambda *tables: None)
    base = lorem("one", 120)
    rows = [(None, base)] * 5 + [(4, base)] * 3 + [(4, lorem("two", 120)), (5, base + " end")]
    jaccard_components(docs_of(rows).withColumnRenamed("doc_id", "doc").repartition(2)).collect()
    texts = [r["node"] for r in kept["jaccard_texts"][0].collect()]
    assert len(texts) == len(set(texts)) == 2


def test_only_neighbouring_size_ranges_can_link(spark):
    from pyspark.sql import functions as F

    from ledgerline.llm.jaccard import size_range

    ranges = [r["r"] for r in spark.range(1, 40_001).select(size_range(F.col("id")).alias("r")).collect()]
    for a in range(1, 32_001):
        assert 0 <= ranges[a * 5 // 4 - 1] - ranges[a - 1] <= 1


def test_short_lists_give_the_pairs_of_long_ones(lorem):
    import pyarrow as pa

    from ledgerline.llm.jaccard import HEADS, Lists, _short_pairs, shingle_sets

    sets = list(shingle_sets([edited(lorem("b", 20 + 10 * (i // 6)), i % 6 / 40, i) for i in range(60)]))
    bits = [parity(s) for s in sets]
    n = np.array([len(s) for s in sets])
    node = np.arange(100, 160)
    batch = pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(10), 6)), pa.array(node), pa.array(n), pa.array(bits, pa.binary()),
                                        *[pa.array(np.full(60, -1 - i)) for i in range(HEADS)]], names=["token", "node", "n", "bits", *[f"t{i}" for i in range(HEADS)]])
    got = {tuple(p) for x, y in _short_pairs(batch.slice(6), np.arange(0, 54, 6), np.full(9, 6), 80) for p in zip(x.tolist(), y.tolist())}
    want = set()
    for a in range(6, 60, 6):
        for x, y in Lists(n[a : a + 6], bits[a : a + 6], 80).pairs():
            want |= {tuple(sorted(p)) for p in zip((node[a + x]).tolist(), (node[a + y]).tolist())}
    assert got == want and want
