import random
import re
import zlib
from collections import Counter

from ledgerline.llm.spelling import DISTANCE, follow_forms, letter_runs, near_pairs, signatures, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def by_hand(docs, least=5):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    forms, rows = {}, []
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
        rows.append([w, forms[w], None, n, len(close), words[best] if forms[w] else None])
    for r in rows:
        r[2] = r[0]
        while forms[r[2]]:
            r[2] = forms[r[2]]
    return sorted(map(tuple, rows))


def variants(rng, n):
    """Documents whose words are misspelt now and then, with anagrams and letters with marks."""
    base = ["neighbour", "separate", "receive", "définir", "größer", "señores", "aabbcc", "abcabc", "cbacba", "ononon", "nonono"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(120):
            w = rng.choice(base)
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("eéx") + w[at:], w[:at] + rng.choice("aoß") + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i, ", ".join(words)))
    return docs


def test_equals_brute_force(spark, docs_of):
    docs = variants(random.Random(5), 60) + [(900, None), (901, ""), (None, "neighbour " * 30)]
    out = spelling_variants(docs_of(docs)).collect()
    want = by_hand(docs)
    assert sorted(map(tuple, out), key=lambda r: r[0]) == want and any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_near_words_share_a_signature():
    rng = random.Random(2)
    for _ in range(3000):
        w = "".join(rng.choice("aabeenostü") for _ in range(rng.randrange(6, 14)))
        at = rng.randrange(len(w))
        for x in (w[:at] + w[at + 1 :], w[:at] + rng.choice("aexz") + w[at:], w[:at] + rng.choice("anqß") + w[at + 1 :]):
            assert set(signatures(w)) & set(signatures(x)), (w, x)
    assert DISTANCE == 2 and not set(signatures("aaaaaa")) & set(signatures("zzzzzz"))


def test_pairs_come_once(spark):
    words = spark.createDataFrame([(w, i + 1) for i, w in enumerate(["abcdef", "abcdeg", "abcde", "abcdefg", "xabcdef", "éabcdef", "fabcde", "abcdfe"])], "word string, n long")
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in near_pairs(words).collect())
    names = [r["word"] for r in words.collect()]
    assert got == sorted(tuple(sorted((a, b))) for i, a in enumerate(names) for b in names[i + 1 :] if near(a, b))


def test_runs_of_letters():
    assert [r.decode("latin-1") for r in letter_runs("Ab×c÷ Дab ÀÿZ\x00x–y\xa0z")] == ["ab×c÷", "ab", "Àÿz", "x", "y", "z"]


def test_forms_lead_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4")]
    out = dict(map(tuple, follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert set(out.values()) == {"w9"} and len(out) == 10
    assert follow_forms(spark.createDataFrame([], "word string, form string")).collect() == []


def test_empty_table_and_other_columns(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(1, "thatword " * 6, "a", 2)], "doc_id long, text string, word string, n long")
    assert [tuple(r) for r in spelling_variants(docs, noise=0).collect()] == [("thatword", None, "thatword", 6, 0, None)]


def test_long_words_and_texts(spark):
    long_ = "abcdefgh" * 2000
    text = " ".join([long_] * 30 + [long_[:7000] + long_[7001:]] * 5 + ["plainly"] * 200_000)
    got = {r["word"]: r for r in spelling_variants(spark.createDataFrame([(7, text)], "doc_id long, text string"), noise=0).collect()}
    assert got["plainly"]["n"] == 200_000 and got[long_[:7000] + long_[7001:]]["form"] == long_
