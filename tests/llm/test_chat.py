import hashlib

from pyspark.sql import functions as F

from ledgerline.llm.chat import escape, format_reply_trees, linear_replies, read_loss, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_start|>user<|im_sep|>x<|im_end|>\n", "\\", "\\\\<", "<\\", "[\\[", "<<SYS>>", "a $1 \\1", "", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r["u"] == r["t"] for r in rows)
    assert not any(c in r["e"] for r in rows for c in ("</s>", "[INST]", "[/INST]", "<|im_", "<<SYS>>"))


def test_conversations_read_back(spark):
    rows = [(1, 0, "system", None), (1, 2, "assistant", "<b>"), (1, 1, "user", "hi\n[x]"), (2, 0, "user", ""), (3, None, None, "é😀"), (3, 5, "assistant", "</s>"),
            (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "same"), (None, 1, "assistant", "z"), (None, 0, "user", "y")]
    rows += [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(70)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit("clash")).withColumn("node", F.lit(0))
    out = format_reply_trees(linear_replies(df)).select("conv_id", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in out} == want
    assert {r["conv_id"]: r["loss"] for r in out} == {c: "".join(x for r, x in v if r == "assistant") for c, v in want.items()}


def branches_by_hand(rows, k):
    """rows: (tree, id, parent, score); the k best root-to-leaf paths of each tree."""
    out = set()
    for tree in {r[0] for r in rows}:
        own = {r[1]: (r[2], r[3]) for r in rows if r[0] == tree}
        inner = {p for p, _ in own.values()}
        paths = []
        for leaf in own.keys() - inner:
            path, at = [], leaf
            while at in own:
                path.append(at)
                at = own[at][0]
            paths.append((-sum(own[n][1] for n in path), leaf, tuple(reversed(path))))
        out |= {(tree, p) for _, _, p in sorted(paths)[:k]}
    return out


def test_branches_against_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = []
    for tree in range(12):
        n = rng.randrange(1, 40)
        ids = rng.sample(range(1000), n)
        for i, m in enumerate(ids):
            parent = None if i == 0 or rng.random() < 0.05 else ids[i - 1 if rng.random() < 0.6 else rng.randrange(i)]
            rows.append((tree, m, parent, float(rng.randrange(-2, 5))))
    df = spark.createDataFrame([(t, m, p, "user", f"{m}", s) for t, m, p, s in rows], "conv_id long, message_id long, parent_id long, role string, text string, score double")
    for k in (1, 3, None):
        out = format_reply_trees(df, branches=k).select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()
        got = [(r["conv_id"], tuple(int(t["text"]) for t in r["turns"])) for r in out]
        assert len(got) == len(set(got))
        assert set(got) == branches_by_hand(rows, k or 10**6)


def test_cycles_and_repeated_ids_are_left_out(spark):
    """Trees: 1 only a cycle; 2 a cycle beside a good tree and an answer below it; 3 a message that answers itself;
    4 an id twice; 5 a missing id; 6 a long run, so that the doublings do go on."""
    rows = [(1, 1, 2), (1, 2, 1), (2, 1, 3), (2, 2, 1), (2, 3, 2), (2, 4, 2), (2, 10, None), (2, 11, 10), (2, 12, 11), (3, 1, 1), (3, 2, None),
            (4, 1, None), (4, 2, 1), (4, 2, 1), (4, 3, 2), (4, 5, 3), (5, None, None), (5, 1, None), (5, 2, 1)]
    rows += [(6, i, i - 1 if i else None) for i in range(100)]
    df = spark.createDataFrame([(t, m, p, "user", str(m)) for t, m, p in rows], "conv_id long, message_id long, parent_id long, role string, text string")
    out = format_reply_trees(df, branches=None).select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()
    got = sorted((r["conv_id"], [t["text"] for t in r["turns"]]) for r in out)
    assert got == [(2, ["10", "11", "12"]), (3, ["2"]), (4, ["1"]), (4, ["3", "5"]), (5, ["1", "2"]), (6, [str(i) for i in range(100)])]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert format_reply_trees(linear_replies(empty)).count() == 0


def test_registered_query_against_hand(spark):
    from ledgerline.llm.registry import op6_chat_format
    from tests.conftest import SF_SMALL

    said = {}
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    said[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in op6_chat_format(spark, SF_SMALL).collect()}
    assert got.keys() == said.keys()
    for c, turns in said.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
