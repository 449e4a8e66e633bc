"""Data tests merged load by load."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.operators import suite_state as S
from ledgerline.session import scratch_path
from ledgerline.sources.snapshots import SnapshotStore

TESTS = [Q.DataTest("raw", "raw.t", "a", "not_null"), Q.DataTest("raw", "raw.t", "id", "unique"), Q.DataTest("raw", "raw.t", "a", "accepted_values", ("x", "y")),
         Q.DataTest("staging", "stg_t", "id", "unique"), Q.DataTest("staging", "stg_t", "b", "not_null"), Q.DataTest("staging", "stg_t", "b", "accepted_values", ("x",)),
         Q.DataTest("raw", "raw.u", "id", "unique")]


def views():
    return {"stg_t": ("raw.t", F.col("a") != "gone", {"id": F.col("id"), "b": F.upper("a")})}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, a string")


def results(df):
    return sorted((r.model, r.column, r.test, r.failures, r.status) for r in df.collect())


def direct(tables):
    shown = {"stg_t": tables["raw.t"].where("a <> 'gone'").select("id", F.upper("a").alias("b"))}
    return results(Q.run_suite({**tables, **shown}, TESTS))


@pytest.mark.parametrize("bits", [1 << 28, 64])
def test_loads_merge_to_the_suite_over_all_rows(spark, bits):
    """With 64 bits nearly every key is a suspect; the results are the same."""
    rng = random.Random(bits)
    loads = [[(rng.choice([None, f"k{rng.randrange(400)}"]), rng.choice(["x", "y", "z", "gone", None, f"w{rng.randrange(5)}"])) for _ in range(n)] for n in (150, 1, 0, 90)]
    store, seen = SnapshotStore(spark, scratch_path(spark, "tests")), []
    for i, rows in enumerate(loads):
        tables = {"raw.t": frame(spark, rows)}
        if i != 1:
            tables["raw.u"] = frame(spark, rows)
        S.apply_tests(store, f"l{i}", tables, TESTS, views(), bits)
        seen += rows
        every = {"raw.t": frame(spark, seen), "raw.u": frame(spark, [r for j, x in enumerate(loads[: i + 1]) if j != 1 for r in x])}
        if i in (0, 3):
            assert results(S.suite_results(store, TESTS, views())) == direct(every)
    before = store.versions()
    S.apply_tests(store, "l0", {"raw.t": frame(spark, loads[0])}, TESTS, views(), bits)  # in already
    assert store.versions() == before


def test_nothing_loaded_passes(spark):
    store = SnapshotStore(spark, scratch_path(spark, "tests"))
    assert {r[3:] for r in results(S.suite_results(store, TESTS, views()))} == {(0, "pass")}


def test_a_second_load_reads_no_earlier_rows_and_looks_up_suspects_only(spark, monkeypatch):
    store = SnapshotStore(spark, scratch_path(spark, "tests"))
    first = frame(spark, [(f"k{i}", "x") for i in range(500)])
    S.apply_tests(store, "one", {"raw.t": first, "raw.u": first}, TESTS, views())
    looked_up, repeated = [], S._repeated

    def spy(tx, name, new, sums, bits):
        out = repeated(tx, name, new, sums, bits)
        looked_up.append((name, out.collect()))
        return out

    monkeypatch.setattr(S, "_repeated", spy)
    reads, frame_ = [], SnapshotStore.frame
    monkeypatch.setattr(SnapshotStore, "frame", lambda self, s, t, p=None: reads.append(t) or frame_(self, s, t, p))
    second = frame(spark, [(f"k{i}", "x") for i in range(498, 900)])
    S.apply_tests(store, "two", {"raw.t": second}, TESTS, views())
    assert sorted(r["key"] for r in dict(looked_up)["raw_t_id"]) == ["k498", "k499"]
    assert not any(t.startswith("raw") or t == S.VALUES for t in reads)  # state tables of keys only
    assert dict(((r.model, r.column, r.test), r.failures) for r in S.suite_results(store, TESTS, views()).collect())["raw.t", "id", "unique"] == 2


def test_keys_meet_without_a_broadcast(spark, monkeypatch):
    """Only the bitmaps, which are of a fixed size, go through the driver; a key of three loads keeps its largest count."""
    store, plans, repeated = SnapshotStore(spark, scratch_path(spark, "tests")), [], S._repeated

    def spy(*a):
        out = repeated(*a)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(S, "_repeated", spy)
    for load, ids in (("one", range(20)), ("two", range(15, 40)), ("three", [*range(15, 18), 50, 50])):
        S.apply_tests(store, load, {"raw.u": frame(spark, [(f"k{i}", "x") for i in ids])}, TESTS, views())
    joins = [line for line in plans[-1].splitlines() if "Join" in line]
    assert any("SortMergeJoin" in j and "LeftSemi" in j for j in joins)
    assert joins and all("bucket" in j for j in joins if "BroadcastHashJoin" in j)
    twice = store.frame(store.snapshot(), "dq_twice_raw_u_id").collect()
    assert sorted((r["key"], r[1]) for r in twice) == [("k15", 3), ("k16", 3), ("k17", 3), ("k18", 2), ("k19", 2), ("k50", 2)]
