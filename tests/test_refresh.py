"""Incremental marts and the snapshot store behind them."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.wire import MONTH
from ledgerline.operators import refresh as I
from ledgerline.operators.marts import build_marts
from ledgerline.operators.staging import staging
from ledgerline.plans.registry import _raw_written, _refreshed, _two_loads
from ledgerline.session import scratch_path
from ledgerline.sources.snapshots import CommitConflict, SnapshotStore, changed_parts
from tests.conftest import SF_SMALL

MARTS = ("mart_call_funnel", "mart_revenue", "mart_jobs")


def store_at(spark):
    return SnapshotStore(spark, scratch_path(spark, "store"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_as_full_build(store, raw, snapshot=None):
    full = build_marts(staging(raw))
    for name in MARTS:
        got = I.read_mart(store, name, snapshot)
        assert got.columns == full[name].columns
        assert [f.dataType for f in got.schema] == [f.dataType for f in full[name].schema]
        assert rows(got) == rows(full[name]), name


def test_two_loads_equal_a_full_build(spark):
    store, raw = _refreshed(spark, SF_SMALL), _raw_written(spark, SF_SMALL)
    same_as_full_build(store, raw)
    assert store.versions() == [1, 2]  # the load that came twice is in once
    with store.pinned(1) as first:
        same_as_full_build(store, _two_loads(spark, SF_SMALL)[0], first)


def test_a_load_writes_and_reads_the_months_it_touches(spark, monkeypatch):
    store = _refreshed(spark, SF_SMALL)
    one, two = store.snapshot(1), store.snapshot(2)
    touched = {I._folder(r[0]) for r in staging(_two_loads(spark, SF_SMALL)[1])["payments"].select(I.month_of(F.to_date("payment_timestamp"))).distinct().collect()}
    assert changed_parts(one, two)["mart_revenue"] == touched and 0 < len(touched) < len(two.parts["mart_revenue"])
    assert f"{MONTH}=1995-03" in touched and f"{MONTH}=1995-04" not in touched
    # The same load on the first version once more: the plan lists the touched folders only.
    reads, frame = [], SnapshotStore.frame
    monkeypatch.setattr(SnapshotStore, "frame", lambda self, s, t, p=None: reads.append((t, frame(self, s, t, p))) or reads[-1][1])
    again = SnapshotStore(spark, scratch_path(spark, "store"))
    first, second = _two_loads(spark, SF_SMALL)
    I.apply_load(again, "load-1", {"payments": first["payments"]})
    reads.clear()
    I.apply_load(again, "load-2", {"payments": second["payments"]})
    files = [f for t, df in reads if t == "mart_revenue" for f in df.inputFiles()]
    held = set(again.snapshot(1).parts["mart_revenue"])
    assert {f.split("/")[-2] for f in files} == touched & held and files


def test_sources_in_any_order_and_one_at_a_time(spark):
    raw = _raw_written(spark, SF_SMALL)
    first, second = _two_loads(spark, SF_SMALL)
    store = store_at(spark)
    for i, load in enumerate([{"jobs": second["jobs"]}, {"calls": first["calls"]}, {"payments": second["payments"], "jobs": first["jobs"]},
                              {"calls": second["calls"]}, {"payments": first["payments"]}, {"calls": raw["calls"].limit(0)}]):
        I.apply_load(store, f"l{i}", load)
    same_as_full_build(store, raw)


def test_blank_and_repeated_ids_meet_across_loads(spark):
    raw = _raw_written(spark, SF_SMALL)
    calls = raw["calls"].withColumn("call_id", F.when(F.col("call_id").cast("long") % 3 == 0, "").otherwise((F.col("call_id").cast("long") % 50).cast("string")))
    jobs = raw["jobs"].withColumn("related_call_id", F.when(F.col("related_call_id").cast("long") % 5 == 0, "").otherwise((F.col("related_call_id").cast("long") % 60).cast("string")))
    store = store_at(spark)
    I.apply_load(store, "a", {"calls": calls.where("timestamp < '2024-01-11'"), "jobs": jobs.where("status = 'completed'"), "payments": raw["payments"]})
    I.apply_load(store, "b", {"calls": calls.where("timestamp >= '2024-01-11'"), "jobs": jobs.where("status <> 'completed'")})
    same_as_full_build(store, {**raw, "calls": calls, "jobs": jobs})


def test_rebuild_stands_for_all_loads_before(spark):
    raw = _raw_written(spark, SF_SMALL)
    first, second = _two_loads(spark, SF_SMALL)
    store = store_at(spark)
    I.apply_load(store, "load-1", {"payments": second["payments"], "calls": second["calls"]})
    I.rebuild(store, first)
    same_as_full_build(store, first)
    I.apply_load(store, "load-2", second)
    same_as_full_build(store, raw)


def test_two_loads_at_a_time_and_a_long_reader(spark):
    raw = _raw_written(spark, SF_SMALL)
    first, second = _two_loads(spark, SF_SMALL)
    store = store_at(spark)
    I.apply_load(store, "start", {"payments": first["payments"]})
    errors = []

    def load(name, rows_):
        try:
            I.apply_load(SnapshotStore(spark, store.root), name, rows_)
        except BaseException as e:  # noqa: BLE001
            errors.append(e)

    with store.pinned() as held:
        reader = I.read_mart(store, "mart_revenue", held)
        threads = [threading.Thread(target=load, args=x) for x in (("calls", {"calls": raw["calls"]}), ("jobs", {"jobs": raw["jobs"]}), ("late", {"payments": second["payments"]}))]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert not errors and store.versions() == [1, 2, 3, 4]  # no version is lost
        removed = store.clean()
        assert held.version not in removed["versions"] and removed["versions"] == [2, 3]
        assert rows(reader) == rows(build_marts(staging(first))["mart_revenue"])
    same_as_full_build(store, raw)  # calls and jobs came apart, none missed the other
    removed = store.clean()
    assert removed["versions"] == [1] and removed["folders"] and store.versions() == [4]
    same_as_full_build(store, raw)
    assert store._names("_pins") == store._names("_writers") == store._names("_expired") == []


def test_commit_is_compare_and_set(spark):
    store = store_at(spark)
    df = spark.range(3)
    store.replace("t", df)
    assert not store._put(store._entry(1), "other") and store.snapshot(1).operation == "replace"
    tries = []

    def work(tx):  # another writer commits to the same table while this one works
        tries.append(tx.base.version)
        if len(tries) < 3:
            SnapshotStore(spark, store.root).replace("t", spark.range(10 * len(tries)))
        tx.replace("t", tx.read("t").selectExpr("id + 1 AS id"))

    done = store.update(work)
    assert tries == [1, 2, 3] and done.version == 4
    assert rows(store.frame(done, "t")) == [(i,) for i in sorted(range(1, 21), key=lambda i: str((i,)))]
    with pytest.raises(CommitConflict):
        store.update(lambda tx: (SnapshotStore(spark, store.root).replace("t", df), tx.replace("t", df)), attempts=2)
    # Writers of other tables are committed on top without a second try.
    tries.clear()
    done = store.update(lambda tx: (tries.append(1), SnapshotStore(spark, store.root).replace("t", df), tx.replace("u", df)))
    assert len(tries) == 1 and set(done.parts) == {"t", "u"}


def test_failed_writers_leave_no_trace(spark):
    store = store_at(spark)
    store.replace("t", spark.range(3))

    def work(tx):
        tx.replace("u", spark.range(5))
        tx.replace("t", spark.range(5).selectExpr("cast(concat('x', id) as int) as id"))

    with pytest.raises(Exception):
        store.update(work)
    assert store.versions() == [1] and set(store.snapshot().parts) == {"t"} and store._names("_writers") == []
    assert [f[0] for f in store._folders()] == ["t"]
    assert store.frame(store.snapshot(), "t").count() == 3


def test_clean_up_spares_writers_at_work_and_drops_lost_ones(spark):
    store = store_at(spark)
    store.replace("t", spark.range(3))

    def work(tx):
        tx.replace("t", spark.range(4))
        assert store.clean()["folders"] == []

    assert store.frame(store.update(work), "t").count() == 4
    store._put(f"{store.root}/_writers/dead")  # a driver that was lost after it staged a folder
    spark.range(9).write.parquet(f"{store.root}/data/t/_writer=dead")
    assert not any("dead" in f for f in store.clean()["folders"])
    assert any("dead" in f for f in store.clean(abandoned=["dead"])["folders"])
    assert store.frame(store.snapshot(), "t").count() == 4
    with pytest.raises(LookupError), store.pinned(1):
        pass


def test_a_pin_and_a_clean_up_cannot_both_win(spark):
    store = store_at(spark)
    for n in (1, 2):
        store.replace("t", spark.range(n))
    store._put(f"{store.root}/_expired/{1:012d}")  # clean-up has marked version 1
    with pytest.raises(LookupError), store.pinned(1):
        pass
    assert store._names("_pins") == []


def test_published_tables_follow_the_log(spark):
    raw = _raw_written(spark, SF_SMALL)
    store = _refreshed(spark, SF_SMALL)
    full = build_marts(staging(raw))
    for version in (1, 2, 1, 2):
        I.publish_snapshot(store, store.snapshot(version), "published")
    for name in MARTS:
        table = spark.table(f"published.{name}")
        assert rows(table.drop(MONTH)) == rows(full[name])
        assert any(f.metadata.get("comment") for f in table.schema)
    plan = spark.table("published.mart_revenue").where(f"{MONTH} = '1995-03'")
    assert {f.split("/")[-2] for f in plan.inputFiles()} == {f"{MONTH}=1995-03"}


def test_months_without_a_date_and_empty_loads(spark):
    store = store_at(spark)
    raw = _raw_written(spark, SF_SMALL)
    none = {k: v.limit(0) for k, v in raw.items()}
    I.apply_load(store, "none", none)
    assert all(I.read_mart(store, name).count() == 0 for name in MARTS)
    I.apply_load(store, "all", raw)
    same_as_full_build(store, raw)
    assert rows(I.read_mart(store, "mart_revenue", months=["1995-03"])) == rows(build_marts(staging(raw))["mart_revenue"].where("date_format(payment_date, 'yyyy-MM') = '1995-03'"))


def test_days_and_jobs_meet_without_a_broadcast(spark):
    """Both sides grow with the calls; small files of ids must not make one of them a broadcast."""
    days = spark.range(20).select(F.col("id").cast("string").alias("call_id"), F.lit("2024-01-01").cast("date").alias("call_date"), F.lit(1).cast("long").alias("calls"))
    one = F.lit(1).cast("long")
    jobs = spark.range(10).select(F.col("id").cast("string").alias("related_call_id"), one.alias("n_jobs"), one.alias("n_completed"), one.alias("n_cancelled"))
    met = I.jobs_of_days(days, jobs)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [(str(r.call_date), r.total_jobs) for r in met.collect()] == [("2024-01-01", 10)]
