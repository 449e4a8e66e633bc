"""Data tests whose results grow with each load (DQ-1..4): a load is tested once and merged.

Kept per load in a snapshot store: how many nulls and which values outside a list each
test saw, the keys of each unique column with their counts, and a bitmap of the keys'
hashes. Counts and values merge by addition. A key of a new load can only repeat
an earlier one if its bit is set already, and only an earlier key whose bit the new
load sets; only these meet, so earlier rows are never read again and other keys never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.quality import DataTest, Views, key_counts, key_tests, odd_values, suite_frame, tests_by_base, unique_base
from ledgerline.sources.snapshots import Snapshot, SnapshotStore, Transaction

LOADS, VALUES = "dq_loads", "dq_values"
#: Bits of a key bitmap; a key that repeats nothing is a suspect with the share of bits that are set.
BITS = 1 << 28


def _placed(keys: DataFrame, bits: int) -> DataFrame:
    place = F.pmod(F.xxhash64("key"), F.lit(bits))
    return keys.withColumn("bucket", F.bitmap_bucket_number(place)).withColumn("bit", F.bitmap_bit_position(place))


def _flagged(keys: DataFrame, seen: DataFrame, bits: int) -> DataFrame:
    """``keys`` with ``met``: whether a key's bit is set in the bitmaps ``seen``. All bitmaps together hold
    ``bits`` bits, whatever the number of keys, so they are what is broadcast."""
    whole = seen.groupBy(F.col("bucket").alias("b")).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.expr("cast(bit % 8 as int)")).bitwiseAND(1) == 1
    found = _placed(keys, bits).join(F.broadcast(whole), F.col("bucket") == F.col("b"), "left")
    return found.select(*keys.columns, F.coalesce(is_set, F.lit(False)).alias("met"))


def _repeated(tx: Transaction, name: str, new: DataFrame, sums: list[str], bits: int) -> DataFrame:
    """(key, sums) over all loads, of the keys of the new load that stand more than once in them.

    A load has a row per key, so a key that stands once in it and meets no set bit is done. The others are
    met by the earlier keys that have a bit in common with the new ones; neither side is sent to the driver."""
    many = F.greatest(*[F.col(c) for c in sums]) > 1 if len(sums) > 1 else F.col(sums[0]) > 1
    if not tx.has(f"dq_seen_{name}"):
        return new.where(many)
    suspects = _flagged(new, tx.read(f"dq_seen_{name}"), bits).where(F.col("met") | many).drop("met")
    earlier = _flagged(tx.read(f"dq_keys_{name}"), tx.staged(f"dq_seen_{name}"), bits).where("met").select(*new.columns)
    again = earlier.join(suspects.select(F.col("key").alias("k")).hint("merge"), F.col("key") == F.col("k"), "left_semi")
    return suspects.unionByName(again).groupBy("key").agg(*[F.sum(c).alias(c) for c in sums]).where(many)


def apply_tests(store: SnapshotStore, load: str, tables: Mapping[str, DataFrame], tests: list[DataTest], views: Views, bits: int = BITS) -> Snapshot:
    """Test one load (its new rows per base table; a table may be missing) and merge it into the state.

    A load that is in already changes nothing. ``bits`` must stay the same for a store.
    """

    def work(tx: Transaction) -> None:
        if tx.knows(LOADS, load):
            return
        values = []
        for base, own in tests_by_base(tests, views).items():
            if base in tables and any(t.test != "unique" for _, t in own):
                values.append(odd_values(tables[base], own, views))
        for name, own in key_tests(tests, views).items():
            base = unique_base(own, views)
            if base not in tables:
                continue
            sums = [f"n{i}" for i, _ in own]
            tx.append(f"dq_keys_{name}", key_counts(tables[base], own, views), load)
            new = tx.staged(f"dq_keys_{name}")
            tx.append(f"dq_seen_{name}", _placed(new, bits).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")), load)
            found = _repeated(tx, name, new, sums, bits)
            if tx.has(f"dq_twice_{name}"):  # counts only grow, so the larger ones are the later ones
                found = found.unionByName(tx.read(f"dq_twice_{name}")).groupBy("key").agg(*[F.max(c).alias(c) for c in sums])
            tx.replace(f"dq_twice_{name}", found)
        if values:
            tx.append(VALUES, reduce(DataFrame.unionByName, values), load)
        tx.append(LOADS, store.spark.range(1).select(F.lit(load).alias("load")), load)

    return store.update(work, f"tests {load}")


def suite_results(store: SnapshotStore, tests: list[DataTest], views: Views, snapshot: Snapshot | None = None) -> DataFrame:
    """DQ-4 rows (layer, model, column, test, failures, status) of all loads so far, from the state alone."""
    snapshot = snapshot or store.snapshot()
    values = store.frame(snapshot, VALUES).groupBy("tid", "value").agg(F.sum("n").alias("n")) if VALUES in snapshot.parts else None
    keys = {name: store.frame(snapshot, f"dq_twice_{name}") for name in key_tests(tests, views) if f"dq_twice_{name}" in snapshot.parts}
    return suite_frame(store.spark, tests, views, [] if values is None else [values], keys)
