"""Weighted fair queueing of sources (native: DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, with_broadcast_if, words

#: Rows of a shuffle bucket aimed at; a bucket is what one window orders.
BUCKET_ROWS = 2000
#: A source table up to this many rows is broadcast; beyond it AQE splits skewed joins.
MAX_BROADCAST_SOURCES = 20_000


def source_targets(sources: DataFrame, weights: Sequence[float], budget_share: float, cap: float) -> DataFrame:
    """Target words of each source: ``least(cap * size, level * weight)`` summing to the budget.

    ``sources`` has (source, source_size). Sources take the weights in code point
    order, null last, the list repeating. The level is found in one ordered pass:
    sources fill up in order of ``cap * size / weight``, and the first source that
    the level left by its predecessors does not fill up fixes the level.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = sources.select("source", "source_size").withColumn("weight", weight)
    s = s.withColumn("most", cap * F.col("source_size")).withColumn("fills_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * budget_share - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("weight").over(from_here))
    s = s.withColumn("level", level)
    s = s.withColumn("level", F.first(F.when(F.col("level") <= F.col("fills_at"), F.col("level")), ignorenulls=True).over(everything))
    return s.select("source", "source_size",
                    F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def weighted_fair_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), budget_share: float = 1.0,
                      cap: int = 3, seed: int = 17, keep: Sequence[str] | None = None) -> DataFrame:
    """Mix sources to target weights by virtual finish times.

    Every document of ``docs`` (doc_id, text, source and any other columns) is
    queued up to ``cap`` times in its source, each pass in a newly shuffled
    order. An entry's virtual finish time is the source's words up to and
    including it, divided by the source's target. All entries are ordered by
    finish time and taken until ``budget_share`` of all words is spent.

    Returns the columns ``keep`` (default: all of ``docs``) with ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken`` (= size * copies), one
    row per input row. Columns of these names in ``docs`` are replaced.

    Defined cases: null or blank text has size 0, no copies and no words taken;
    null source is a source of its own, last in order; repeated rows are
    separate entries; ties in the shuffle go by doc_id, size and text hash, so a
    rerun takes the same; an empty table gives an empty result.

    The running sums need no single task: entries fall into hash ranges of about
    ``BUCKET_ROWS`` rows, ranges are summed (map-side first), only the sums are
    accumulated per source, and each range adds its own rows. So a source with
    most rows is spread like all others. The cut is found in the same way.
    """
    own = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in own]
    base = materialise(
        docs.select(*[F.col(f"`{c}`") for c in keep], F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                    F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("__text"),
                    F.monotonically_increasing_id().alias("__row")), "mix_base")
    entries = base.select("__id", "__source", "size", "__text", "__row").where("size > 0")
    sums = base.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sums, weights, budget_share, cap), "mix_targets")
    total = entries.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    budget = total["words"] * budget_share
    bits = min(40, max(4, math.ceil(math.log2(max(1, total["n"]) / BUCKET_ROWS + 1))))

    passes = F.sequence(F.lit(0), F.least(F.lit(cap - 1), F.floor(F.col("target") / F.col("source_size")).cast("int")))
    sized = with_broadcast_if(targets, MAX_BROADCAST_SOURCES).withColumnRenamed("source", "__s")
    queued = (entries.join(sized, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
              .withColumn("__pass", F.explode(passes))
              .withColumn("__key", F.xxhash64("__id", F.lit(seed), "__pass"))
              .withColumn("__bucket", F.shiftrightunsigned("__key", 64 - bits)))
    by = ["__source", "__pass", "__bucket"]
    ranges = queued.groupBy(*by).agg(F.sum("size").alias("__words"))
    ranges = ranges.select(*by, F.coalesce(F.sum("__words").over(
        Window.partitionBy("__source", "__pass").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranges = ranges.select(*[F.col(c).alias(f"r{c}") for c in by], "__before")
    within = Window.partitionBy(*by).orderBy("__key", "__id", "size", "__text", "__row").rowsBetween(Window.unboundedPreceding, 0)
    timed = (queued.withColumn("__sum", F.sum("size").over(within))
             .join(ranges, F.col("__source").eqNullSafe(F.col("r__source")) & (F.col("__pass") == F.col("r__pass"))
                   & (F.col("__bucket") == F.col("r__bucket")))
             .select("__row", "size", "__pass", "__source", "__key",
                     ((F.col("__pass") * F.col("source_size") + F.col("__before") + F.col("__sum")) / F.col("target")).alias("__finish")))
    timed = materialise(timed.withColumn("__slot", F.floor(F.col("__finish") * (1 << bits))), "mix_timed")

    # The last entry within the budget: whole slots of finish time first, then the rows of one slot.
    slots = timed.groupBy("__slot").agg(F.sum("size").alias("__words"))
    slots = slots.withColumn("__upto", F.sum("__words").over(Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)))
    cut = slots.where(F.col("__upto") > budget).orderBy("__slot").limit(1).first()
    if cut is None:
        taken = timed
    else:
        left = budget - (cut["__upto"] - cut["__words"])
        order = Window.orderBy("__finish", F.col("__source").asc_nulls_last(), "__key", "__row").rowsBetween(Window.unboundedPreceding, 0)
        last = timed.where(F.col("__slot") == cut["__slot"]).withColumn("__sum", F.sum("size").over(order))
        taken = timed.where(F.col("__slot") < cut["__slot"]).unionByName(last.where(F.col("__sum") <= left).drop("__sum"))
    copies = taken.groupBy(F.col("__row").alias("__r")).agg(F.count("*").alias("copies"))
    sized = sized.withColumnRenamed("__s", "__s2")
    return (base.join(copies, F.col("__row") == F.col("__r"), "left")
            .join(sized, F.col("__source").eqNullSafe(F.col("__s2")), "left")
            .select(*[F.col(f"`{c}`") for c in keep], "size", "source_size", "target",
                    F.coalesce(F.col("copies"), F.lit(0)).cast("long").alias("copies"),
                    (F.col("size") * F.coalesce(F.col("copies"), F.lit(0))).cast("long").alias("taken")))


def taken_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each document's row as often as the mix takes it, with the columns of ``docs``."""
    mixed = weighted_fair_mix(docs.select(*[F.col(f"`{c}`").alias(f"d_{c}") for c in docs.columns], "doc_id", "text", "source"),
                              keep=[f"d_{c}" for c in docs.columns], **options)
    return (mixed.where("copies > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"`d_{c}`").alias(c) for c in docs.columns]))
