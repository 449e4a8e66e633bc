"""Quality rules: text measures and a hashed n-gram likelihood ratio (native: DataFrame functions only)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, words

SYMBOLS = "[^#*$%&|<>]+"
#: Hash buckets of n-grams: the whole model is one array of this length, whatever the corpus.
BUCKETS = 10_000
#: Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.1


def _window_keys(w: Column, n: Column) -> tuple[Column, Column]:
    """Sorted keys of the 3-word windows, and the mask of a key's hash bits.

    Each window becomes one long: its hash in the high bits, its place in the low
    ones. After one primitive sort equal windows are neighbours; neighbours with
    equal high bits are compared word by word.
    """
    high = (F.when(n < 1 << 20, F.lit(-(1 << 20))).when(n < 1 << 24, F.lit(-(1 << 24))).otherwise(F.lit(-(1 << 31)))).cast("long")
    places = F.when(n >= 3, F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    keys = F.sort_array(F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long"))))
    return keys, high


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with __words (array) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    d = docs.withColumn("__words", words(F.col(text))).withColumn("__n", F.size("__words"))
    w, n, t = F.col("__words"), F.col("__n"), F.coalesce(F.col(text), F.lit(""))
    keys, high = _window_keys(w, n)
    d = d.withColumn("__high", high).withColumn("__keys", keys)
    k, high = F.col("__keys"), F.col("__high")
    pairs = F.filter(F.when(F.size(k) > 1, F.sequence(F.lit(0), F.greatest(F.size(k) - 2, F.lit(0)))).otherwise(F.array().cast("array<int>")),
                     lambda j: F.get(k, j).bitwiseXOR(F.get(k, j + 1)).bitwiseAND(high) == 0)
    d = d.withColumn("__pairs", pairs)

    def both(j: Column) -> Column:
        low = F.bitwise_not(high)
        a, b = F.get(k, j).bitwiseAND(low).cast("int"), F.get(k, j + 1).bitwiseAND(low).cast("int")
        same = (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (F.get(w, a + 2) == F.get(w, b + 2))
        return F.when(same, F.array(a, b)).otherwise(F.array().cast("array<int>"))

    d = d.withColumn("__at", F.when(F.size("__pairs") > 0, F.sort_array(F.array_distinct(F.flatten(F.transform("__pairs", both))))).otherwise(F.array().cast("array<int>")))
    at = F.col("__at")
    covered = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p)), F.lit(0), lambda x, y: x + y)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    d = d.withColumn("__lines", lines)
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], "__words",
                    n.cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    F.char_length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
                    (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
                    covered.cast("long").alias("n_repeat_words"))


def _bucket_at(w: Column, k: int, buckets: int, i: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), F.lit(buckets)).cast("int")


def ngram_buckets(w: Column, orders: tuple[int, ...] = (1, 2), buckets: int = BUCKETS) -> Column:
    """Hash buckets of all n-grams of a word array, in order."""
    parts = []
    for k in orders:
        last = F.size(w) - k
        if k == 1:
            parts.append(F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int")))
            continue
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(places, partial(_bucket_at, w, k, buckets)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def log_ratios(docs: DataFrame, trusted: DataFrame, orders: tuple[int, ...] = (1, 2), buckets: int = BUCKETS, smooth: float = 1.0) -> DataFrame:
    """One row with ``ratios``: log(p_trusted / p_raw) of every bucket.

    Both multinomials are counted over whole texts of all rows of ``docs``
    (doc_id, text); ``trusted`` has the doc_ids of the target documents. Partial
    counts shrink to ``buckets`` rows a task before anything is shuffled.
    """
    ids = trusted.select(F.col("doc_id").alias("__t")).where("__t is not null").distinct()
    # Merged, not broadcast: the trusted ids grow with the corpus.
    marked = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id") == F.col("__t"), "left")
    marked = marked.select(F.col("__t").isNotNull().alias("trusted"), words(F.col("text")).alias("w"))
    grams = marked.select("trusted", F.explode(ngram_buckets(F.col("w"), orders, buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count(F.when(F.col("trusted"), 1)).alias("target"))
    counts = materialise(counts, "ngram_counts")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    ratio = (F.log((F.col("target") + smooth) / (total["target"] + smooth * buckets))
             - F.log((F.col("raw") + smooth) / (total["raw"] + smooth * buckets)))
    rows = F.array_sort(F.collect_list(F.struct("bucket", ratio.alias("ratio"))))
    return materialise(every.agg(F.transform(rows, lambda r: r["ratio"]).alias("ratios")), "ngram_ratios")


def judge_quality(docs: DataFrame, trusted: DataFrame, orders: tuple[int, ...] = (1, 2), buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text, other columns) with text measures, base_failed, llr and kept.

    ``llr`` is the sum of the n-grams' log ratios (trusted-target against raw
    multinomial) divided by their number; a document is kept if it passes the
    base rules and ``llr >= threshold``. The same documents give the same verdict.

    Defined cases: null or blank text has no words, llr 0 and fails the base rules;
    null doc_id is never trusted; without trusted documents the smoothed target is
    even over all buckets; repeated rows get equal verdicts; columns of ``docs``
    named like results are replaced.
    """
    ratios = log_ratios(docs, trusted, orders, buckets)
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    d = text_measures(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own]))
    d = d.withColumn("__grams", ngram_buckets(F.col("__words"), orders, buckets)).withColumn("__ratios", ratios.select("ratios").scalar())
    total = F.aggregate("__grams", F.lit(0.0), lambda s, b: s + F.get(F.col("__ratios"), b))
    d = d.withColumn("llr", F.when(F.size("__grams") > 0, total / F.size("__grams")).otherwise(0.0))
    d = d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("__words", "__grams", "__ratios")
