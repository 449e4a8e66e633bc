"""Importance resampling towards a target text collection, by bucket histograms of word windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, shipped
from .pieces import _by_size

#: Characters of a word once A-Z are lower-cased: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Characters pre-tokenised at once; a longer text is cut between words.
SLICE_CHARS = 1_000_000
#: Features of which a worker remembers the bucket.
REMEMBERED = 500_000
_GAP = "\t\n\x0b\x0c\r !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\x00\x7f"


class WindowBuckets:
    """Buckets of all windows of 1 to ``longest`` successive words of a text."""

    def __init__(self, longest: int = 1, buckets: int = BUCKETS):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.longest, self.buckets, self.known = longest, buckets, {}

    def offsets(self, text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Lower-cased slices of the text, each with the offset pairs of its words."""
        text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "replace")
        at = 0
        while at < len(text):
            end = at + SLICE_CHARS
            while end < len(text) and text[end] not in _GAP:
                end += 1
            part = text[at:end]
            yield part, [pair for _, pair in self.split.pre_tokenize_str(part)]
            at = end

    def _bucket(self, feature: str) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        return found

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every window, repeats included."""
        n, out = 0, []
        if self.longest == 1:
            for part, pairs in self.offsets(text or ""):
                out += [self._bucket(part[a:b]) for a, b in pairs]
            return len(out), np.array(out, np.int32)
        last: list[str] = []  # words before the slice that windows reach back to
        for part, pairs in self.offsets(text or ""):
            words = last + [part[a:b] for a, b in pairs]
            for i in range(len(last), len(words)):
                out += [self._bucket(" ".join(words[i - k : i + 1])) for k in range(min(self.longest, i + 1))]
            n += len(pairs)
            last = words[max(0, len(words) - self.longest + 1) :]
        return n, np.array(out, np.int32)


def window_features(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``__words`` (number of words) and ``__features`` (buckets, 4 bytes each) in place of ``text``."""
    schema = T.StructType([f for f in docs.schema if f.name != "text"]).add("__words", T.LongType()).add("__features", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        made, arrow = WindowBuckets(longest, buckets), to_arrow_schema(schema)
        for whole in batches:
            for batch in _by_size(whole, "text"):
                found = [made.of(text) for text in batch.column("text").to_pylist()]
                new = {"__words": pa.array([n for n, _ in found], pa.int64()), "__features": pa.array([x.tobytes() for _, x in found], pa.binary())}
                yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of ``features``; every task sends its own histogram once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column("__features"):
                total += np.bincount(np.frombuffer(x.as_buffer(), np.int32), minlength=buckets) if x.is_valid else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return features.select("__features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: floor of 1000 times the log ratio of the smoothed shares in
    ``target`` and ``corpus``, both (bucket, n). A row for each bucket, whatever the input."""
    both = (corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .unionByName(corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))))
    sums = materialise(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "gain_sums")
    total = sums.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * (F.lit(float(total["S"])) + buckets)) / ((s + 1) * (F.lit(float(total["T"])) + buckets))
    return sums.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 g) of a Gumbel variable g that seed and doc_id fix (null: as an empty id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(df: DataFrame, order: Sequence[Column], tag: str = "ranked") -> DataFrame:
    """``df`` with ``rank``, 1 for the first row by ``order``, which must tell all rows apart.

    Rows are dealt to ranges, each range is sorted and numbered by its own task, and
    the sizes of the ranges (one row each) give what stands before them. So no task
    sees more than a range, and ties in the leading columns do not end up together.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema, T.StructField("__range", T.IntegerType()), T.StructField("__place", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            place = pa.array(np.arange(at + 1, at + batch.num_rows + 1))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[f.name for f in schema])

    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id())
    placed = materialise(dealt.mapInArrow(number, schema), tag)
    sizes = placed.groupBy("__range").agg(F.max("__place").alias("__rows")).collect()  # a row for each range
    before, total = {}, 0
    for row in sorted(sizes):
        before[row["__range"]] = total
        total += row["__rows"]
    starts = spark.createDataFrame(list(before.items()) or [(0, 0)], "__r int, __before long")
    return (placed.join(F.broadcast(starts), F.col("__range") == F.col("__r"))
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + F.col("__place")).alias("rank")))


def importance_resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
                        least_words: int = LEAST_WORDS, seed: str = SEED, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, other columns; of them ``keep``, default all) with n_features, weight, score and rank.

    An untrained split over the text (A-Z lower-cased) gives words with offsets; all
    windows of 1 to ``longest`` words are counted in ``buckets`` by CRC. A bucket's
    gain compares its smoothed shares in the texts of ``target`` and of ``docs``;
    ``weight`` sums the gains of a document's windows, and ``score`` adds noise that
    seed and doc_id fix, so that the highest scores are a draw without replacement
    by importance. Of the documents with ``least_words`` words, the highest
    floor(``percent`` * N / 100) are ranked 1, 2, 3...; others have a null rank.

    Each text is split once: the buckets of its windows are written, counted by task
    and summed against the gains, a table as long as there are buckets.

    Defined cases: null and empty texts have no features, weight 0 and never a rank;
    a null doc_id draws as an empty id and loses ties; equal scores go to the smaller
    doc_id, and rows that are equal in both to any of them; very long texts are split
    in slices; an empty target or an empty table of documents is counted as 0; columns
    of ``docs`` named like results are replaced.
    """
    own = ["n_features", "weight", "score", "rank"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k_{c}") for c in keep], F.col("doc_id").alias("__id"), F.col("text"))
    features = materialise(window_features(rows, longest, buckets), "resample_features")
    aim = window_features(target.select("text"), longest, buckets)
    gains = np.zeros(buckets, np.int64)
    for row in bucket_gains(bucket_counts(features, buckets), bucket_counts(aim, buckets), buckets).collect():  # a row for each bucket
        gains[row["bucket"]] = row["gain"]
    shared = shipped(docs.sparkSession, gains)
    schema = T.StructType([f for f in features.schema if f.name != "__features"]).add("n_features", T.LongType()).add("weight", T.LongType())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared()
        for batch in batches:
            at = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("__features")]
            new = {"n_features": pa.array([len(x) for x in at], pa.int64()), "weight": pa.array([int(gain[x].sum()) for x in at], pa.int64())}
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], names=[f.name for f in schema])

    scored = features.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + gumbel(F.col("__id"), seed))
    scored = materialise(scored.withColumn("__row", F.monotonically_increasing_id()), "resample_scores")
    fit = scored.where(F.col("__words") >= least_words)
    drawn = fit.count() * percent // 100
    order = ranked(fit.select("score", "__id", "__row"), [F.col("score").desc(), F.col("__id").asc_nulls_last(), F.col("__row")], "resample_ranked")
    order = order.where(F.col("rank") <= drawn).select(F.col("__row").alias("__r"), "rank")
    return (scored.join(order, F.col("__row") == F.col("__r"), "left")
            .select(*[F.col(f"`k_{c}`").alias(c) for c in keep], "n_features", "weight", "score", "rank"))
