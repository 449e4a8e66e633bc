"""Approximate nearest neighbours by a permutation index in pivot inverted files."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shipped
from .jaccard import _runs

#: Pivots at most (one to PER_PIVOT vectors), and vectors of the sample they are chosen from.
PIVOTS = 128
PER_PIVOT = 16
SAMPLE = 4096
#: Files a vector is posted in, and files a query reads: those of its nearest pivots.
POSTED = 4
PROBED = 32
#: Share of a file's entries, by smallest footrule distance, that is ranked by exact score; and entries at least.
RERANKED = 0.25
LEAST_RERANKED = 100
#: Entries and queries of a file handled in one group.
BLOCK = 2048


@dataclass
class Pivots:
    """Pivot directions, and the norm that lifts vectors so that the largest inner product is nearest."""

    points: np.ndarray
    norm: float

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Vectors of equal length with a further component; queries only keep their direction."""
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.norm**2 - (v * v).sum(axis=1), 0))
        return np.c_[v, rest]

    def order(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Numbers of the pivots, nearest first."""
        return np.argsort(-(self.lifted(v, query) @ self.points.T), axis=1, kind="stable")


def choose_pivots(sample: np.ndarray, count: int, norm: float) -> Pivots:
    """``count`` pivots spread over the sample: each is the vector farthest from those before it."""
    lifted = Pivots(np.empty(0), norm).lifted(sample, query=False)
    lifted /= np.linalg.norm(lifted, axis=1, keepdims=True)
    picked = [0]
    near = lifted @ lifted[0]
    while len(picked) < min(count, len(lifted)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, lifted @ lifted[picked[-1]])
    return Pivots(lifted[picked], norm)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(id, v array<double>): one row per vec_id, of the commonest length, finite and not zero."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).groupBy("id").agg(F.min("v").alias("v"))
    rows = materialise(rows, "ann_vectors")
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("v") == (size["size"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _post(rows: DataFrame, pivots, files: int, query: bool) -> DataFrame:
    """Each vector (id, v) once for each of the ``files`` nearest pivots (file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pivots()
        for batch in batches:
            if not batch.num_rows:
                continue
            order = own.order(_matrix(batch.column("v")), query)[:, :files]
            take = pa.array(np.repeat(np.arange(len(order)), order.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(order.ravel().astype(np.int32)), batch.column("id").take(take), batch.column("v").take(take)], names=["file", "id", "v"])

    return rows.select("id", "v").mapInArrow(run, "file int, id long, v array<double>")


def _search(entries: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, file: int, pivots: Pivots, k: int, posted: int, share: float):
    """Best ``k`` of one block of a pivot's file for each query: (query, id, score).

    An entry is judged in the first file of the query's order that holds it, so
    once for each query. By footrule distance of the pivot orders (sum of the
    differences of places) the nearest share, ties included, is scored exactly.
    """
    order = pivots.order(entries, query=False)
    place = np.argsort(order, axis=1).astype(np.int16)
    ahead = np.argsort(pivots.order(queries, query=True), axis=1).astype(np.int16)
    for q, where in enumerate(ahead):
        mine = np.flatnonzero((where[order[:, :posted]].min(axis=1) == where[file]) & (ids != own[q]))
        if not len(mine):
            continue
        footrule = np.abs(place[mine] - where).sum(axis=1)
        keep = max(k, LEAST_RERANKED, math.ceil(share * len(mine)))
        if keep < len(mine):
            mine = mine[footrule <= np.partition(footrule, keep - 1)[keep - 1]]
        score = (entries[mine] * queries[q]).sum(axis=1)
        if len(mine) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            mine, score = mine[score >= cut], score[score >= cut]
        best = np.lexsort((ids[mine], -score))[:k]
        yield np.full(len(best), own[q]), ids[mine[best]], score[best]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS, posted: int = POSTED, probed: int = PROBED, share: float = RERANKED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` (vec_id) the ``k`` vectors of ``vectors``
    (vec_id, embedding) found with the largest inner product, ties to the smaller vec_id.

    Pivots come from a sample of SAMPLE vectors by hash. Every vector is posted in
    the files of its nearest pivots; a query reads those of its own nearest pivots,
    ranks their entries by footrule distance between the complete pivot orders
    and scores the nearest ``share`` exactly. Files are dealt out in blocks of
    entries and of queries, so vectors that crowd around one pivot are spread.

    Defined cases: vectors that are null, zero, of an uncommon length or with null
    or non-finite components take no part; rows with the same vec_id are one
    vector (the smallest); a null vec_id takes no part; queries without other vectors
    give no rows; up to PROBED * PER_PIVOT vectors all files are read, so that every candidate counts.
    """
    spark = vectors.sparkSession
    rows = valid_vectors(vectors)
    total = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total["n"]:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    count = max(1, min(pivots, total["n"] // PER_PIVOT))
    chosen = choose_pivots(np.array([r["v"] for r in sample]), count, math.sqrt(total["norm"]))
    shared = shipped(spark, chosen)

    entries = materialise(_post(rows, shared, posted, query=False), "ann_entries")
    asked = rows.join(queries.select(F.col("vec_id").cast("long").alias("q")).distinct(), F.col("id") == F.col("q"), "left_semi")
    asked = materialise(_post(asked, shared, probed, query=True), "ann_queries")
    # Blocks of each file, for entries and queries: at most as many rows as pivots, so they may come to the driver.
    blocks = [{r["file"]: -(-r["n"] // BLOCK) for r in df.groupBy("file").agg(F.count("*").alias("n")).collect()} for df in (entries, asked)]

    def of_file(side: int):
        return F.get(F.array(*[F.lit(blocks[side].get(f, 1)) for f in range(len(chosen.points))]), F.col("file"))

    def dealt(df: DataFrame, side: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), of_file(side)).cast("int")
        other = F.explode(F.sequence(F.lit(0), of_file(1 - side) - 1))
        df = df.withColumn("own", own).withColumn("other", other)
        return df.select("file", F.col("own" if not side else "other").alias("block"), F.col("other" if not side else "own").alias("part"), F.lit(bool(side)).alias("query"), "id", "v")

    grouped = dealt(entries, 0).unionByName(dealt(asked, 1)).repartition("file", "block", "part").sortWithinPartitions("file", "block", "part", "query", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in _runs(batches, ["file", "block", "part"]):
            file, block, part, ids = (batch.column(c).to_numpy() for c in ("file", "block", "part", "id"))
            query, v = batch.column("query").to_numpy(zero_copy_only=False), _matrix(batch.column("v"))
            start = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (block[1:] != block[:-1]) | (part[1:] != part[:-1])])
            for a, b in zip(start, np.r_[start[1:], len(ids)], strict=True):
                m = a + int((~query[a:b]).sum())
                if a < m < b and (found := list(_search(v[a:m], ids[a:m], v[m:b], ids[m:b], int(file[a]), own, k, posted, share))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    found = grouped.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
