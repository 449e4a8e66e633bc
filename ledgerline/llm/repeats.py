"""Substring deduplication over indexed blocks: windows keyed by their smallest gram, in place of a greedy relative Lempel-Ziv parse."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

WINDOW = 50
#: Words of the grams whose smallest hash names a window.
GRAM = 12
#: Words handled in one set of arrays (a longer document is one set).
SLICE_WORDS = 500_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Rolling:
    """Hashes of word sequences: any stretch of the words at constant cost."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        self.n = n
        h = _mix(np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, n))
        up, down = np.full(n + 1, _BASE, _U), np.full(n + 1, _INVERSE, _U)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(h * np.multiply.accumulate(up)[:n], out=self.sums[1:])

    def stretch(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of the words from each start on, the same for the same words anywhere."""
        return _mix((self.sums[start + length] - self.sums[start]) * self.down[start] + _mix(np.asarray(length).astype(_U)))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` successive values."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.iinfo(_U).max, _U)
    blocks[:n] = x
    blocks = blocks.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def _gather(texts: list[str | None]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Sets of documents: number of the first one, all their words, and where each one ends."""
    first, words, ends = 0, [], []
    for i, text in enumerate(texts):
        words += (text or "").encode("utf-8", "surrogatepass").split()
        ends.append(len(words))
        if len(words) >= SLICE_WORDS or i + 1 == len(texts):
            yield first, words, np.array(ends, np.int64)
            first, words, ends = i + 1, [], []


def _blocks(texts: list[str | None], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, anchor, block, at, n): successive windows with the same smallest gram hash (the
    anchor) form a block of n windows from word ``at`` on; ``block`` is the hash of all its words."""
    gram = min(GRAM, window)
    for first, words, ends in _gather(texts):
        if len(words) < window:
            continue
        rolling = Rolling(words)
        grams = rolling.stretch(np.arange(len(words) - gram + 1), gram)
        anchor = _sliding_min(grams, window - gram + 1)
        starts = np.r_[0, ends[:-1]]
        doc = np.repeat(np.arange(len(ends)), ends - starts)[: len(anchor)]
        whole = np.arange(len(anchor)) + window <= ends[doc]
        new = whole & np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
        at = np.flatnonzero(new)
        if not len(at):
            continue
        n = np.add.reduceat(whole.astype(np.int64), at)
        yield first + doc[at], anchor[at], rolling.stretch(at, n + window - 1), at - starts[doc[at]], n


def index_blocks(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The reference index: one row per block of every document (doc, text_hash, text)."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("block", T.LongType()), T.StructField("doc", T.LongType()),
                           T.StructField("text_hash", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc").to_numpy(), batch.column("text_hash").to_numpy()
            for row, anchor, block, at, n in _blocks(batch.column("text").to_pylist(), window):
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)), pa.array(ids[row]), pa.array(hashes[row]),
                    pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=[f.name for f in schema])

    return docs.select("doc", "text_hash", "text").mapInArrow(run, schema)


def _edge_windows(docs: DataFrame, window: int) -> DataFrame:
    """Single windows (anchor, hash, doc, text_hash, at) of the listed blocks ``open`` of each document."""
    schema = "anchor long, hash long, doc long, text_hash long, at int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, blocks in zip(*(batch.column(c).to_pylist() for c in ("doc", "text_hash", "text", "open")), strict=True):
                n = np.array([b["n"] for b in blocks], np.int64)
                at = np.repeat(np.array([b["at"] for b in blocks], np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes = Rolling(text.encode("utf-8", "surrogatepass").split()).stretch(at, window)
                anchor = np.repeat(np.array([b["anchor"] for b in blocks], np.int64), n)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(hashes.view(np.int64)), pa.array(np.full(len(at), doc)),
                                                  pa.array(np.full(len(at), key)), pa.array(at.astype(np.int32))],
                                                 names=["anchor", "hash", "doc", "text_hash", "at"])

    return docs.mapInArrow(run, schema)


def duplicate_factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, text_hash, start, stop): word spans of ``docs`` (doc, text_hash, text) in which every
    ``window`` successive words also stand in a document with a smaller id.

    Every document is held against the blocks of all others; no longest match is extended, as
    equal windows alone decide which words go. Windows with the same words have the same anchor, so only blocks that share an anchor can hold
    a common window. A block found whole in a smaller document is a factor; at
    factor boundaries, where blocks share the anchor but not all words, single
    windows are compared, once for each different block.
    """
    blocks = materialise(index_blocks(docs, window), "rlz_blocks")
    shared = blocks.groupBy("anchor").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    shared = materialise(shared.select(F.col("anchor").alias("a")), "rlz_anchors")
    blocks = materialise(blocks.join(shared, F.col("anchor") == F.col("a")).drop("a"), "rlz_shared")
    kinds = materialise(blocks.groupBy(F.col("anchor").alias("a"), F.col("block").alias("b")).agg(F.min("doc").alias("holder")), "rlz_kinds")
    mixed = kinds.groupBy(F.col("a").alias("m")).agg(F.min("holder").alias("low"), F.max("holder").alias("high"), F.count("*").alias("kinds"))
    mixed = materialise(mixed.where("kinds > 1 and low < high").select("m"), "rlz_mixed")
    held = blocks.join(kinds, (F.col("anchor") == F.col("a")) & (F.col("block") == F.col("b")))
    factors = held.where("doc > holder").select("doc", "text_hash", F.col("at").alias("start"), (F.col("at") + F.col("n") + (window - 1)).alias("stop"))

    open_ = (held.where("doc = holder").join(mixed, F.col("anchor") == F.col("m"))
             .groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("t")).agg(F.collect_set(F.struct("anchor", "at", "n")).alias("open")))
    edges = docs.join(open_.hint("merge"), (F.col("doc") == F.col("d")) & (F.col("text_hash") == F.col("t"))).select("doc", "text_hash", "text", "open")
    edges = materialise(_edge_windows(edges, window), "rlz_edges")
    found = edges.groupBy(F.col("anchor").alias("a"), F.col("hash").alias("h")).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    found = materialise(found.where("first < last").drop("last"), "rlz_found")
    edges = edges.join(found, (F.col("anchor") == F.col("a")) & (F.col("hash") == F.col("h"))).where("doc > first")
    return factors.unionByName(edges.select("doc", "text_hash", F.col("at").alias("start"), (F.col("at") + window).alias("stop")))


def _cut(docs: DataFrame) -> DataFrame:
    """``docs`` (__text, __spans, others) with kept_text, n_words and n_removed in place of the two."""
    rest = [f for f in docs.schema if f.name not in ("__text", "__spans")]
    schema = T.StructType([*rest, T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            kept, total, gone = [], [], []
            for text, spans in zip(batch.column("__text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                if spans:
                    step = np.zeros(len(words) + 1, np.int32)
                    ends = np.array([(s["start"], s["stop"]) for s in spans], np.int64)
                    np.add.at(step, ends[:, 0], 1)
                    np.add.at(step, ends[:, 1], -1)
                    stay = np.cumsum(step)[:-1] == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                kept.append(b" ".join(words))
                gone.append(total[-1] - len(words))
            made = {"kept_text": pa.array(kept, pa.binary()).cast(arrow.field("kept_text").type), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else batch.column(f.name) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, other columns; of them ``keep``, default all) with kept_text, n_words and n_removed.

    A word goes when a run of ``window`` words that covers it also stands in a
    document with a smaller doc_id; runs are judged on the input. ``kept_text``
    has the words that stay, joined by one space.

    Defined cases: null text has no words (kept_text empty); a null doc_id is
    neither larger nor smaller than any, so its row is left whole and takes nothing from
    others; rows with the same doc_id take nothing from each other; texts shorter
    than the window stay; columns of ``docs`` named like results are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("kept_text", "n_words", "n_removed")]
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"c_{c}") for c in keep], F.col("doc_id").cast("long").alias("doc"),
                        F.xxhash64("text").alias("text_hash"), F.col("text"))
    spans = duplicate_factors(keyed.where("doc is not null and text is not null").select("doc", "text_hash", "text"), window)
    spans = spans.groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("t")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = keyed.join(spans.hint("merge"), (F.col("doc") == F.col("d")) & (F.col("text_hash") == F.col("t")), "left")
    out = _cut(joined.select(*[F.col(f"`c_{c}`") for c in keep], F.col("text").alias("__text"), F.col("spans").alias("__spans")))
    return out.select(*[F.col(f"`c_{c}`").alias(c) for c in keep], "kept_text", "n_words", "n_removed")
