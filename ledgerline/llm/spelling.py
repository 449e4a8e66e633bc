"""Groups of spelling variants: PartEnum signatures of letter multisets, joined and verified."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .pieces import _by_size

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
#: One run in NOISE loses a letter, chosen by checksum (0: none does).
NOISE = 199
#: Distance of the letter multisets of near words at most: a replaced letter takes one and adds one.
DISTANCE = 2
#: Parts of the letter vector; any two near words agree in PARTS - DISTANCE of them.
PARTS = 4
#: Words that a task counts before it hands them on.
COUNTED = 500_000
#: Letters by their usual frequency, dealt to the parts in turn so that parts weigh alike.
LETTERS = "etaoinshrdlucmfwypvbgkqjxz"

_RANK = {ord(c): i for i, c in enumerate(LETTERS)}
#: Bytes of Latin-1: letters A-Z lower-cased, U+00C0 to U+00FF as they are, all others blank.
_LOWERED = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_M64 = (1 << 64) - 1


def letter_runs(text: str) -> list[bytes]:
    """The runs of letters A-Z, a-z and U+00C0 to U+00FF, one byte a letter, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LOWERED).split()


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, noise: int = NOISE) -> DataFrame:
    """(word, n) of the words in all of ``docs`` (doc_id, text), counted in each task first."""

    def words_of(doc_id: object, text: str) -> Iterator[tuple[bytes, int]]:
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        for run, n in Counter(letter_runs(text)).items():
            if len(run) < least_letters:
                continue
            if noise:
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if h % noise == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < least_letters:
                        continue
            yield run, n

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for whole in batches:
            for batch in _by_size(whole, "text"):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    for word, n in words_of(doc_id, text or ""):
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield flush(counts)
                    counts = Counter()
        yield flush(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _part(letter: int, nth: int) -> int:
    """The part of the vector that holds the ``nth`` occurrence of a letter."""
    return (_RANK.get(letter, letter) + nth) % PARTS


def signatures(word: str) -> list[int]:
    """PartEnum signatures of the word's letters as a binary vector (a place for each letter and occurrence).

    The vector is cut into PARTS; a signature holds all but DISTANCE of them, one for
    each choice. Vectors at distance DISTANCE or less differ in so many parts at most,
    so they agree in a signature.
    """
    seen: Counter = Counter()
    parts = [0] * PARTS
    for letter in map(ord, word):
        nth = seen[letter]
        seen[letter] += 1
        parts[_part(letter, nth)] += xxhash.xxh3_64_intdigest(nth.to_bytes(4, "little"), letter)
    return [xxhash.xxh3_64_intdigest(b"".join((parts[p] & _M64).to_bytes(8, "little") for p in kept), i)
            for i, kept in enumerate(combinations(range(PARTS), PARTS - DISTANCE))]


def _halves(word: str, length: int) -> list[int]:
    """Hashes of the first and last half by which a near pair whose shorter word has ``length`` letters agrees in one."""
    m = length // 2
    return [xxhash.xxh3_64_intdigest(f"{length} {i} {half}".encode()) for i, half in enumerate((word[:m], word[len(word) - (length - m) :]))]


def post_signatures(words: DataFrame) -> DataFrame:
    """(key, word, n, longer): each signature of ``words`` (word, n), split by length and by half of the word.

    Syllables make many words with much the same letters, so a bare signature would
    gather thousands; one change leaves the first or the last half as it is, so the
    halves split the groups and lose no near pair. ``longer`` marks the keys under which
    a word meets words shorter by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 20_000):
                batch = whole.slice(at, 20_000)
                keys, rows, longer = [], [], []
                for i, word in enumerate(batch.column("word").to_pylist()):
                    signed = signatures(word)
                    for less in (0, 1):
                        for half in _halves(word, len(word) - less):
                            keys += [half ^ s for s in signed]
                            rows += [i] * len(signed)
                            longer += [less == 1] * len(signed)
                row = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), batch.column("word").take(row),
                                                  batch.column("n").take(row), pa.array(longer, pa.bool_())], names=["key", "word", "n", "longer"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long, longer boolean")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs of ``words`` (word, n) that differ by one inserted, deleted or replaced
    letter, each once. Signatures are joined by equality; the distance decides."""
    posted = materialise(post_signatures(words), "spelling_posted")
    left = posted.where("not longer").select(F.col("key").alias("k"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = posted.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "longer")
    near = left.join(right.hint("merge"), (F.col("k") == F.col("key")) & F.when(F.col("longer"), F.char_length("a") < F.char_length("b")).otherwise((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))
                     & (F.levenshtein("a", "b", 1) == 1))
    return near.select("a", "a_n", "b", "b_n").distinct()


def follow_forms(forms: DataFrame, rounds: int = 40) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each chain of forms, by pointer doubling."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    for _ in range(rounds):
        ahead = at.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = materialise(at.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at
    raise RuntimeError(f"forms did not end in {rounds} rounds")


def spelling_variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                      noise: int = NOISE) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words in ``docs`` (doc_id, text, other columns).

    Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z lower-cased) with
    ``least_letters`` letters and ``least_count`` occurrences in all documents; one run
    in ``noise`` loses a letter first. A word's form is its near word (one letter
    inserted, deleted or replaced) with most occurrences, ties to the smallest in code
    point order, if they are ``ratio`` times its own or more; root is where forms lead.

    Defined cases: null and empty texts have no words; a null doc_id counts as an
    empty one; very long texts are counted whole; repeated rows count each; an empty
    table gives no rows; other columns are not read.
    """
    words = materialise(count_words(docs, least_letters, noise).where(F.col("n") >= least_count), "spelling_words")
    near = materialise(near_pairs(words), "spelling_near")
    both = near.select(F.col("a").alias("w"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        near.select(F.col("b").alias("w"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = both.groupBy("w").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best = best.select("w", "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    found = words.join(best, F.col("word") == F.col("w"), "left")
    takes = F.col("other_n") >= ratio * F.col("n")
    found = materialise(found.select("word", F.when(takes, F.col("other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(takes, F.col("other_n")).alias("form_n")), "spelling_forms")
    roots = follow_forms(found.where("form is not null")).select(F.col("word").alias("w"), "root")
    return found.join(roots, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
