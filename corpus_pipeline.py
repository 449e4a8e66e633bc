"""From raw documents to training pieces: five stages, each a table that the next one reads.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last keep the columns of ``documents``. Null doc_ids, null and empty texts, repeated
rows and extra columns have the results that the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, table
from ledgerline.llm.jaccard import one_of_each_group
from ledgerline.llm.mixing import taken_documents
from ledgerline.llm.pieces import encode_pieces
from ledgerline.llm.repeats import remove_repeats
from ledgerline.llm.toxicity import score_toxicity, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, trained on the labels, rejects go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, Jaccard 0.8 or more) the smallest doc_id stays."""
    return one_of_each_group(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words that a smaller document also has go; a text left without words goes as a whole.

    Texts that lose nothing stay as they are; others have their words joined by one space.
    """
    cut = remove_repeats(docs).where("n_removed = 0 or kept_text <> ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources takes it."""
    return taken_documents(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the piece ids of the text and their number. Copies of a document are
    numbered, so that each is cut on its own."""
    copies = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("lang", "source")
    numbered = docs.select("doc_id", "lang", "source", "text", F.row_number().over(copies).alias("copy"))
    encoded = encode_pieces(numbered, copy="copy")
    return encoded.select("doc_id", "lang", "source", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", to_pieces),
]

#: Training, components and piece merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
