"""A training-data pipeline over ``documents``: toxicity, near duplicates, repeated passages, benchmark items, packing.

Each stage reads all that the one before kept and returns the columns of documents; the last returns the packed pieces.
Columns besides doc_id and text are carried along whatever their names (n_chars follows a text that is cut). Null, empty and
very long texts, null and repeated ids, repeated rows and empty tables have the results that the operators state: a null or
empty text is not toxic, is a copy of the other texts without a word, holds no passage and no benchmark item, and is packed
as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, near_copies, packing, suffix_dedup, toxicity
from vigil.llm.names import free_names
from vigil.llm.queries import CAPACITY, vocabulary
from vigil.plans.materialize import discard, materialize
from vigil.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under 0.5; the model never learns from held-out rows."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out())
    (score,) = free_names(docs, "score")
    return toxicity.score_texts(docs, model, tuple(docs.columns), score).where(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts whose five-word shingles are alike by 0.8 or more: that of the smallest doc_id, then of the smallest text hash."""
    return near_copies.drop_near_copies(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that stand elsewhere too; rows of which nothing is left go."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the other columns travel as one, so that none clashes with the operator's own
    rows = docs.select("doc_id", "text", F.struct(*others).alias("others")) if others else docs
    left = suffix_dedup.remove_repeats(rows, keep=("others",) if others else ()).where("n_removed = 0 OR n_removed < n_bytes")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")} | {c: F.col("others").getField(c) for c in others}
    if "n_chars" in others:
        length = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(columns["n_chars"])
        columns["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return left.select(*(columns[c].alias(c) for c in docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most CAPACITY tokens with their sequence and offset."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), CAPACITY)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("repeated_passages", drop_repeats), ("decontamination", drop_benchmark), ("packing", pack)]

#: Models, hashes and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
