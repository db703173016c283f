"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes every stage's result as
Parquet to the shared folder, reads it again and removes it when the next one is there. Columns beyond those of
``documents`` are dropped at the first stage. Rows with a null id are judged and deduplicated like others, but are never
near-duplicates of anything. A row repeated as a whole has one id: near-duplicates keeps all its copies or none, and
repeated passages then takes what stands in both. A document left without text is packed as its end token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import cotraining, fertility, near_dedup, packing, substring_dedup
from lakewarden.llm.base import remove_folder, scratch, write_parquet
from lakewarden.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, tokenizer_path
from lakewarden.llm.registry import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return cotraining.score_documents(docs, model, keep=list(COLUMNS)).filter("kept").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and the bands of token measures accept."""
    # The text comes back from the measuring, so that no join brings it.
    judged = fertility.judge(docs.select(*COLUMNS), tokenizer_path(PIECE_BPE), tokenizer_path(BYTE_BPE), keep_text=True)
    return judged.filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS), shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 35 words or more that repeat anywhere; the size follows the text."""
    done = substring_dedup.remove_repeats(docs.select(*COLUMNS), window=35, outputs=("cleaned",))
    size = F.when(F.col("n_removed") > 0, F.length("cleaned").cast("bigint")).otherwise(F.col("n_chars"))
    return done.select("doc_id", F.col("cleaned").alias("text"), "lang", "source", size.alias("n_chars"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path(WORD_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packed_sequences", packed_sequences),
]

#: No SQL has classifiers, tokenisers and packing; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns where every piece of every remaining document stands."""
    docs = table(spark, sf_dir, "documents")
    folder, before = scratch(spark), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        write_parquet(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
