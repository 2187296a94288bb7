"""A corpus from raw documents to packed token windows, in five stages that each read what the one before wrote.

Quality classifier (rejected documents go), line de-duplication (later similar lines go, and documents left without a
word), near-duplicate documents (the one with the smallest id of each group stays), repeated passages (the first
occurrence stays, later ones go, in the same document too) and packing. All but the last stage return the columns of ``documents``; ``n_chars`` follows the
text. Null texts count as empty; documents without an id are compared with none and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import line_dedup, near_dup, packing, quality_classifier, suffix_dedup
from firnline.llm.common import Scratch, read_table
from firnline.llm.queries import tokenizer_path

#: Passages of 50 words and more are longer than this in every language at hand.
PASSAGE_BYTES = 240
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(frame: DataFrame) -> DataFrame:
    return frame.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_good(docs.select(*COLUMNS))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs, min_words=1, carry=("lang", "source"))
    left = (F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    return _documents(out.where(left).withColumn("text", F.col("kept")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_dup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    with_id = docs.join(kept.where("_kept is not null"), F.col("doc_id") == F.col("_kept"), "left_semi")
    return with_id.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))  # null equals no _kept


def new_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(docs, PASSAGE_BYTES, first_stays=True, whole_characters=True, carry=("lang", "source"))
    out = out.withColumn("text", F.col("kept").cast("string"))
    return _documents(out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", new_lines),
    ("minhash near-dedup", one_of_each_group),
    ("suffix-array dedup", new_passages),
    ("packing", packed),
]

#: Learned scores, sketches and token ids are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{n}")
        if n:
            scratch.free(f"stage-{n - 1}")
    return docs
