"""The corpus pipeline: quality rules, near-duplicates, repeated passages, mixing and encoding, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and gives the columns of documents, but for the last, which gives doc_id, source, text and its
pieces. A stage works on all that the one before it kept. It takes COLUMNS by name and drops others, whatever they are called; an empty table
gives an empty result; the order of rows and their partitions change nothing. What else is defined stands with each stage and in
its operator's docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import mixing, neardup, pieces, quality, suffixdedup
from quillrank.llm.common import read, scratch, shared_dir, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words of a shingle in near_duplicates; the four of neardup.SHINGLE are op2_near_dedup's alone.
SHINGLE = 5
#: Bytes of a repeated string in repeated_passages: fifty words of four letters and their spaces. op6_suffix_dedup's 400 would let
#: most passages of 51 to 65 words stay.
PASSAGE = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy rejects go: a null or empty text has no words and goes; repeated rows go or stay alike."""
    return quality.apply_policy(quality.ledger(docs.select(*COLUMNS))).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id, in one row; documents of a null doc_id
    stay, each."""
    return neardup.deduplicated(docs.select(*COLUMNS), SHINGLE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of PASSAGE bytes that occur twice or more go; so does a character of which a byte goes. Texts of which nothing
    but white space is left go, too; n_chars counts what is left. A null text stays as it is, if one comes this far."""
    out = suffixdedup.without_repeats(docs.select(*COLUMNS), keep=COLUMNS, as_text=True, length=PASSAGE)
    out = out.withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept")))
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, so up to three times; a null source is a source; one without words goes."""
    return mixing.expand(mixing.mix(docs.select(*COLUMNS)))


def encoded_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces and ids; a null text has null ids."""
    return pieces.encoded(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("encoded_pieces", encoded_pieces),
]
#: SQL can neither sample pieces nor, on whole tables, find near-duplicates; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, folder = read(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        with scratch(spark):  # a stage's own tables go once its result is written
            docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}", shuffled=False)
    return docs
