"""From raw documents to subword ids, in stages that each read what the one before wrote.

Low-quality documents go, repeated lines go, one document of each near-duplicate group stays,
documents that hold benchmark passages go, and the rest is encoded. Up to the last stage the
rows have the columns of ``documents``; ``n_chars`` follows the text. A document that loses
all its lines stays, with the empty text.

Every stage takes an empty table, whose result is empty, and texts of any length, a slice of texts
at a time and a longer text by itself. Other columns than those of ``documents`` are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import mark_contamination
from millrace.llm.frames import saved, table
from millrace.llm.langid import remainder
from millrace.llm.linededup import drop_repeated_lines
from millrace.llm.neardup import near_duplicates
from millrace.llm.qualitynet import fit, score_quality
from millrace.llm.subwords import encode_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality network predicts to be bad.

    The network learns from labels whose id has another crc32 remainder (mod 4) than 2. A null
    text is scored as the empty one; a row with a null id, and each row of a repeated id, is
    judged by its own text.
    """
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    return score_quality(docs, fit(docs, labels)).where("predicted = 1").select(*COLUMNS)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that a document with a smaller id holds too.

    A null text becomes the empty one. Rows with a null id keep their lines and cost others none; rows
    of one id are one document.
    """
    return drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group.

    Null texts and texts without words are in no group. Rows with a null id stay; rows that
    repeat an id stay or go together.
    """
    dropped = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark passage; each row is judged by its own text, null as empty."""
    return mark_contamination(docs, table(spark, sf_dir, "benchmark")).where(F.size("hit_words") == 0).select(*COLUMNS)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the subword ids and what they decode to; a null or empty text has none. Every row stays."""
    encoded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good_documents),
    ("lines", distinct_lines),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("subwords", encoded_documents),
]

#: The network of the first stage cannot be put in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
