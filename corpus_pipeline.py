"""Corpus pipeline over ``documents``: language ID, quality rules, near-duplicate join, substring
dedup, packing.  Every stage is one of the numbered operators and takes (spark, docs, sf_dir);
its result is written as Parquet and read again as the next one's docs.  All but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm import jaccard, langid, packing, quality, substrings
from markbook.llm.common import keep_rows, stored
from markbook.llm.queries import tokenizer

#: Bytes of the shortest repeated string that the substring stage removes: about 40 to 50 words, so that a passage of
#: over 50 words holds one.  The query op5 has the 400 bytes of its contract.
PASSAGE = 250


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose language cannot be told go."""
    found = langid.identify_documents(spark, docs)
    return keep_rows(docs, found.where("kept").select("row_key"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that fail the base rules or diverge from their language go."""
    found = quality.judge(spark, docs)
    return keep_rows(docs, found.where("kept").select("row_key"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near duplicates stays."""
    return jaccard.one_of_each(spark, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: bytes of repeated ``PASSAGE``-byte strings go, from every text that holds them; n_chars follows the text."""
    out = substrings.strip_documents(spark, docs, window=PASSAGE)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: packs every document left; workers that serve other stages too keep no words of it."""
    return packing.pack(spark, docs, tokenizer("word_bpe_49k.json"), keep_words=False)


STAGES = [("language ID", language), ("quality rules", rules), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", substring_dedup), ("packing", pack_sequences)]
#: No SQL: language ID and packing are not expressible; tests/llm holds run() to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage{number}")
    return docs
