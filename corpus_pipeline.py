"""Training-data pipeline: language ID, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last
return the columns of their input, whatever else they hold and however they are
named. All stages take nulls in any column, empty and very long texts, repeated
rows and an empty table (which gives an empty one); their docstrings say what
becomes of these.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import langid, packing, secrets, simhash
from deliverylens.llm.common import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language.

    Null and empty texts and those without a letter go; where no row has both a
    label and a letter no profile is learned, and every row goes. A null label
    or id is no reason to go; repeated rows stay or go alike.
    """
    return langid.with_a_language(docs, langid.profiles(docs.select("lang", "text")).toPandas())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id.

    Null ids come last, then the first by a hash of the row; of rows alike in
    every column one stays. Null and empty texts are one group.
    """
    return simhash.keep_one(docs, shingle=3, bits=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, the secrets in its text masked and ``n_chars`` counted anew.

    A null text stays null, with a null ``n_chars``; repeated rows are masked
    alike. Where there are too few findings to learn from, only patterns mask.
    """
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequences that hold them.

    A null or empty text is one piece of one token; each of several equal rows
    has its own pieces; a null id is kept.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates),
          ("secret_scan", secret_scan), ("best_fit_packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
