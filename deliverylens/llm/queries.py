"""One query for each training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontam, langid, lattice, nndescent, packing, phrases, runs, secrets, simhash, site_tree,
               spelling, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.with_next(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, bits=3)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(_table(spark, sf_dir, "documents"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.nearest_ids(_table(spark, sf_dir, "embeddings"))


def op9_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(_table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secrets, op2_packing, op3_subword_lattice, op4_bpe, op5_phrases, op6_simhash, op7_language_id,
    op8_nn_descent, op9_site_style_tree, op10_warc, op11_decontamination, op12_periodic_runs,
    op13_spelling_variants)}

#: DuckDB SQL of the operators that SQL can express.
SQL: dict[str, str] = {
    "op10_warc": """
      SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
      FROM (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
              sha1(coalesce(html, '')) AS payload_digest,
              max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS keeper
            FROM pages)""",
    "op11_decontamination": """
      WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
      b AS (
        SELECT item_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM benchmark),
      windows AS (
        SELECT item_id, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g, least(len(w), 10) AS k
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
      places AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                 FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
      hits AS (SELECT r, i, k, item_id
               FROM (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM places) JOIN windows USING (g, k)),
      marked AS (SELECT r, count(DISTINCT p) AS n_hit
                 FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
      items AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed
                FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM d LEFT JOIN marked USING (r) LEFT JOIN items USING (r)""",
}
