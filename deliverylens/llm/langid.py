"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (one to
three letters of words padded with a blank), most frequent first. A document
is compared with each profile by the out-of-place distance: the sum, over the
document's own most frequent n-grams, of how far each is from its place in the
profile, or the profile's length where it is not listed.

Profiles count every n-gram of every training text. The only data that reach
the driver are the profiles: ``profile_size`` n-grams for each language label.

Defined cases: null text and text without a letter give ``und`` with score 0;
no profiles (no labelled training row, an empty table) give ``und`` for all;
equal counts order by the n-gram's code points and equal distances by the
language label, so repeated rows always agree; a row with a null id is scored
like any other; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_tasks, id_crc32, numbered, text_chunks

UNDETERMINED = "und"
PROFILE_SIZE = 300
#: Characters counted at once, and distinct n-grams a task holds before it passes them on.
SLICE = 500_000
HELD_GRAMS = 2_000_000
_BITS = 21  # of a code point; three of them fit one signed 64-bit key


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of each code point, itself if it is a letter, else 0."""
    table = np.arange(0x110000, dtype=np.int64)
    table[[not chr(c).isalpha() for c in range(0x110000)]] = 0
    return table


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and counts of the 1- to 3-grams of a text's words, each padded with a blank at both ends.

    A word is a run of letters. A key holds the code points, blanks as zeros,
    and marks the length above them, as a leading blank adds nothing.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.zeros(len(points) + 3, np.int64)
    c[1:-2] = _letters()[points]
    found = []
    for i in range(0, len(points) + 1, SLICE):  # grams by the place of their second character
        a, b, d = c[i: i + SLICE], c[i + 1: i + 1 + SLICE], c[i + 2: i + 2 + SLICE]
        a, b = a[: len(d)], b[: len(d)]
        single = b != 0
        pairs = a << _BITS | b  # the pair that ends the last word is the last character's with the blank after
        triples = pairs << _BITS | d
        keys = np.concatenate((b[single], pairs[pairs != 0] | (1 << 62), triples[single] | np.int64(-(1 << 63))))
        if not len(keys):
            continue
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        found.append((keys[first], np.diff(np.append(first, len(keys)))))
    if len(found) == 1:
        return found[0]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _sums(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))


def _top(keys: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent keys, most frequent first, equal counts by key (``keys`` ascend)."""
    if len(keys) > size:
        keep = n >= np.partition(n, len(n) - size)[len(n) - size]
        keys, n = keys[keep], n[keep]
    return keys[np.argsort(-n, kind="stable")][:size]


def profiles(labelled: DataFrame, profile_size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, rank): each label's ``profile_size`` most frequent n-grams over all rows of (lang, text)."""
    arrow_tasks(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            return _sums(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))

        def out():
            for lang, parts in seen.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()),
                                                  "gram": keys, "n": n})
            seen.clear()

        for b in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, mine in texts.items():
                parts = seen.setdefault(lang, [])
                for _, run in text_chunks(mine, SLICE):
                    parts.append(gram_counts(" ".join(run)))
                if len(parts) > 1:
                    parts[:] = [merged(parts)]
            if sum(len(k) for parts in seen.values() for k, _ in parts) > HELD_GRAMS:
                yield from out()
        yield from out()

    rows = labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    total = (rows.mapInArrow(count, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (total.withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= profile_size).select("lang", "gram", "rank"))


class RankOrder:
    """The profiles of all languages as one sorted key table, to score documents in a task."""

    def __init__(self, rows: pd.DataFrame, size: int = PROFILE_SIZE):
        self.size = size
        self.langs = sorted(rows["lang"].unique())
        self.keys = np.unique(rows["gram"].to_numpy(np.int64))
        # Ranks of absent n-grams are marked -1.
        self.ranks = np.full((len(self.langs), len(self.keys)), -1, np.int64)
        for i, lang in enumerate(self.langs):
            mine = rows[rows["lang"] == lang]
            self.ranks[i, np.searchsorted(self.keys, mine["gram"].to_numpy(np.int64))] = mine["rank"].to_numpy() - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        if not isinstance(text, str) or not self.langs:
            return UNDETERMINED, 0.0
        top = _top(*gram_counts(text), self.size)
        if not len(top):
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        known = self.keys[at] == top
        there = self.ranks[:, at]
        far = np.where(known & (there >= 0), np.abs(there - np.arange(len(top))), self.size).sum(axis=1)
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (self.size * len(top)))


def _identified(docs: DataFrame, model: pd.DataFrame, profile_size: int) -> DataFrame:
    """``docs`` with its columns renamed by place, and ``lang_pred`` and ``score``."""
    arrow_tasks(docs.sparkSession)
    rows, (text,) = numbered(docs, "text")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = RankOrder(model, profile_size)
        for b in batches:
            found = [ranks.predict(t) for t in b[text].to_pylist()]
            yield (b.append_column("lang_pred", pa.array([x[0] for x in found], pa.string()))
                   .append_column("score", pa.array([x[1] for x in found], pa.float64())))

    return rows.mapInArrow(score, schema)


def identify(docs: DataFrame, model: pd.DataFrame, profile_size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, all other columns kept; ``model``: collected `profiles`.

    Columns of the input named like the two new ones are replaced.
    """
    given = docs.drop("lang_pred", "score")
    return _identified(given, model, profile_size).toDF(*given.columns, "lang_pred", "score")


def with_a_language(docs: DataFrame, model: pd.DataFrame, profile_size: int = PROFILE_SIZE) -> DataFrame:
    """The rows of ``docs``, columns as given whatever their names, whose text has a language."""
    found = _identified(docs, model, profile_size).where(F.col("lang_pred") != UNDETERMINED)
    return found.drop("lang_pred", "score").toDF(*docs.columns)


def training_fold(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """Labelled rows whose crc32(id) remainder is not the held-out one."""
    return docs.select("doc_id", "lang", "text").where(id_crc32(F.col("doc_id")) % folds != held)


def predict_languages(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of (doc_id, text, lang).

    Profiles learn only from the training fold; a prediction reads the text alone.
    """
    model = profiles(training_fold(docs, folds, held)).toPandas()
    rows = docs.select("doc_id", (id_crc32(F.col("doc_id")) % folds == held).alias("held_out"), "text")
    return identify(rows, model).drop("text")
