"""Spelling variants grouped by reduced-alphabet generation.

Words within one edit (one code point inserted, deleted or replaced) are found
on words over a reduced alphabet: a hash maps each letter to one of a few
symbols, so that a reduced word has few one-edit neighbours. These are generated
in full and joined with the reduced words there are; what meets is verified on
the original words. Of the two ends of an edit one generates it: the longer
word its deletions, the word with the smaller symbol its replacements, and each
reduced word itself, since a replacement may not change the symbol.

Reduced words are named by a polynomial of their symbols modulo 2^64, from which
those of all neighbours follow by one addition each. Names that collide only
lead to pairs that are not verified. Before the join, neighbours are looked up
in a bitmap of the reduced words (`BITMAP_BITS` at most, with which it saturates
and drops nothing wrongly), so that few of them are shuffled.

The alphabet has `SYMBOLS` symbols, doubled until the symbols to the power of
`LETTERS` are as many as the words, and again while more than `CANDIDATES` pairs
a word would have to be verified, up to one symbol for each code point, where
what meets is what is verified. So a group of words alike over few symbols is
split by a larger alphabet and never compared all with all.

The form of a word is its near word of the greatest count, if that is at least
`RATIO` times its own; the root is the last of the forms that follow one
another. Counts grow by `RATIO` at each step, so there are at most as many steps
as a count has digits; they are doubled by joins.

Defined cases: null texts have no words; a null id counts as the empty text;
words occur as often as texts hold them, repeated rows count each; ties go to
the smallest word in code-point order; an empty table, or one in which no word
is counted, gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_tasks, written

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
SYMBOLS, LETTERS, CANDIDATES = 8, 6, 64
BITMAP_BITS = 1 << 27
#: Distinct words that a counting task holds before it passes them on.
HELD = 200_000
#: Neighbours that are generated at a time.
AT_ONCE = 1_000_000
_RUN = re.compile("[a-zÀ-ÿ]+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

Respell = Callable[[str, int], str]


# ---------------------------------------------------------------- words

def slip(word: str, h: int, one_in: int = 31) -> str:
    """``word`` without one code point where ``one_in`` divides its hash."""
    if h % one_in:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1:]


def text_words(doc_id: int | None, text: str | None, respell: Respell | None) -> Counter:
    """The words of a text with their counts, each respelled by the crc32 of ``<doc_id>:<word>``."""
    found = Counter(_RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for w, n in found.items():
        if len(w) >= LEAST_LENGTH:  # a respelled word is no longer than its origin
            out[respell(w, zlib.crc32(w.encode(), start)) if respell else w] += n
    return out


def vocabulary(docs: DataFrame, respell: Respell | None = slip) -> DataFrame:
    """(word, n) of the words of (doc_id, text) that are long and frequent enough."""
    arrow_tasks(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in held if len(w) >= LEAST_LENGTH]
            batch = pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()),
                                                "n": pa.array([held[w] for w in words], pa.int64())})
            held.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                held.update(text_words(doc_id, text, respell))
                if len(held) > HELD:
                    yield out()
        yield out()

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


# ---------------------------------------------------------------- reduced words

def _symbols(points: np.ndarray, symbols: int) -> np.ndarray:
    """1 to ``symbols`` for each code point; the code point itself, plus one, where there are as many symbols."""
    points = points.astype(np.uint64)
    if symbols >= 0x110000:
        return points + np.uint64(1)
    return ((points * np.uint64(_BASE)) >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points by row) of the words of each length, in parts of bounded size."""
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(len(w), []).append(i)
    for n, at in places.items():
        rows = max(1, AT_ONCE // (8 * n))
        for i in range(0, len(at), rows):
            part = at[i: i + rows]
            points = np.frombuffer("".join(words[j] for j in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield np.array(part), points.reshape(len(part), n)


def names(words: list[str], symbols: int) -> np.ndarray:
    """The name of the reduced form of each word."""
    out = np.zeros(len(words), np.uint64)
    for places, points in by_length(words):
        out[places] = (_symbols(points, symbols) * _powers(points.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def neighbours(points: np.ndarray, symbols: int, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, name of a one-edit neighbour) of words of one length: themselves, deletions, replacements upwards.

    ``letters``: the symbols that occur in the vocabulary, ascending.
    """
    x = _symbols(points, symbols)
    power = _powers(x.shape[1])
    sums = np.cumsum(x * power, axis=1, dtype=np.uint64)
    name = sums[:, -1]
    rows = np.arange(len(x))
    yield rows, name
    for j in range(x.shape[1]):
        # Without symbol j what follows it moves one power down; alike neighbours give the same word.
        fresh = rows if j == 0 else rows[x[:, j] != x[:, j - 1]]
        before = sums[fresh, j - 1] if j else np.zeros(len(fresh), np.uint64)
        yield fresh, before + (name[fresh] - sums[fresh, j]) * np.uint64(_INVERSE)
        for c in letters:
            up = np.flatnonzero(x[:, j] < c)
            yield up, name[up] + (c - x[up, j]) * power[j]


def _slot(name: np.ndarray, bits: int) -> np.ndarray:
    h = (name ^ (name >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((h ^ (h >> np.uint64(33))) & np.uint64(bits - 1)).astype(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def reduced(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with ``name``, the name of its reduced form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b["word"], b["n"], _signed(names(b["word"].to_pylist(), symbols))], ["word", "n", "name"])

    return words.mapInArrow(run, "word string, n long, name long")


def _bitmap(forms: DataFrame, bits: int) -> np.ndarray:
    """Bits of the names there are, or-ed by Spark: ``bits`` / 64 rows at most reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = _slot(b["name"].to_numpy().view(np.uint64), bits)
            word, inverse = np.unique(slot >> 6, return_inverse=True)
            mask = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(mask, inverse, np.uint64(1) << (slot & 63).astype(np.uint64))
            yield pa.RecordBatch.from_pydict({"word": pa.array(word, pa.int64()), "mask": _signed(mask)})

    found = (forms.select("name").mapInArrow(run, "word long, mask long")
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    out = np.zeros(max(1, bits // 64), np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def _letters(words: DataFrame, symbols: int) -> np.ndarray:
    """The symbols that occur: ``symbols`` at most, or the vocabulary's distinct code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _symbols(np.zeros(0, np.uint32), symbols)
        for b in batches:
            points = np.frombuffer("".join(b["word"].to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            seen = np.union1d(seen, _symbols(np.unique(points), symbols))
        yield pa.RecordBatch.from_pydict({"symbol": _signed(seen)})

    rows = words.select("word").mapInArrow(run, "symbol long").distinct().collect()
    return np.sort(np.array([r.symbol for r in rows], np.int64)).view(np.uint64)


def reduced_pairs(words: DataFrame, symbols: int) -> tuple[DataFrame, DataFrame]:
    """(name, near, work) of reduced words one edit or none apart, and ``words`` with their names.

    ``work``: the pairs of words behind a pair of names.
    """
    spark = words.sparkSession
    named = written(reduced(words, symbols), "named")
    forms = written(named.groupBy("name").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("m")), "forms")
    bits = min(BITMAP_BITS, 1 << max(10, int(16 * max(1, forms.count())).bit_length()))
    seen = spark.sparkContext.broadcast((_bitmap(forms, bits), _letters(words, symbols)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, letters = seen.value
        for b in batches:
            own, m = b["name"].to_numpy(), b["m"].to_numpy()
            for places, points in by_length(b["word"].to_pylist()):
                parts = []
                for rows, near in neighbours(points, symbols, letters):
                    slot = _slot(near, bits)
                    there = (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
                    parts.append((places[rows[there]], near[there]))
                at = np.concatenate([p for p, _ in parts])
                near = np.concatenate([n for _, n in parts])
                yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(m[at]), _signed(near)],
                                                 ["name", "m", "near"])

    met = forms.mapInArrow(run, "name long, m long, near long").join(
        forms.select(F.col("name").alias("near"), F.col("m").alias("m_near")), "near")
    return written(met.select("name", "near", (F.col("m") * F.col("m_near")).alias("work")), "pairs"), named


# ---------------------------------------------------------------- variants

def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): pairs a < b of (word, n) exactly one edit apart, each once."""
    arrow_tasks(words.sparkSession)
    count = words.count()
    symbols = SYMBOLS
    while symbols ** LETTERS < count:
        symbols *= 2
    while True:
        pairs, named = reduced_pairs(words, symbols)
        work = pairs.agg(F.sum("work")).first()[0] or 0
        if work <= CANDIDATES * max(1, count) or symbols >= 0x110000:
            break
        symbols = 2 * symbols if symbols < 256 else 0x110000
    one = named.select("name", F.col("word").alias("u"), F.col("n").alias("n_u"))
    other = named.select(F.col("name").alias("near"), F.col("word").alias("v"), F.col("n").alias("n_v"))
    met = pairs.select("name", "near").join(one, "name").join(other, "near").where(
        ((F.col("name") != F.col("near")) | (F.col("u") < F.col("v"))) & (F.levenshtein("u", "v", 1) == 1))
    low = F.col("u") < F.col("v")
    return met.select(F.least("u", "v").alias("a"), F.when(low, F.col("n_u")).otherwise(F.col("n_v")).alias("n_a"),
                      F.greatest("u", "v").alias("b"), F.when(low, F.col("n_v")).otherwise(F.col("n_u")).alias("n_b")
                      ).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the forms that follow one another."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(onward, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "roots")
        now = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return now


def variants(docs: DataFrame, respell: Respell | None = slip) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of (doc_id, text) that is long and frequent enough."""
    words = written(vocabulary(docs, respell), "vocabulary")
    pairs = near_pairs(words)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"),
                                      F.col("n_b").alias("n_of")),
                             F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"),
                                      F.col("n_a").alias("n_of"))))
    best = F.min(F.struct((-F.col("n_of")).alias("n"), "near")).alias("best")
    near = written(pairs.select(both.alias("p")).select("p.*").groupBy("word", "n")
                   .agg(F.count(F.lit(1)).alias("n_near"), best)
                   .select("word", "n_near", F.when(-F.col("best.n") >= RATIO * F.col("n"), F.col("best.near")).alias("form"),
                           (-F.col("best.n")).alias("form_n")), "near")
    with_root = near.join(roots(near.where("form IS NOT NULL")), "word", "left")
    return (words.join(with_root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                    F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n")))
