"""Benchmark decontamination: windows of training words looked up among those of the benchmark.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.
A benchmark item gives its windows of `SIZE` consecutive words (an item with
fewer is one window). The hashes of these windows are a broadcast hash table;
every window of every training text is looked up in it, and a hit counts only
when the words are equal. Words inside a hit are marked; `without_spans` removes
them from the text, `without_documents` removes the document.

Everything is built-in functions: a text is split once, its positions are
generated, and lookup and comparison happen in the same pass, so that only hits
and one end mark a row are shuffled. The end mark is the empty window, which
stands in the table for this purpose; it brings back texts without a hit. A
benchmark over `WINDOWS_AT_ONCE` windows or `BYTES_AT_ONCE` bytes is dealt into
blocks, each broadcast on its own in a further pass over the texts.

Defined cases: null and empty texts have no words and no hits; rows are never
merged, a repeated row comes out as often as it goes in; null document ids are
kept; items without words have no windows; items of one id count once; an item
without an id marks words but is neither counted nor listed; an empty table
gives an empty result, an empty benchmark no hits; extra columns are not read,
and the two cleaning functions keep them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, written

SIZE = 10
#: What stands between words; A-Z count as letters before and after they are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: A broadcast table holds no more than this of the benchmark.
WINDOWS_AT_ONCE = 250_000
BYTES_AT_ONCE = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased; `lower` does just that where all characters are ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), f"{GAP}+"), "")


def row_key(doc_id: Column, text: Column) -> Column:
    """Digest of id and text: rows alike in both have the same result."""
    return F.unhex(F.sha2(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")),
                                      F.coalesce(text, F.lit(""))), 256))


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(window, items): each distinct window of (item_id, text) with the ids of its items."""
    split = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(size))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1))
    return (split.select("item_id", "w", length.alias("len"), at.alias("at"))
            .select("item_id", F.slice("w", F.col("at"), F.col("len")).alias("window"))
            .groupBy("window").agg(F.collect_set("item_id").alias("items")))


def _blocks(windows: DataFrame, rows: int, most_bytes: int) -> tuple[int, list[int]]:
    """Blocks that the windows are dealt into, and the lengths that occur (at most the window size of them)."""
    weight = F.octet_length(F.concat_ws(" ", "window")) + 8 * F.size("items") + 128
    n, total, lengths = windows.agg(F.count(F.lit(1)), F.sum(weight), F.collect_set(F.size("window"))).first()
    return max(1, -(-n // rows), -(-(total or 0) // most_bytes)), sorted(lengths)


def _found(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, doc_id, n, at, len, items) of every window of the texts that is in the broadcast ``windows``.

    The end of each text meets the empty window if that is among them.
    """
    split = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        words(F.col("text")).alias("w"))
    placed = split.select("*", F.size("w").alias("n"), F.explode(F.sequence(F.lit(0), F.size("w"))).alias("at"))
    if len(lengths) > 1:
        placed = placed.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("len"))
    else:
        placed = placed.withColumn("len", F.lit(lengths[0]))
    end = (F.col("at") == F.col("n")) & (F.col("len") == lengths[-1])
    seen = (placed.where((F.col("at") + F.col("len") <= F.col("n")) | end)
            .withColumn("seen", F.slice("w", F.col("at") + 1, F.col("len")))
            .withColumn("hash", F.xxhash64("seen")))
    table = windows.select(F.xxhash64("window").alias("hash"), "window", "items")
    # Written with = the words would become a key of the join, and be copied for each lookup.
    return (seen.join(F.broadcast(table), "hash").where("seen <= window AND seen >= window")
            .select("key", "doc_id", "n", "at", F.size("window").alias("len"), "items"))


def _marked(spans: Column) -> Column:
    """The positions that (start, length) spans cover, ascending."""
    each = F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, windows_at_once: int = WINDOWS_AT_ONCE,
         bytes_at_once: int = BYTES_AT_ONCE) -> DataFrame:
    """(key, doc_id, copies, n_words, marked, items) of every distinct (doc_id, text).

    ``marked``: positions of the words inside a hit, ascending; ``items``: distinct ids of the items hit.
    """
    windows = written(benchmark_windows(benchmark, size), "windows")
    blocks, lengths = _blocks(windows, windows_at_once, bytes_at_once)
    lengths = sorted({*lengths, size})
    none = docs.sparkSession.range(1).select(F.array().cast("array<string>").alias("window"),
                                             F.array().cast(windows.schema["items"].dataType).alias("items"))
    if blocks == 1:
        found = _found(docs, windows.unionByName(none), lengths)
    else:
        parts = []
        for i in range(blocks):
            mine = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i)
            parts.append(written(_found(docs, mine if i else mine.unionByName(none), lengths), "hits"))
        found = reduce(DataFrame.unionByName, parts)
    hit = F.col("len") > 0
    span = F.struct(F.col("at").alias("start"), "len")
    return (found.groupBy("key", "doc_id")
            .agg(F.sum(F.when(hit, 0).otherwise(1)).alias("copies"), F.max("n").cast("long").alias("n_words"),
                 F.collect_set(F.when(hit, span)).alias("spans"), F.collect_set(F.when(hit, F.col("items"))).alias("items"))
            .select("key", "doc_id", "copies", "n_words", _marked(F.col("spans")).alias("marked"),
                    F.array_distinct(F.flatten("items")).alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, **bounds: int) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of (doc_id, text)."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return (hits(docs, benchmark, size, **bounds)
            .select("doc_id", "n_words", F.size("marked").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(listed, 256).alias("items_sha256"),
                    F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")))


def _with_marks(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, str]:
    """``docs`` by place, each row with its ``marked`` words (null where it has none), and the text column's name."""
    given, (doc_id, text) = numbered(docs, "doc_id", "text")
    plain = given.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = hits(plain, benchmark, size).where("size(marked) > 0").select("key", "marked")
    keyed = given.withColumn("key", row_key(F.col(doc_id), F.col(text)))
    return keyed.join(found, "key", "left").drop("key"), text


def without_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, columns as given, without a window of the benchmark."""
    rows, _ = _with_marks(docs, benchmark, size)
    return rows.where("marked IS NULL").drop("marked").toDF(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs``, columns as given, with each stretch of marked words, and the gaps inside it, cut out of ``text``."""
    rows, text = _with_marks(docs, benchmark, size)
    # Words and gaps alternate: word i is token 2 i, or one later where the text begins with a gap.
    shift = F.regexp_like(F.col(text), F.lit(f"^{GAP}")).cast("int")
    mark = F.col("marked")
    before = lambda x, i: (i == 0) | (F.try_element_at(mark, i) != x - 1)
    after = lambda x, i: (i == F.size(mark) - 1) | (F.try_element_at(mark, i + 2) != x + 1)
    cut = rows.select(
        "*", F.split(F.col(text), f"(?<={_WORD})(?={GAP})|(?<={GAP})(?={_WORD})").alias("tokens"),
        F.transform(F.filter(mark, before), lambda x: 2 * x + shift).alias("first"),
        F.transform(F.filter(mark, after), lambda x: 2 * x + shift + 1).alias("past"))
    kept = F.zip_with(F.concat(F.array(F.lit(0)), "past"), F.concat("first", F.array(F.size("tokens"))),
                      lambda a, b: F.slice("tokens", a + 1, b - a))
    left = F.when(mark.isNull(), F.col(text)).otherwise(F.array_join(F.flatten(kept), ""))
    return (cut.withColumn("left", left).select(*[F.col("left").alias(c) if c == text else F.col(c)
                                                  for c in rows.columns if c != "marked"]).toDF(*docs.columns))
