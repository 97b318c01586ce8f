"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, these into phrases of phrases, and so on. At
each level equal neighbours are first named together as one run. Then
deterministic coin tossing labels every name from itself and its left
neighbour: the place of the lowest bit in which the two differ, and that bit.
A few rounds leave six labels, neighbours never alike; three are replaced, and
a phrase begins wherever a label is greater than both its neighbours. Where a
phrase begins depends on a few names around it only, so equal stretches of two
texts have the same phrases inside, at whatever offset they stand. A phrase's
name is a hash of the names in it.

The fingerprint keeps, for each of `LEVELS`, the least name in each of `BINS`
bins (16 bits of it). The likeness of two fingerprints is the mean, over the
levels, of the share of bins that agree among those that either one uses,
which estimates the share of phrases that the texts have in common.

`with_next` compares every text with the text after it in order of id: one
range shuffle, each partition read in order, and the first row of a partition
handed to the partition before by a small join.

Defined cases: null counts as empty; the fingerprint of an empty text has no
phrases, is like another such one (1) and unlike any other (0); rows of one id
follow one another by a hash of their text; a null id comes first; the only
row of a table is its own next; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_tasks, code_points, text_chunks, written

LEVELS = (2, 3, 4)
BINS = 32
EMPTY = 0xFFFF
CHUNK_CHARS = 150_000
_U = np.uint64
_ODD = np.cumprod(np.full(64, _U(0x9E3779B97F4A7C15)), dtype=np.uint64)  # powers of an odd constant


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit names."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _toss(label: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which label and left differ, and the label's bit there, in 8 bits."""
    differ = label ^ left
    one = label.dtype.type(1)
    below = ~differ & (differ - one)  # the bits under the lowest set one
    set_there = (label & (below + one)) != 0
    return (np.bitwise_count(below) << np.uint8(1)) | set_there


def _shift(x: np.ndarray, first: np.ndarray, fill) -> np.ndarray:
    """The left neighbour of each name, ``fill`` at the first name of a text."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = fill
    return left


def _name(x: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Names of the stretches that begin at ``begins``: hashes of the names in them, in order."""
    place = np.arange(len(x)) - np.repeat(begins, np.diff(np.append(begins, len(x))))
    return _mix(np.add.reduceat(x * _ODD[np.minimum(place, 63)], begins) + _U(1))


def _level(x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level of phrases over names ``x`` of several texts (``offsets``: first name of each non-empty text)."""
    # Runs of one name.
    begin = np.empty(len(x), bool)
    begin[1:] = x[1:] != x[:-1]
    begin[offsets] = True
    at = np.flatnonzero(begin)
    length = np.diff(np.append(at, len(x)))
    x = np.where(length > 1, _mix(x[at] + _U(0x51ED27) * length.astype(np.uint64)), x[at])
    offsets = np.searchsorted(at, offsets)
    # Coin tossing: 64 bits to 7, 4, 3 and at last six labels.
    label = _toss(x, _shift(x, offsets, _U(1) << _U(63)))
    for _ in range(3):
        label = _toss(label, _shift(label, offsets, np.uint8(128)))
        label[offsets] = np.minimum(label[offsets], np.uint8(5))
    label = np.minimum(label, np.uint8(5)).astype(np.int8)
    # Neighbours of each name, 7 beyond a text's ends; three rounds replace labels 5, 4 and 3.
    last = np.append(offsets[1:], len(x)) - 1
    left, right = np.empty_like(label), np.empty_like(label)
    for v in (5, 4, 3):
        who = np.flatnonzero(label == v)
        left[1:], right[:-1] = label[:-1], label[1:]
        left[offsets], right[last] = 7, 7
        l, r = left[who], right[who]
        free = np.zeros(len(who), np.int8)
        for _ in range(2):  # the least of 0, 1, 2 that neither neighbour has
            free += (free == l) | (free == r)
        label[who] = free
    # A phrase begins at every label above both its neighbours, and at a text's first name.
    left[1:], right[:-1] = label[:-1], label[1:]
    left[offsets], right[last] = 7, 7
    begin = (label > left) & (label > right)
    begin[offsets] = True
    at = np.flatnonzero(begin)
    return _name(x, at), np.searchsorted(at, offsets)


def signatures(texts: Sequence[str]) -> np.ndarray:
    """Fingerprints, one row of 16-bit values for each text."""
    out = np.full((len(texts), len(LEVELS) * BINS), EMPTY, np.uint16)
    for first, run in text_chunks(texts, CHUNK_CHARS):
        codes, ends = code_points(run)
        some = np.flatnonzero(np.diff(ends))
        if not len(some):
            continue
        x, offsets = _mix(codes.astype(np.uint64) + _U(1)), ends[some]
        for depth in range(1, max(LEVELS) + 1):
            x, offsets = _level(x, offsets)
            if depth in LEVELS:
                owner = np.repeat(some, np.diff(np.append(offsets, len(x))))
                value = np.minimum((x >> _U(16)).astype(np.uint16), EMPTY - 1)
                cell = owner * BINS + (x % _U(BINS)).astype(np.int64)
                least = np.full(len(run) * BINS, EMPTY, np.uint16)
                np.minimum.at(least, cell, value)
                col = LEVELS.index(depth) * BINS
                out[first: first + len(run), col: col + BINS] = least.reshape(len(run), BINS)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, row by row."""
    a, b = a.reshape(len(a), len(LEVELS), BINS), b.reshape(len(b), len(LEVELS), BINS)
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=2)
    same = ((a == b) & (a != EMPTY)).sum(axis=2)
    share = np.where(used > 0, same / np.maximum(used, 1), 1.0)
    return share.mean(axis=1)


def as_text(signature: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in signature]


def from_text(hexes: Sequence[str]) -> np.ndarray:
    return np.array([np.frombuffer(bytes.fromhex(h), ">u2") for h in hexes], np.uint16).reshape(
        len(hexes), len(LEVELS) * BINS)


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``after``."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


# ---------------------------------------------------------------- Spark

_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _rows(ids: list, texts: list[str], after: list[str], own: np.ndarray, following: np.ndarray) -> list[list]:
    """Columns of the result for texts, the texts after them and the fingerprints of both."""
    changed = [edited(t, a) for t, a in zip(texts, after)]
    new = signatures(changed)
    return [ids, [len(t) for t in texts],
            [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
            as_text(own), as_text(new), likeness(own, new).tolist(), likeness(own, following).tolist()]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of (doc_id, text)."""
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = as_text(signatures([t or "" for t in b["text"].to_pylist()]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(names, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Every row of (doc_id, text) with its fingerprint, that of its edited text, and the likeness to both others."""
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = [*_NAMES, "part", "edge", "text"]
        types = [*_TYPES, pa.int32(), pa.string(), pa.string()]

        def out(cols: list[list], edge: str | None = None, text: str | None = None) -> pa.RecordBatch:
            n = len(cols[0])
            cols = [*cols, [part] * n, [edge] * n, [text] * n]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        def at_edge(which: str, doc_id, text: str, own: np.ndarray) -> pa.RecordBatch:
            return out([[doc_id], [len(text)], [None], as_text(own), [None], [None], [None]], which, text)

        held = None  # the last row so far: id, text, fingerprint
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            all_ids = b["doc_id"].to_pylist()
            given = [unpack.decompress(z).decode("utf-8", "surrogatepass") for z in b["text"].to_pylist()]
            for i, texts in text_chunks(given, CHUNK_CHARS):
                ids, own = all_ids[i: i + len(texts)], signatures(texts)
                if held is None:
                    yield at_edge("first", ids[0], texts[0], own[:1])
                else:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], np.concatenate((held[2], own))
                if len(ids) > 1:
                    yield out(_rows(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:]))
                held = ids[-1], texts[-1], own[-1:]
        if held is not None:
            yield at_edge("last", *held)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["tie"], pa.array(texts, pa.binary())],
                                             ["doc_id", "tie", "text"])

    # The texts cross the one shuffle packed, and are unpacked batch by batch where they are read.
    rows = (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
            .mapInArrow(packed, "doc_id long, tie long, text binary")
            .repartitionByRange("doc_id", "tie", F.monotonically_increasing_id()).sortWithinPartitions("doc_id", "tie"))
    table = written(rows.mapInArrow(run, _SCHEMA + ", part int, edge string, text string"), "phrases")

    # The first row after each partition: two rows of every partition, joined on the partitions' numbers.
    first = table.where("edge = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("after"), F.col("fingerprint").alias("following"))
    parts = table.where("edge = 'first'").select("part")
    in_order = Window.orderBy("part")
    order_parts = parts.select("part", F.coalesce(
        F.lead("part").over(in_order), F.first("part").over(in_order)).alias("next_part"))
    last = (table.where("edge = 'last'").select("part", "doc_id", "text", "fingerprint")
            .join(order_parts, "part").join(first, "next_part").select("doc_id", "text", "fingerprint", "after",
                                                                     "following"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            cols = _rows(d["doc_id"], d["text"], d["after"], from_text(d["fingerprint"]), from_text(d["following"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)

    return table.where("edge IS NULL").select(*_NAMES).unionByName(last.mapInArrow(finish, _SCHEMA))
