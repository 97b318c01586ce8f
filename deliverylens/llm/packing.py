"""Best-fit packing of tokenized documents after Martello-Toth dominance reduction.

Lengths are whole numbers from 1 to the sequence length, so the whole packing
instance is the count of pieces of each length: at most as many rows as a
sequence has tokens, whatever the number of documents. Spark tokenizes, counts
and ranks; the driver solves the counted instance and returns rules of the
form "pieces of this length with these ranks go to these sequences"; Spark
applies them to every piece. No piece, id or text passes through the driver.

The solver first fixes sequences that provably dominate all others that hold
the same longest piece: any packing can be changed to use them without more
sequences. What is left is packed best-fit in order of decreasing length.

Defined cases: a null text counts as empty, and an empty text is one piece
that holds the end id alone; only documents longer than a sequence are cut,
and a cut leaves its last piece as long as it happens to be; repeated rows are
packed each; null ids are kept; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import BoundedCache, arrow_tasks, written

SEQUENCE = 4096
END_ID = 1
CACHE_WORDS = 250_000
STRETCH = 1_000_000
_BLANK = re.compile(r"[\t-\r ]")
_RUNS = re.compile(r"[^\t-\r ]+")
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
# Fixed value: the vocabulary file's word pattern, for texts of _PLAIN characters in lower case.
_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


# ---------------------------------------------------------------- tokens

class Tokens:
    """Ids of whole texts by a vocabulary file (lower case, words that never span white space).

    A text of ASCII and Latin-1 letters, for which lower case and composition
    need no tables, is cut into words here and each distinct word is merged by
    the library's model once while it stays in the cache. A stretch with any
    other character goes to the library run by run of non-blanks.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        stand_in = {b: c for c, b in byte_alphabet().items()}
        self.bytes = [stand_in[b] for b in range(256)]
        model = self.library.model

        def merge(word: str) -> tuple[int, ...]:
            text = word if word.isascii() else "".join([self.bytes[b] for b in word.encode()])
            return tuple([t.id for t in model.tokenize(text)])

        self.words = BoundedCache(merge, CACHE_WORDS)
        self.runs = BoundedCache(lambda run: tuple(self.library.encode(run, add_special_tokens=False).ids), CACHE_WORDS)

    def encode(self, text: str | None) -> array:
        ids = array("I")
        for part in _stretches(text or ""):
            if _PLAIN.fullmatch(part) and not any(s in part for s in self.special):
                found, known = _WORDS.findall(part.lower()), self.words
            else:
                found, known = _RUNS.findall(part), self.runs
            ids.extend(chain.from_iterable(map(known.__getitem__, found)))
        return ids


def _stretches(text: str) -> Iterator[str]:
    """The text in stretches of bounded length, cut at blanks only."""
    start = 0
    while len(text) - start > STRETCH:
        blank = _BLANK.search(text, start + STRETCH)
        if blank is None:
            break
        yield text[start: blank.start()]
        start = blank.start()
    yield text[start:] if start else text


@lru_cache(maxsize=2)
def load(path: str) -> Tokens:
    """The tokenizer of a file, once for each worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokens(path)


def pieces(docs: DataFrame, vocabulary: str, cap: int = SEQUENCE, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with its place among its task's pieces of that length.

    ``part`` and ``nth`` are that place; they mean something only once the result is written.
    """
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, part = load(vocabulary), defaultdict(int), TaskContext.get().partitionId()
        for b in batches:
            out = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                ids = tokens.encode(text)
                ids.append(end_id)
                ids = np.array(ids, dtype="<u4")
                for k, start in enumerate(range(0, len(ids), cap)):
                    mine = ids[start: start + cap]
                    out.append((doc_id, k, start, len(mine), zlib.crc32(mine.tobytes()), part, seen[len(mine)],
                                mine.tolist() if with_ids else None))
                    seen[len(mine)] += 1
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids array<int>")


# ---------------------------------------------------------------- the counted instance

class Packing:
    """Sequences for ``left[w]`` pieces of each length w; rules in ``rules``."""

    def __init__(self, counts: dict[int, int], cap: int):
        self.cap, self.left, self.used = cap, dict(counts), defaultdict(int)
        self.sizes = sorted(w for w, n in counts.items() if n)
        self.sequences = 0
        self.fixed = 0
        #: (length, first rank, pieces in a sequence, first sequence, offset of the first)
        self.rules: list[tuple[int, int, int, int, int]] = []

    def emit(self, pattern: list[tuple[int, int]], times: int) -> None:
        """``times`` sequences that hold k pieces of length w for each (w, k)."""
        offset = 0
        for w, k in pattern:
            self.rules.append((w, self.used[w], k, self.sequences, offset))
            self.used[w] += times * k
            offset += w * k
        self.sequences += times

    # -- dominance

    def largest(self, room: int, without: tuple[int, ...] = ()) -> int | None:
        """The longest piece of at most ``room``, not counting the pieces ``without``."""
        i = bisect.bisect_right(self.sizes, room)
        while i:
            i -= 1
            if self.left[self.sizes[i]] > without.count(self.sizes[i]):
                return self.sizes[i]
        return None

    def smallest(self, n: int, above: int, without: int) -> list[int]:
        """The ``n`` shortest pieces longer than ``above``, not counting one piece ``without``."""
        out: list[int] = []
        for i in range(bisect.bisect_right(self.sizes, above), len(self.sizes)):
            w = self.sizes[i]
            out += [w] * min(n - len(out), self.left[w] - (w == without))
            if len(out) == n:
                break
        return out

    def dominating(self, j: int) -> list[int] | None:
        """Pieces beside j in a set that dominates every other feasible set with j; None if none is proved."""
        room = self.cap - j
        one = self.largest(room, (j,))
        if one is None:
            return []
        if one == room:
            return [one]  # whatever else stands beside j is no longer than this in all
        low = self.smallest(3, 0, j)
        if len(low) < 2 or low[0] + low[1] > room:
            return [one]  # no two fit
        if len(low) == 3 and sum(low) <= room:
            return None  # three may fit: nothing is proved
        most = 0
        for a in reversed(self.sizes[: bisect.bisect_right(self.sizes, room)]):
            if 2 * a < most:
                break
            if self.left[a] > (a == j) and (b := self.largest(min(a, room - a), (j, a))) is not None:
                most = max(most, a + b)
        if one >= most:
            return [one]  # longer than any two that fit together
        two = self.largest(room - one, (j, one))
        if two is not None:
            more = self.smallest(2, two, j)
            if len(more) < 2 or sum(more) > room:
                return [one, two]  # of any two that fit, the shorter is no longer than this
        return None

    def take(self, pattern: dict[int, int]) -> None:
        times = min(self.left[w] // k for w, k in pattern.items())
        self.emit(sorted(pattern.items(), reverse=True), times)
        self.fixed += times
        for w, k in pattern.items():
            self.left[w] -= times * k
            if not self.left[w]:
                del self.sizes[bisect.bisect_left(self.sizes, w)]

    def reduce(self) -> None:
        """Fix dominating sets until none is found."""
        changed = True
        while changed:
            changed = False
            for j in reversed(self.sizes[:]):
                while self.left[j] and (beside := self.dominating(j)) is not None:
                    pattern: dict[int, int] = defaultdict(int)
                    for w in (j, *beside):
                        pattern[w] += 1
                    self.take(pattern)
                    changed = True

    # -- best fit

    def best_fit(self) -> None:
        """Pack what is left, longest first, each piece into the fullest sequence that has room."""
        open_: dict[int, list[tuple[int, list]]] = defaultdict(list)  # room: (number of sequences, pattern)
        rooms: list[int] = []

        def put(room: int, times: int, pattern: list) -> None:
            if times and room:
                if not open_[room]:
                    bisect.insort(rooms, room)
                open_[room].append((times, pattern))
            elif times:
                self.emit(pattern, times)

        for w in reversed(self.sizes[:]):
            n, self.left[w] = self.left[w], 0
            while n:
                at = bisect.bisect_left(rooms, w)
                if at < len(rooms):
                    room = rooms[at]
                    times, pattern = open_[room].pop()
                    if not open_[room]:
                        rooms.pop(at)
                else:
                    room, times, pattern = self.cap, -(-n // (self.cap // w)), []
                each = room // w
                full = min(times, n // each)
                rest = 0 if full == times else n - full * each
                put(room - each * w, full, pattern + [(w, each)])
                if rest:
                    put(room - rest * w, 1, pattern + [(w, rest)])
                if pattern:
                    put(room, times - full - bool(rest), pattern)
                n -= full * each + rest
        for room in list(rooms):
            for times, pattern in open_[room]:
                self.emit(pattern, times)
        self.sizes = []


def solve(counts: dict[int, int], cap: int = SEQUENCE) -> Packing:
    packing = Packing({w: n for w, n in counts.items() if n}, cap)
    packing.reduce()
    packing.best_fit()
    return packing


# ---------------------------------------------------------------- Spark

def pack(docs: DataFrame, vocabulary: str, cap: int = SEQUENCE, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Every piece of (doc_id, text) with its sequence_id and its offset there; with its ids if asked."""
    table = written(pieces(docs, vocabulary, cap, end_id, with_ids), "pieces")
    counts = table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most cap rows
    rules = sorted(solve({r.length: r.n for r in histogram}, cap).rules)
    length, first, each, sequence, offset = (np.array(c, np.int64) for c in (zip(*rules) if rules else [[]] * 5))
    key = (length << 44) + first

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = np.searchsorted(key, (size << 44) + rank, side="right") - 1
            nth = rank - first[at]
            b = b.append_column("sequence_id", pa.array(sequence[at] + nth // each[at], pa.int64()))
            yield b.append_column("offset", pa.array(offset[at] + nth % each[at] * size, pa.int64()))

    cols = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = (table.join(counts.select("part", "length", "base").hint("merge"), ["part", "length"])
              .select(*cols, (F.col("base") + F.col("nth")).alias("rank")))
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(assign, schema).drop("rank")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts) of a packing made with its ids; a sequence is at most ``cap`` tokens."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(held.alias("held"))
            .select("sequence_id", F.flatten("held.ids").alias("ids"), F.col("held.offset").alias("starts")))
