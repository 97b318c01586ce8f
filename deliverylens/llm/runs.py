"""Periodic runs of words, found by seeds that are extended along diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length >= max(`LEAST`, 2 q) that neither neighbour extends.
On the diagonal of lag q (position against position + q) a run is a stretch of
equal words of length >= max(`LEAST` - q, q). Lags are taken in bands: below
`LEAST`, where that overlap is at least `LEAST` / 2, and then from k to 2 k for
k = `LEAST`, 2 `LEAST`, ..., where it is at least k. In each band

* the k-grams of that guaranteed length are indexed and the pairs of positions
  of one k-gram in one document whose distance lies in the band are enumerated;
* a pair is a seed and is extended to both sides along its diagonal; a table of
  the furthest covered position of each lag skips seeds on a stretch that has
  been extended before;
* a stretch as long as its lag is a run; where the same stretch has more than
  one lag the least is its period.

Without care a word repeated n times has n * n pairs. A k-gram that has a
period of k / 2 or less lies in a run of an earlier band, and a longer run
through it must begin or end its diagonal where such a run begins (else two
runs of one period would join); so only first positions of these runs are
paired, pairs inside one of them, whose lags are multiples of its period, are
left out, and of pairs between two only those are extended whose stretch is
long enough or goes on past an end that the two share. All other k-grams occur at most four times within 2 k words. The
pairs of a text thus stay in proportion to its length times the number of
bands, however repetitive it is.

All documents of an Arrow batch are searched as one array of word numbers with
separators between them, in pieces of about `CHARS` characters, so a task holds
one piece or one long text at a time. Nothing crosses documents: no shuffle.

Defined cases: null, empty and blank texts have no words and no runs; a null id
leaves the text as it is where `digests` prepares texts by id; equal texts with
equal ids give equal rows, rows are never merged; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_tasks, text_chunks

LEAST = 12
CHARS = 2_000_000


# ---------------------------------------------------------------- seeds

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of every j from low[i] to high[i] - 1."""
    n = np.maximum(high - low, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + low[i]


class _Grams:
    """The positions of the k-grams that occur more than once, ordered by gram and position."""

    def __init__(self, codes: np.ndarray, at: np.ndarray, size: int):
        for shift in (0, 24):  # most grams are alone in a table of their hashes: only the others are sorted
            if len(codes):
                slot = ((codes >> np.uint64(shift)) & np.uint64((1 << 20) - 1)).astype(np.int64)
                crowded = np.bincount(slot, minlength=1 << 20)[slot] > 1
                codes, at = codes[crowded], at[crowded]
        order = np.argsort(codes, kind="stable")
        codes, at = codes[order], at[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = codes[1:] != codes[:-1]
        gram = np.cumsum(fresh) - 1
        again = np.bincount(gram, minlength=1)[gram] > 1 if len(gram) else np.zeros(0, bool)
        self.size, self.at, self.gram = size + 1, at[again], gram[again]
        self.keys = self.gram * self.size + self.at  # ascending

    def pairs(self, of: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(x, y) positions of one gram, x among ``of`` (indexes), with least <= y - x < most (either sign)."""
        x, base = self.at[of], self.gram[of] * self.size
        low = np.searchsorted(self.keys, base + np.clip(x + least, 0, self.size - 1))
        high = np.searchsorted(self.keys, base + np.clip(x + most, 0, self.size - 1))
        i, j = _ranges(low, high)
        return x[i], self.at[j]


def _stretch(words: np.ndarray, x: int, lag: int) -> tuple[int, int]:
    """First and past-the-last position of the equal words around ``x`` on the diagonal of ``lag``."""
    end, step = x, 64
    while True:
        a, b = words[end: end + step], words[end + lag: end + lag + step]
        off = np.flatnonzero(a[: len(b)] != b)
        if len(off):
            end += int(off[0])
            break
        end += len(b)
        if len(b) < step:
            break
        step *= 2
    start, step = x, 64
    while start > 0:
        low = max(0, start - step)
        off = np.flatnonzero(words[low:start] != words[low + lag: start + lag])
        if len(off):
            start = low + int(off[-1]) + 1
            break
        start, step = low, step * 2
    return start, end


def _extended(words: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, lag) of each stretch around a seed, once."""
    lag = y - x
    order = np.lexsort((x, lag))
    x, lag = x[order], lag[order]
    first = np.ones(len(x), bool)  # seeds one word apart lie on one stretch
    first[1:] = (lag[1:] != lag[:-1]) | (x[1:] > x[:-1] + 1)
    covered: dict[int, int] = {}
    out = []
    for p, q in zip(x[first].tolist(), lag[first].tolist()):
        if p < covered.get(q, -1):
            continue
        start, end = _stretch(words, p, q)
        covered[q] = end
        out.append((start, end, q))
    return out


def find_runs(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(start, end, period) rows, end exclusive, of the runs in ``words``.

    ``words``: numbers of the words of many documents, each document followed
    by a number that occurs nowhere else; ``doc``: the document of each place.
    """
    size = len(words)
    best: dict[tuple[int, int], int] = {}
    if size < LEAST:
        return np.zeros((0, 3), np.int64)
    k = LEAST // 2
    codes = _mixed(words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _mixed(doc.astype(np.uint64)))
    grams = np.zeros(size - k + 1, np.uint64)
    for i in range(k):
        grams = _mixed(grams) + codes[i: i + len(grams)]
    found = _Grams(grams, np.arange(len(grams)), size)
    everyone = np.arange(len(found.at))
    seeds = found.pairs(everyone, 1, LEAST)
    lags = (1, LEAST)
    while True:
        near = doc[seeds[0]] == doc[seeds[1]]
        for start, end, q in _extended(words, seeds[0][near], seeds[1][near]):
            if end - start >= max(LEAST - q, q):
                span = (start, end + q)
                best[span] = min(q, best.get(span, q))
        k_next = lags[1]
        if not len(found.at) or 2 * k_next > size:
            break
        # Codes of the next grams, at places whose gram occurred again: two of the last ones in a row.
        held = np.zeros(size + 1, np.uint64)
        held[found.at] = _mixed(found.gram.astype(np.uint64) + np.uint64(1))
        at = found.at[(found.at + k_next <= size)]
        both = held[np.minimum(at + (k_next - k), size)]
        at, both = at[both != 0], both[both != 0]
        codes = _mixed(held[at]) + both
        k = k_next
        found = _Grams(codes, at, size)
        seeds = _band(found, best, k)
        lags = (k, 2 * k)
    rows = np.array([(a, b, q) for (a, b), q in best.items()], np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _band(found: _Grams, best: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of lags from k to 2 k - 1: pairs of k-grams, of periodic ones only those with a run's first place."""
    spans = np.array([(a, b) for (a, b), q in best.items() if 2 * q <= k <= b - a], np.int64).reshape(-1, 2)
    if not len(spans):
        return found.pairs(np.arange(len(found.at)), k, 2 * k)
    # The run of period k / 2 or less that holds the gram at each place: there is one at most.
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    inside = np.searchsorted(spans[:, 0], found.at, side="right") - 1
    holds = (inside >= 0) & (found.at + k <= spans[np.maximum(inside, 0), 1])
    run = np.where(holds, inside, -1)
    first = holds & (found.at == spans[np.maximum(inside, 0), 0])
    ahead = found.pairs(np.flatnonzero(~holds | first), k, 2 * k)
    back = found.pairs(np.flatnonzero(first), 1 - 2 * k, 1 - k)
    x, y = np.concatenate([ahead[0], back[1]]), np.concatenate([ahead[1], back[0]])
    where = np.full(found.size, -1, np.int64)
    where[found.at] = run
    a, b = where[x], where[y]
    keep = (a < 0) | (a != b)
    x, y, a, b = x[keep], y[keep], a[keep], b[keep]
    # Between two runs of one period the stretch ends where either does, unless both do: no need to walk it.
    lag, known = y - x, (a >= 0) & (b >= 0)
    here, there = spans[a], spans[b] - lag[:, None]
    short = np.minimum(here[:, 1], there[:, 1]) - np.maximum(here[:, 0], there[:, 0]) < lag
    keep = ~(known & short & (here != there).all(axis=1))
    return x[keep], y[keep]


# ---------------------------------------------------------------- documents

Prepare = Callable[[object, list], list]


def periodic(doc_id: int | None, words: list) -> list:
    """The words of a document, every tenth (by crc32 of its id) made periodic from a place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, cycle = words[:a], words[a: a + p]
    return head + (cycle * (-(-(n - a) // p)))[: n - a]


def searched(ids: Sequence, texts: Sequence[str | None],
             prepare: Prepare | None = None) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words, and the runs as (start, length, period) by start and period, of each text."""
    for first, part in text_chunks(texts, CHARS):
        numbers: dict[bytes, int] = {}
        listed, flat = [], []
        for i, t in enumerate(part):
            words = t.encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only
            words = prepare(ids[first + i], words) if prepare else words
            listed.append(words)
            flat += [numbers.setdefault(w, len(numbers)) for w in words]
            flat.append(-1)
        x = np.array(flat, np.int64)
        gaps = np.flatnonzero(x < 0)
        x[gaps] = len(numbers) + np.arange(len(gaps))
        starts = np.concatenate(([0], gaps[:-1] + 1))
        doc = np.repeat(np.arange(len(part)), gaps - starts + 1)
        runs = find_runs(x, doc)
        owner = doc[runs[:, 0]]
        for i, words in enumerate(listed):
            low, high = np.searchsorted(owner, [i, i + 1])
            own = runs[low:high]
            yield words, np.column_stack([own[:, 0] - starts[i], own[:, 1] - own[:, 0], own[:, 2]])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """doc_id, runs (start, length, period) and collapsed text of every row of (doc_id, text)."""
    arrow_tasks(docs.sparkSession)
    span = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs, texts = [], []
            for words, own in searched(b["doc_id"].to_pylist(), b["text"].to_pylist(), prepare):
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own.tolist()])
                texts.append(collapsed(words, own).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(runs, pa.list_(span)), pa.array(texts, pa.string())],
                                             ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(docs: DataFrame, prepare: Prepare | None = periodic) -> DataFrame:
    """Run count, longest run and digests of runs and collapsed text of every row of (doc_id, text)."""
    arrow_tasks(docs.sparkSession)
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")

    def row(words: list[bytes], runs: np.ndarray) -> tuple:
        if len(runs):
            start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
            longest = (start, length, period, 1000 * length // period)
        else:
            longest = (None,) * 4
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs.tolist())
        return (len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(collapsed(words, runs)).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.string()] * 2
        for b in batches:
            rows = [row(*x) for x in searched(b["doc_id"].to_pylist(), b["text"].to_pylist(), prepare)]
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c, t) for c, t in zip(cols, types)]], list(names))

    schema = ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
