"""Secret scan: fixed patterns, and a character convolutional network over further candidates.

The patterns (`PATTERNS`) always count. A candidate is every run of key
characters, or what pattern spans leave uncovered of one, that is as long as the
shortest value the patterns count (`ASSIGN_LEAST`). A text is convolved once;
a candidate's score comes from the maxima of the filters over its whole body,
over `BEFORE` characters before it and `AFTER` after it. Of windows only those to
start from are stored: each pass over the texts lays them out anew.

The network is trained in numpy on labelled findings: candidates that the
patterns confirm are secrets, candidates they do not are not. It is meant to
find secrets in places that no pattern names, so half of all training rows, and
all rows that it is judged on, have the text around them exchanged for that
around another candidate that is not a secret; the patterns' key words and
quotes go with it. `FOLDS` networks each learn from every candidate of every text,
however long, that is not of one fold (by a hash of the window), and each candidate
is scored by the network that did not see its fold. On all these scores a logistic
curve is fitted, so that the score of a span is the chance that it is a secret; the
threshold is the highest chance that still finds `RECALL` of the secrets. The folds'
mean is the network that scores the texts, and the recall measured in this way
stands in `Model.report`.

Learning is spread over the tasks (iterative parameter mixing): each goes over its
texts once, all from one start, and the networks of the tasks are averaged by the
candidates that they saw. Averaging needs a start close enough to the end; it is a
network trained on at most `SAMPLE` distinct windows of each label, the least by a
hash, of candidates of at most `SAMPLE_CHARS` characters. Those of them that are
secrets also fill up each batch, in which secrets would else be rare. The sample
decides nothing else: counts, curve and threshold are those of all candidates.

Defined cases: null and empty texts have no spans; equal texts score alike, so
copies and repeated rows agree; where a fold lacks one of the two labels (fewer
than `FOLDS` distinct secrets, say) nothing is added to the patterns; null ids
are kept; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_tasks, hash_sample, numbered, text_chunks, written

KINDS = ("assign", "access", "hex", "learned")
# The contract's patterns and least lengths. A hex or access match is a whole
# run, so its least length may stand in the pattern; a short assignment still uses up its text.
PATTERNS = (
    re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
               re.IGNORECASE | re.ASCII),
    re.compile(r"AKIA[A-Z0-9]{16,}"),
    re.compile(r"[0-9a-f]{24,}"),
)
ASSIGN_LEAST = 6
_KEY_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"

BEFORE, AFTER = 24, 8
SAMPLE, SAMPLE_CHARS = 4000, 512
RECALL = 0.99
FOLDS = 3
#: Characters laid out together, and convolved at a time.
CHARS, BLOCK = 400_000, 16_384
#: Rows of a training step, how many of them to one that is filled up, and the step's size.
BATCH, FILL, RATE = 4096, 16, 0.001
#: Places of a body that are convolved together when training; a power of two.
PIECE = 64
#: Steps of a logit that are told apart when the scores of all candidates are counted.
LOGIT_STEP = 1 / 1000


# ---------------------------------------------------------------- spans

def pattern_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed patterns, by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in PATTERNS[0].finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in PATTERNS[1].finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in PATTERNS[2].finditer(text)]
    return sorted(out)


# One class a character: 0 nothing there, 1 blank or control, 2 not ASCII, else the character.
_CLASS = np.full(129, 2, np.uint8)
_CLASS[:33], _CLASS[33:127], _CLASS[127] = 1, np.arange(33, 127), 1
_IS_KEY = np.zeros(128, bool)
_IS_KEY[[ord(c) for c in _KEY_CHARACTERS]] = True
HALF = 2
_LEAD, _TAIL = BEFORE + HALF, AFTER + HALF


class Layout:
    """Some texts as one array of classes with nothing between them, their pattern spans and their candidates.

    ``start``, ``end``: places of the candidates in ``classes``, ascending by start; ``known``: confirmed by a pattern.
    """

    def __init__(self, texts: list[str]):
        gap = max(_LEAD, _TAIL)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.at = gap + np.concatenate(([0], np.cumsum(sizes[:-1] + gap))) if len(texts) else np.zeros(0, np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.arange(len(points)) + np.repeat(self.at - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        self.classes = np.zeros(int(sizes.sum()) + gap * (len(texts) + 1), np.uint8)
        self.classes[place] = _CLASS[np.minimum(points, 128)]
        self.bases = [pattern_spans(t) for t in texts]
        free = _IS_KEY[self.classes]
        known = set()
        for at, base in zip(self.at.tolist(), self.bases):
            for start, _, end, value in base:
                free[at + start: at + end] = False
                known.add((at + value, at + end))
        turns = np.flatnonzero(np.diff(free))
        runs = (turns + 1).reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= ASSIGN_LEAST]
        found = np.concatenate([runs, np.array(sorted(known), np.int64).reshape(-1, 2)])
        is_known = np.arange(len(found)) >= len(runs)
        order = np.lexsort((is_known, found[:, 1], found[:, 0]))
        self.start, self.end, self.known = found[order, 0], found[order, 1], is_known[order]

    def spans(self, which: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, start, end) of the candidates ``which``, as places in their texts."""
        owner = np.searchsorted(self.at, self.start[which], side="right") - 1
        return list(zip(owner.tolist(), (self.start[which] - self.at[owner]).tolist(),
                        (self.end[which] - self.at[owner]).tolist()))

    def window(self, i: int) -> bytes:
        """The characters of candidate ``i`` and around it, as far as the network sees."""
        return self.classes[self.start[i] - _LEAD: self.end[i] + _TAIL].tobytes()


def laid_out(texts: list[str | None]) -> Iterator[tuple[int, Layout]]:
    """(first index, layout) of consecutive texts of about `CHARS` characters."""
    for first, part in text_chunks(texts, CHARS):
        yield first, Layout(part)


# ---------------------------------------------------------------- network

def _maxima(conv: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Row maxima of the (not empty, ascending, disjoint) stretches low to high - 1 of ``conv``."""
    bounds = np.column_stack([low, high]).ravel()
    return np.maximum.reduceat(conv, bounds[:-1] if bounds[-1] == len(conv) else bounds, axis=0)[::2]


class CharCnn:
    """Embedding, one convolution, maxima before, in and after the candidate, one hidden layer, one logit."""

    EMBED, FILTERS, HIDDEN = 8, 16, 16
    WIDTH = 2 * HALF + 1

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        w, pooled = self.WIDTH * self.EMBED, self.FILTERS * 3
        self.p = {"e": r.normal(0, 0.5, (128, self.EMBED)), "k": r.normal(0, (2 / w) ** 0.5, (w, self.FILTERS)),
                  "kb": np.zeros(self.FILTERS), "h": r.normal(0, (2 / pooled) ** 0.5, (pooled, self.HIDDEN)),
                  "hb": np.zeros(self.HIDDEN), "o": r.normal(0, self.HIDDEN ** -0.5, self.HIDDEN), "ob": np.zeros(1)}

    def _forward(self, windows: list[np.ndarray]) -> tuple:
        """Of windows one after the other: inputs, their columns, places of the maxima, pooled, hidden, logits."""
        sizes = np.array([len(w) for w in windows])
        x = np.concatenate(windows)
        at = np.cumsum(sizes) - sizes
        cols = np.concatenate([self.p["e"][x[i: len(x) - self.WIDTH + 1 + i]] for i in range(self.WIDTH)], axis=1)
        conv = cols @ self.p["k"] + self.p["kb"]
        first = np.column_stack([at, at + BEFORE, at + sizes - 2 * HALF - AFTER, at + sizes - 2 * HALF])
        where = np.zeros((len(windows), 3, self.FILTERS), np.int64)
        n = np.arange(len(conv))[:, None]
        for r in range(3):
            low, high = first[:, r], first[:, r + 1]
            top = _maxima(conv, low, high)
            inside = np.repeat(np.arange(len(windows)), high - low)
            rows = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
            hit = np.where(conv[rows] == top[inside], n[rows], len(conv))
            where[:, r] = np.minimum.reduceat(hit, np.cumsum(high - low) - (high - low), axis=0)
        pooled = np.maximum(conv[where, np.arange(self.FILTERS)], 0).reshape(len(windows), -1)
        hidden = np.maximum(pooled @ self.p["h"] + self.p["hb"], 0)
        return x, cols, where, pooled, hidden, hidden @ self.p["o"] + self.p["ob"]

    def _gradient(self, windows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict:
        x, cols, where, pooled, hidden, logit = self._forward(windows)
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / weight.sum()
        g = {"o": hidden.T @ d, "ob": d.sum(keepdims=True)}
        dh = np.outer(d, self.p["o"]) * (hidden > 0)
        g |= {"h": pooled.T @ dh, "hb": dh.sum(axis=0)}
        dp = ((dh @ self.p["h"].T) * (pooled > 0)).reshape(len(windows), 3, self.FILTERS)
        g |= {"k": np.zeros_like(self.p["k"]), "kb": dp.sum(axis=(0, 1)), "e": np.zeros_like(self.p["e"])}
        for r in range(3):
            at, part = where[:, r], dp[:, r]  # rows, filters
            g["k"] += np.einsum("nfi,nf->if", cols[at], part)
            back = (part[:, :, None] * self.p["k"].T[None]).reshape(len(windows), self.FILTERS, self.WIDTH, self.EMBED)
            for i in range(self.WIDTH):
                np.add.at(g["e"], x[at + i], back[:, :, i])
        return g

    def _pooled(self, rows: Rows, near: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """The maxima (row, region, filter), not below 0, and the characters (in reach) they come from."""
        w = self.EMBED
        table = np.stack([self.p["e"] @ self.p["k"][i * w: (i + 1) * w] for i in range(self.WIDTH)])
        table[-1] += self.p["kb"]
        table = table.astype(np.float32)  # offset, character, filter
        top = np.zeros((rows.n, 3, self.FILTERS), np.float32)
        seen = np.zeros((self.WIDTH, rows.n, 3, self.FILTERS), np.intp) if near else None

        def put(who: slice | np.ndarray, region: int, found: tuple) -> None:
            top[who, region] = found[0]
            if near:
                seen[:, who, region] = found[1]

        put(slice(None), 0, _tops(table, rows.before, None, near))
        put(slice(None), 2, _tops(table, rows.after, None, near))
        if len(rows.order):
            put(rows.order, 1, _tops(table, rows.bodies, rows.sizes, near))
        f, step = np.arange(self.FILTERS), max(1, BLOCK // PIECE)
        for j, chars, size in rows.long:
            for i in range(0, len(chars), step):
                value, found = _tops(table, chars[i: i + step].T, size[i: i + step], near)
                best = value.argmax(axis=0)
                more = value[best, f] > top[j, 1]
                if near:
                    seen[:, j, 1, more] = found[:, best, f][:, more]
                top[j, 1] = np.maximum(top[j, 1], value[best, f])
        return top, seen

    def row_logits(self, rows: Rows) -> np.ndarray:
        pooled = self._pooled(rows, near=False)[0].reshape(rows.n, -1)
        return np.maximum(pooled @ self.p["h"] + self.p["hb"], 0) @ self.p["o"] + self.p["ob"]

    def row_gradient(self, rows: Rows, y: np.ndarray, weight: np.ndarray) -> dict:
        """What :meth:`_gradient` gives, from the characters at the maxima alone."""
        top, near = self._pooled(rows)
        pooled = top.reshape(rows.n, -1)
        hidden = np.maximum(pooled @ self.p["h"] + self.p["hb"], 0)
        logit = hidden @ self.p["o"] + self.p["ob"]
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / weight.sum()
        g = {"o": hidden.T @ d, "ob": d.sum(keepdims=True)}
        dh = np.outer(d, self.p["o"]) * (hidden > 0)
        g |= {"h": pooled.T @ dh, "hb": dh.sum(axis=0)}
        dp = ((dh @ self.p["h"].T) * (pooled > 0)).reshape(-1, self.FILTERS)
        g |= {"k": np.zeros_like(self.p["k"]), "kb": dp.sum(axis=0), "e": np.zeros_like(self.p["e"])}
        w, filters, dp = self.EMBED, np.arange(self.FILTERS), dp.ravel()
        for i in range(self.WIDTH):
            at = near[i] * self.FILTERS
            at += filters
            table = np.bincount(at.ravel(), dp, 128 * self.FILTERS).reshape(128, self.FILTERS)
            part = slice(i * w, (i + 1) * w)
            g["k"][part] = self.p["e"].T @ table
            g["e"] += table @ self.p["k"][part].T
        return g

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def set_flat(self, values: np.ndarray) -> CharCnn:
        ends = np.cumsum([self.p[k].size for k in sorted(self.p)])
        for k, part in zip(sorted(self.p), np.split(values, ends[:-1])):
            self.p[k] = part.reshape(self.p[k].shape).copy()
        return self

    def fit(self, windows: list[np.ndarray], y: np.ndarray, lends: list[np.ndarray], epochs: int = 10,
            batch: int = 128, seed: int = 11) -> CharCnn:
        """Adam; half of the rows of each batch get the surroundings of one of ``lends``."""
        r = np.random.default_rng(seed)
        weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
        adam = Adam(self)
        for _ in range(epochs):
            order = r.permutation(len(windows))
            for i in range(0, len(windows), batch):
                who = order[i: i + batch]
                swap, give = r.random(len(who)) < 0.5, r.integers(0, len(lends), len(who))
                seen = [lent(windows[j], lends[b]) if s else windows[j] for j, s, b in zip(who, swap, give)]
                adam.step(self._gradient(seen, y[who].astype(float), weight[who]), 0.004)
        return self


class Adam:
    def __init__(self, net: CharCnn):
        self.p, self.n = net.p, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def step(self, gradient: dict, rate: float) -> None:
        self.n += 1
        for k, g in gradient.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.p[k] -= (rate * (self.m[k] / (1 - 0.9 ** self.n))
                          / (np.sqrt(self.v[k] / (1 - 0.999 ** self.n)) + 1e-8))


class Rows:
    """The candidates ``which`` of an array of classes, in the surroundings of ``give``, as the convolution sees them.

    ``before``, ``after``: the characters, one column a row; ``bodies``: the same of the rows ``order``, the longest
    first, with their ``sizes``; ``long``: of single rows longer than `PIECE`, cut into pieces that overlap by the reach.
    """

    def __init__(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray, which: np.ndarray, give: np.ndarray):
        a, b = start[give], end[give]
        start, end = start[which], end[which]
        self.n, size = len(start), end - start
        reach, lead, tail = np.arange(HALF)[:, None], np.arange(-_LEAD, 0)[:, None], np.arange(_TAIL)[:, None]
        self.before = np.concatenate([flat[a + lead], flat[start + reach]])
        self.after = np.concatenate([flat[end - HALF + reach], flat[b + tail]])
        order = np.argsort(-size, kind="stable")
        self.order = order = order[np.count_nonzero(size > PIECE):]
        self.sizes = sizes = size[order]
        if len(order):
            span = np.arange(int(sizes[0]) + 2 * HALF)[:, None] - HALF
            self.bodies = flat[np.minimum(start[order] + span, len(flat) - 1)]
            self.bodies[:HALF] = flat[a[order] - HALF + reach]
            np.put_along_axis(self.bodies, sizes + HALF + reach, flat[b[order] + reach], axis=0)
        self.long = []
        for j in np.flatnonzero(size > PIECE).tolist():
            pieces = -(-size[j] // PIECE)
            line = np.concatenate([flat[a[j] - HALF: a[j]], flat[start[j]: end[j]], flat[b[j]: b[j] + HALF],
                                   np.zeros(pieces * PIECE - size[j], np.uint8)])
            chars = np.lib.stride_tricks.sliding_window_view(line, PIECE + 2 * HALF)[::PIECE]
            self.long.append((j, chars, np.minimum(PIECE, size[j] - PIECE * np.arange(pieces))))


def _tops(table: np.ndarray, chars: np.ndarray, sizes: np.ndarray | None = None, near: bool = True
          ) -> tuple[np.ndarray, np.ndarray | None]:
    """(row, filter) the greatest value, not below 0, of the first ``sizes`` (descending) places, and the characters
    it comes from. Numbers that are not negative sort as their bits do; the last six bits are given to the place."""
    n, places = chars.shape[1], chars.shape[0] - 2 * HALF
    x = chars.astype(np.intp)
    best = np.zeros((n, table.shape[2]), np.int32)
    conv, part = np.empty((2, n, table.shape[2]), np.float32)
    for p in range(places):
        k = n if sizes is None else int(np.searchsorted(-sizes, -p))
        c, d = conv[:k], part[:k]
        np.take(table[0], x[p, :k], axis=0, out=c, mode="clip")
        for i in range(1, len(table)):
            c += np.take(table[i], x[p + i, :k], axis=0, out=d, mode="clip")
        bits = c.view(np.int32)
        bits &= -PIECE
        bits |= PIECE - 1 - p
        np.maximum(best[:k], bits, out=best[:k])
    top = (best & -PIECE).view(np.float32)
    if not near:
        return top, None
    at = np.minimum(PIECE - 1 - (best & (PIECE - 1)), places - 1).astype(np.intp) * n + np.arange(n)[:, None]
    return top, np.stack([np.take(x.ravel(), at + i * n) for i in range(len(table))])


class Scorer:
    """The networks side by side, convolving by look-up in 16-bit steps: exact, thus alike wherever a window stands.

    Convolving a character is adding what the pairs and the single character within reach give to each filter.
    Maxima over 2, 4, 8 and 16 places come from maxima over half as many; two of them cover any stretch up to 31.
    """

    def __init__(self, nets: list[CharCnn]):
        self.nets, w = nets, CharCnn.EMBED
        t = np.concatenate([[net.p["e"] @ net.p["k"][i * w: (i + 1) * w] for i in range(CharCnn.WIDTH)]
                            for net in nets], axis=2)  # offset, character, filter
        t[-1] += np.concatenate([net.p["kb"] for net in nets])
        self.scale = 32_000 / np.abs(t).max(axis=1).sum(axis=0).clip(1e-9)
        t = np.floor(t * self.scale).astype(np.int16)
        self.pairs = [(t[i][:, None] + t[i + 1][None]).reshape(-1, t.shape[2]) for i in (0, 2)]
        self.last = t[4]

    def logits(self, classes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The mean logit of each of the disjoint, ascending candidates; ``classes`` go through block by block."""
        x = classes.astype(np.int64)
        pairs = x[:-1] * 128 + x[1:]
        pooled = np.full((len(start), 3, len(self.scale)), -32768, np.int16)
        stop = len(x) - HALF
        for a in range(HALF, stop, BLOCK):
            b = min(stop, a + BLOCK)
            if len(start) and end[-1] + AFTER > a and start[0] - BEFORE < b:
                self._block(pairs, x, a, b, start, end, pooled)
        flat = np.maximum(pooled, 0) / self.scale
        out = np.zeros(len(start))
        f = CharCnn.FILTERS
        for k, net in enumerate(self.nets):
            for i in range(0, len(start), 8192):
                part = flat[i: i + 8192, :, k * f: (k + 1) * f].reshape(-1, 3 * f)
                out[i: i + 8192] += np.maximum(part @ net.p["h"] + net.p["hb"], 0) @ net.p["o"] + net.p["ob"]
        return out / len(self.nets)

    def _block(self, pairs: np.ndarray, x: np.ndarray, a: int, b: int, start: np.ndarray, end: np.ndarray,
               pooled: np.ndarray) -> None:
        """Raise the maxima of all stretches that have places from ``a`` to ``b`` - 1."""
        conv = np.take(self.pairs[0], pairs[a - 2: b - 2], axis=0)
        conv += np.take(self.pairs[1], pairs[a: b], axis=0)
        conv += np.take(self.last, x[a + 2: b + 2], axis=0)
        over = [conv]  # over[k]: maxima over 2 ** k places
        for k in range(4):
            half = 1 << k
            if len(over[-1]) <= half:
                break
            over.append(np.maximum(over[-1][:-half], over[-1][half:]))
        for r, (low, high) in enumerate(((start - BEFORE, start), (start, end), (end, end + AFTER))):
            i, j = np.searchsorted(high, a, side="right"), np.searchsorted(low, b)
            if i >= j:
                continue
            lo, hi = np.maximum(low[i:j] - a, 0), np.minimum(high[i:j] - a, b - a)
            size = hi - lo
            level = np.minimum(np.frexp(size)[1] - 1, len(over) - 1)
            top = pooled[i:j, r]
            for k in range(len(over)):
                who = np.flatnonzero((level == k) & (size < 2 << k))
                if len(who):
                    best = np.maximum(over[k][lo[who]], over[k][hi[who] - (1 << k)])
                    top[who] = np.maximum(top[who], best)
            long = np.flatnonzero(size >= 2 << level)  # only bodies, which are disjoint
            if len(long):
                top[long] = np.maximum(top[long], _maxima(conv, lo[long], hi[long]))


def lent(window: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``window`` with what stands before and after the candidate exchanged for that of ``other``."""
    return np.concatenate([other[:_LEAD], window[_LEAD: len(window) - _TAIL], other[len(other) - _TAIL:]])


class Model:
    """The networks of all folds, the curve from their mean logit to a chance, and the threshold."""

    def __init__(self, nets: list[CharCnn], curve: tuple[float, float], threshold: float, report: dict):
        self.nets, self.curve, self.threshold, self.report = nets, curve, threshold, report
        self.scorer = Scorer(nets)

    def chances(self, layout: Layout, which: np.ndarray) -> np.ndarray:
        """The chance, to six digits, that each of the candidates ``which`` is a secret."""
        return chance(self.scorer.logits(layout.classes, layout.start[which], layout.end[which]), self.curve)


def chance(logit: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    return np.round(1 / (1 + np.exp(-np.clip(curve[0] * logit + curve[1], -30, 30))), 6)


def logistic_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of the chance 1 / (1 + exp(-a x - b)), by Newton's method; targets are kept off 0 and 1."""
    good, bad = weight[y].sum(), weight[~y].sum()
    t = np.where(y, (good + 1) / (good + 2), 1 / (bad + 2))
    rows = np.column_stack([x, np.ones(len(x))])
    c = np.array([1.0, np.log((good + 1) / (bad + 1))])

    def loss(c: np.ndarray) -> float:
        z = rows @ c
        return float((weight * (np.logaddexp(0, z) - t * z)).sum() + 1e-6 * c @ c)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ c, -30, 30)))
        g = rows.T @ (weight * (p - t)) + 2e-6 * c
        h = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 2e-6 * np.eye(2)
        step, now = np.linalg.solve(h, g), loss(c)
        while loss(c - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        c = c - step
        if np.abs(step).max() < 1e-8:
            break
    return float(c[0]), float(c[1])


def folds_of(windows: list[bytes]) -> np.ndarray:
    return np.array([_fold(window_hash(w)) for w in windows], np.int64)


def starts(windows: list[bytes], labels: list[bool]) -> list[CharCnn] | None:
    """A network for each fold, of the distinct labelled windows not in it; None where a fold lacks a label."""
    y, fold = np.array(labels, bool), folds_of(windows)
    if any(not ((fold == f) & (y == label)).any() for f in range(FOLDS) for label in (False, True)):
        return None
    rows = [np.frombuffer(w, np.uint8) for w in windows]
    nets = []
    for f in range(FOLDS):
        own = np.flatnonzero(fold != f)
        nets.append(CharCnn(seed=7 + f).fit([rows[i] for i in own], y[own], [rows[i] for i in own if not y[i]]))
    return nets


def judged(nets: list[CharCnn], logit: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float = RECALL) -> Model:
    """The model of the networks and of how many (``n``) candidates of each label have each logit."""
    curve = logistic_curve(logit, y, n.astype(float))
    found = chance(logit, curve)
    best = np.argsort(-found[y], kind="stable")
    secrets, others = int(n[y].sum()), int(n[~y].sum())
    threshold = float(found[y][best][np.searchsorted(np.cumsum(n[y][best]), int(np.ceil(recall * secrets)))])
    hit = found >= threshold
    report = {"secrets": secrets, "others": others, "threshold": threshold,
              "recall": float(n[hit & y].sum() / secrets), "others_hit": float(n[hit & ~y].sum() / others)}
    return Model(nets, curve, threshold, report)


def train(windows: list[bytes], labels: list[bool], recall: float = RECALL) -> Model | None:
    """The model of distinct labelled windows alone."""
    nets = starts(windows, labels)
    if nets is None:
        return None
    y, fold = np.array(labels, bool), folds_of(windows)
    logit, plain = np.zeros(len(y)), np.flatnonzero(~y)
    rows = [np.frombuffer(w, np.uint8) for w in windows]
    for f, net in enumerate(nets):
        judge = np.flatnonzero(fold == f)
        give = plain[np.random.default_rng(13 + f).integers(0, len(plain), len(judge))]
        seen = [lent(rows[j], rows[g]) for j, g in zip(judge, give)]
        ends = np.cumsum([len(w) for w in seen])
        logit[judge] = Scorer([net]).logits(np.concatenate(seen), ends - [len(w) for w in seen] + _LEAD, ends - _TAIL)
    return judged(nets, logit, y, np.ones(len(y)), recall)


# ---------------------------------------------------------------- Spark

_BASE = 0x9E3779B97F4A7C15
#: Parameters are added up as whole numbers of this size, so that their sum does not depend on the order.
_UNIT = 2.0 ** -40


def _hashes(layout: Layout) -> np.ndarray:
    """A hash of the window of each candidate, from running sums over the layout."""
    n = len(layout.classes)
    power = np.full(n + 1, _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((layout.classes.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    low, high = layout.start - _LEAD, layout.end + _TAIL
    # Powers counted from the end of the window, wherever it stands and however long the layout is.
    return _mixed((sums[high] - sums[low]) * power[n - high] * np.uint64(pow(_BASE, -n, 1 << 64)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hash(window: bytes) -> int:
    """What :func:`_hashes` gives for a candidate with this window."""
    back = np.cumprod(np.full(len(window), pow(_BASE, -1, 1 << 64), np.uint64))[::-1]
    return int(_mixed(((np.frombuffer(window, np.uint8).astype(np.uint64) + np.uint64(1)) * back).sum(keepdims=True))[0])


def _fold(hashes):
    return hashes % FOLDS


def samples(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(window, secret): each task's ``sample`` least windows by hash of each label."""
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, dict[int, bytes]] = {False: {}, True: {}}
        bound = {False: np.uint64(2 ** 64 - 1), True: np.uint64(2 ** 64 - 1)}

        def cut(label: bool) -> None:
            least = sorted(held[label])[:sample]
            held[label] = {h: held[label][h] for h in least}
            if len(least) == sample:
                bound[label] = np.uint64(least[-1])

        for b in batches:
            for _, layout in laid_out(b["text"].to_pylist()):
                hashes = _hashes(layout)
                short = layout.end - layout.start <= SAMPLE_CHARS
                for label in (False, True):
                    mine = layout.known == label
                    for i in np.flatnonzero(mine & short & (hashes <= bound[label])).tolist():
                        held[label][int(hashes[i])] = layout.window(i)
                    if len(held[label]) > 2 * sample:
                        cut(label)
        for label in (False, True):
            cut(label)
            windows = list(held[label].values())
            yield pa.RecordBatch.from_pydict({"window": pa.array(windows, pa.binary()),
                                              "secret": pa.array([label] * len(windows), pa.bool_())})

    return docs.select("text").mapInArrow(run, "window binary, secret boolean")


def mixed(docs: DataFrame, nets: list[CharCnn], secrets: list[bytes]) -> list[CharCnn]:
    """The networks after one pass over all candidates of (text), averaged over the tasks; ``secrets`` fill up batches."""
    begin = [net.flat() for net in nets]
    fill_at = np.cumsum([len(w) for w in secrets]) - [len(w) for w in secrets]
    fill = np.frombuffer(b"".join(secrets), np.uint8)
    fill_start, fill_end = fill_at + _LEAD, fill_at + [len(w) for w in secrets] - _TAIL
    fill_fold = folds_of(secrets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.random.default_rng(17 + TaskContext.get().partitionId())
        own = [CharCnn().set_flat(values) for values in begin]
        steps = [Adam(net) for net in own]
        seen = np.zeros(FOLDS, np.int64)
        for b in batches:
            for _, layout in laid_out(b["text"].to_pylist()):
                here = len(layout.classes)
                flat = np.concatenate([layout.classes, fill])
                fold, plain = _fold(_hashes(layout)).astype(np.int64), np.flatnonzero(~layout.known)
                start = np.concatenate([layout.start, here + fill_start])
                end = np.concatenate([layout.end, here + fill_end])
                y = np.concatenate([layout.known, np.ones(len(secrets), bool)])
                for f, (net, adam) in enumerate(zip(own, steps)):
                    rows = r.permutation(np.flatnonzero(fold != f))
                    more = len(fold) + np.flatnonzero(fill_fold != f)
                    lends = plain[fold[plain] != f]
                    seen[f] += len(rows)
                    for part in np.array_split(rows, -(-len(rows) // BATCH)) if len(rows) else ():
                        who = np.concatenate([part, more[r.integers(0, len(more), -(-len(part) // FILL))]])
                        give = np.where(r.random(len(who)) < 0.5, lends[r.integers(0, len(lends), len(who))]
                                        if len(lends) else who, who)
                        known = y[who]
                        weight = np.where(known, 0.5 / max(1, known.sum()), 0.5 / max(1, (~known).sum()))
                        adam.step(net.row_gradient(Rows(flat, start, end, who, give), known.astype(float), weight), RATE)
        for f, net in enumerate(own):
            if seen[f]:
                values = np.round(net.flat() / _UNIT).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "fold": pa.array(np.full(len(values), f), pa.int32()),
                    "place": pa.array(np.arange(len(values)), pa.int32()),
                    "value": pa.array(values), "n": pa.array(np.full(len(values), seen[f]))})

    ends = docs.select("text").mapInArrow(run, "fold int, place int, value long, n long")
    total = ends.groupBy("fold", "place").agg(
        F.expr("sum(cast(value as decimal(19,0)) * cast(n as decimal(12,0)))").alias("v"), F.sum("n").alias("n"))
    for row in total.collect():  # one a parameter
        begin[row.fold][row.place] = float(row.v / row.n) * _UNIT
    return [CharCnn().set_flat(values) for values in begin]


def scores(docs: DataFrame, nets: list[CharCnn]) -> DataFrame:
    """(logit, secret, n): how many candidates of (text) have each logit, in steps of `LOGIT_STEP`, from the network
    that did not learn from their fold, in the surroundings of others."""
    values = [net.flat() for net in nets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.random.default_rng(19 + TaskContext.get().partitionId())
        own = [CharCnn().set_flat(v) for v in values]
        counts: dict[tuple[int, bool], int] = {}
        for b in batches:
            for _, layout in laid_out(b["text"].to_pylist()):
                fold, plain = _fold(_hashes(layout)), np.flatnonzero(~layout.known)
                for f, net in enumerate(own):
                    rows = np.flatnonzero(fold == f)
                    for i in range(0, len(rows), BATCH):
                        who = rows[i: i + BATCH]
                        give = plain[r.integers(0, len(plain), len(who))] if len(plain) else who
                        logit = net.row_logits(Rows(layout.classes, layout.start, layout.end, who, give))
                        steps = np.round(np.clip(logit, -30, 30) / LOGIT_STEP).astype(np.int64)
                        keys, n = np.unique(steps * 2 + layout.known[who], return_counts=True)
                        for k, c in zip(keys.tolist(), n.tolist()):
                            counts[k] = counts.get(k, 0) + c
        keys = np.array(sorted(counts), np.int64)
        yield pa.RecordBatch.from_pydict({"logit": pa.array(keys >> 1), "secret": pa.array((keys & 1).astype(bool)),
                                          "n": pa.array([counts[k] for k in keys.tolist()], pa.int64())})

    found = docs.select("text").mapInArrow(run, "logit long, secret boolean, n long")
    return found.groupBy("logit", "secret").agg(F.sum("n").alias("n")).orderBy("logit", "secret")


def learn(docs: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> Model | None:
    """The model of all candidates of (text); the networks start from at most ``sample`` windows of each label."""
    drawn = written(samples(docs, sample), "samples")
    found = written(drawn.groupBy("window").agg(F.max("secret").alias("secret")), "windows")
    picked = [r for label in (True, False)
              for r in hash_sample(found.where(F.col("secret") == label), sample, "window").collect()]
    nets = starts([bytes(r.window) for r in picked], [r.secret for r in picked])
    if nets is None:
        return None
    nets = mixed(docs, nets, [bytes(r.window) for r in picked if r.secret])
    rows = scores(docs, nets).collect()  # 60,001 logits of each label at most
    return judged(nets, np.array([r.logit for r in rows]) * LOGIT_STEP, np.array([r.secret for r in rows], bool),
                  np.array([r.n for r in rows], np.int64), recall)


def all_spans(layout: Layout, model: Model | None) -> list[list[tuple[int, int, int, int]]]:
    """Pattern spans and added ones of each text of a layout, by start, then kind."""
    out = [list(base) for base in layout.bases]
    which = np.flatnonzero(~layout.known)
    if model is not None and len(which):
        for i, start, end in layout.spans(which[model.chances(layout, which) >= model.threshold]):
            out[i].append((start, 3, end, start))
    return [sorted(spans) for spans in out]


def digest(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end, _ in spans)


def find(docs: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of (doc_id, text)."""
    model = learn(docs, sample, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, layout in laid_out(b["text"].to_pylist()):
                for base, spans in zip(layout.bases, all_spans(layout, model)):
                    kinds = [s[1] for s in base]
                    out.append((*(kinds.count(k) for k in range(3)),
                                hashlib.sha256(digest(base).encode()).hexdigest(), digest(spans)))
            cols = list(zip(*out)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int, int]], mask: str = "[secret]") -> str:
    """``text`` with the value of every span replaced."""
    out, done = [], 0
    for _, _, end, value in sorted(spans, key=lambda s: s[3]):
        if value >= done:
            out += [text[done:value], mask]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """``docs``, columns as given, with the secrets in ``text`` masked; texts without one come back as they are."""
    model = learn(docs, sample, recall)
    rows, (text,) = numbered(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b[text].to_pylist()
            for first, layout in laid_out(texts):
                for i, spans in enumerate(all_spans(layout, model), first):
                    if spans:
                        texts[i] = masked(texts[i], spans)
            yield b.set_column(b.schema.get_field_index(text), b.schema.field(text), pa.array(texts, b[text].type))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
