"""Language-model score by a subword lattice.

The pieces of an existing vocabulary are the edges of a lattice over a text:
one path for each way to cut the text into pieces, and bytes for a character
that is no piece. The model's probability of a text is the sum over all paths,
found by a forward recursion in log space. No piece crosses a blank, so every
path passes through every word's end and the recursion over a text is the sum
of those over its words; each distinct word is worked out once, by Spark.

Piece weights start from the scores that the vocabulary file gives and are
fitted to all training words by `ROUNDS` rounds of expectation and
maximization over the same lattices, run by Spark on the counted words. The
end of a text is a piece of its own. All words of the training texts are
counted; the driver sees sums over the vocabulary's pieces only, and the
scores of the `HEAD` most frequent words, which every task gets. All other
words meet their scores in a join.

Defined cases: null counts as the empty text, whose only token is the end; a
null id counts as the empty id in the training fold; with no training row all
weights are those of the vocabulary file and all counts zero; repeated rows
are scored each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_tasks, code_points, id_crc32, written

BLANK = "▁"
ROUNDS = 2
PRIOR = 1000.0
HEAD = 100_000
HEAD_BYTES = 64
FLUSH_WORDS = 200_000
BATCH_CELLS = 500_000
_B = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; blanks are the ASCII ones."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# ---------------------------------------------------------------- vocabulary

class Pieces:
    """Texts and first weights of the pieces that a lower-cased word can hold; the end of a text is the last piece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts: list[str] = []
        weights = []
        self.bytes = np.zeros(256, np.int64)
        scores = [model.get_score(i) for i in range(model.get_piece_size())]
        # Scores of a merge vocabulary are ranks (0, -1, -2, ...); weights fall with the rank as word counts do.
        # Scores of a unigram vocabulary are log probabilities.
        ranked = min(s for s in scores if s > -1e8) < -1000
        for i, s in enumerate(scores):
            text = model.id_to_piece(i)
            w = 1 / (2 - s) if ranked else np.exp(s)
            if model.is_byte(i):
                self.bytes[int(text[3:5], 16)] = len(self.texts)
                self.texts.append("")
                weights.append(min(w, 1e-6))
            elif not (model.is_control(i) or model.is_unknown(i) or BLANK in text[1:]
                      or any("A" <= c <= "Z" for c in text)):
                self.texts.append(text)
                weights.append(w)
        self.end = len(self.texts)
        self.prior = np.array([*weights, float(np.mean(weights))])
        self.prior /= self.prior.sum()


class Lattice:
    """Forward and backward recursions over words for given piece probabilities."""

    def __init__(self, pieces: Pieces, probability: np.ndarray):
        self.pieces, self.log = pieces, np.log(probability)
        known = [i for i, t in enumerate(pieces.texts) if t]
        codes, at = code_points([pieces.texts[i] for i in known])
        size = np.diff(at)
        self.longest = int(size.max())
        self.power = np.cumprod(np.concatenate(([_U(1)], np.full(self.longest + 1, _B))), dtype=np.uint64)
        place = np.repeat(at[1:], size) - 1 - np.arange(len(codes))
        names = np.add.reduceat((codes.astype(np.uint64) + _U(1)) * self.power[place], at[:-1])
        order = np.argsort(names)
        self.names, self.ids = names[order], np.array(known, np.int64)[order]
        if (self.names[1:] == self.names[:-1]).any():
            raise ValueError("two pieces share a name")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.names)] = True

    @staticmethod
    def _slot(names: np.ndarray) -> np.ndarray:
        return ((names ^ (names >> _U(32))) * _U(0xD6E8FEB86659FD93) >> _U(44)).astype(np.int64)

    def _prepare(self, group: list[str]) -> tuple[np.ndarray, np.ndarray, list, np.ndarray, list]:
        """Lattices of equally long words, their blank before them.

        Number of each character's kind, by place and word; how bytes spell each
        kind; the log weight of that; and for each length the pieces that occur:
        (length, slices by the place where they begin, words, pieces).
        """
        codes, _ = code_points([BLANK + w for w in group])
        codes = np.ascontiguousarray(codes.reshape(len(group), -1).T.astype(np.uint64)) + _U(1)
        kinds, which = np.unique(codes, return_inverse=True)
        which = which.reshape(codes.shape)
        spell = [self.pieces.bytes[list(chr(int(c) - 1).encode("utf-8", "surrogatepass"))] for c in kinds]
        fall = np.array([self.log[s].sum() for s in spell])[which]
        width, edges = len(codes), []
        name = np.zeros_like(codes)
        for k in range(1, min(self.longest, width) + 1):
            name = name[: width - k + 1] * _B + codes[k - 1:]  # of the k characters from each place on
            c, r = np.nonzero(self.maybe[self._slot(name)])
            found = name[c, r]
            at = np.minimum(np.searchsorted(self.names, found), len(self.names) - 1)
            good = self.names[at] == found
            c, r, ids = c[good], r[good], self.ids[at[good]]
            if len(c):
                edges.append((k, np.searchsorted(c, np.arange(width + 1)).tolist(), c, r, ids))
        return which, fall, spell, codes, edges

    def _forward(self, fall: np.ndarray, edges: list) -> np.ndarray:
        """Log weights of all paths from the words' beginning to each place."""
        width, rows = fall.shape
        alpha = np.zeros((width + 1, rows))
        weights = [self.log[ids] for *_, ids in edges]
        for j in range(1, width + 1):
            here = alpha[j - 1] + fall[j - 1]
            for (k, cut, _, r, _), w in zip(edges, weights):
                if k <= j and cut[j - k] < cut[j - k + 1]:
                    part = slice(cut[j - k], cut[j - k + 1])
                    who = r[part]
                    here[who] = np.logaddexp(here[who], alpha[j - k, who] + w[part])
            alpha[j] = here
        return alpha

    def _backward(self, fall: np.ndarray, edges: list) -> np.ndarray:
        """Log weights of all paths from each place to the words' end."""
        width, rows = fall.shape
        beta = np.zeros((width + 1, rows))
        weights = [self.log[ids] for *_, ids in edges]
        for j in range(width - 1, -1, -1):
            here = beta[j + 1] + fall[j]
            for (k, cut, _, r, _), w in zip(edges, weights):
                if j + k <= width and cut[j] < cut[j + 1]:
                    part = slice(cut[j], cut[j + 1])
                    who = r[part]
                    here[who] = np.logaddexp(here[who], beta[j + k, who] + w[part])
            beta[j] = here
        return beta

    def _groups(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """Positions of equally long texts, few enough for bounded memory."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        for n in np.unique(size):
            who = np.flatnonzero(size == n)
            step = max(1, int(BATCH_CELLS // (n + 2)))
            for i in range(0, len(who), step):
                yield who[i: i + step]

    def log10(self, texts: Sequence[str]) -> np.ndarray:
        """Log10 of the marginal probability of each word."""
        out = np.zeros(len(texts))
        for who in self._groups(texts):
            _, fall, _, _, edges = self._prepare([texts[i] for i in who])
            out[who] = self._forward(fall, edges)[-1] / np.log(10)
        return out

    def expected(self, texts: Sequence[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in words with counts."""
        total = np.zeros(len(self.pieces.texts) + 1)
        for who in self._groups(texts):
            which, fall, spell, _, edges = self._prepare([texts[i] for i in who])
            alpha, beta = self._forward(fall, edges), self._backward(fall, edges)
            whole, n = alpha[-1], counts[who]
            for k, _, c, r, ids in edges:
                use = np.exp(alpha[c, r] + self.log[ids] + beta[c + k, r] - whole[r]) * n[r]
                total += np.bincount(ids, use, len(total))
            use = np.exp(alpha[:-1] + fall + beta[1:] - whole) * n
            for s, u in zip(spell, np.bincount(which.ravel(), use.ravel(), len(spell))):
                np.add.at(total, s, u)
        return total


# ---------------------------------------------------------------- training

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of (text, held_out), c their number in rows that are not held out.

    Words are binary. What a task has counted is passed on before it grows large.
    """
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        others: set[bytes] = set()

        def out() -> pa.RecordBatch:
            seen.update(dict.fromkeys(others - seen.keys(), 0))
            b = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                           ["word", "c"])
            seen.clear()
            others.clear()
            return b

        for b in batches:
            for t, held in zip(b["text"].to_pylist(), b["held_out"].to_pylist()):
                (others if held else seen).update(words(t))
                if len(seen) + len(others) > FLUSH_WORDS:
                    yield out()
        yield out()

    return (docs.select("text", "held_out").mapInArrow(run, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def fit(counts: DataFrame, ends: int, vocabulary: str, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Piece probabilities after ``rounds`` rounds over (word, c), with ``ends`` ends of texts."""
    pieces = Pieces(vocabulary)
    now = pieces.prior

    def expect(probability: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(Pieces(vocabulary), probability), None
            for b in batches:
                texts = [w.decode("utf-8", "surrogatepass") for w in b["word"].to_pylist()]
                use = lattice.expected(texts, b["c"].to_numpy().astype(float))
                total = use if total is None else total + use
            if total is not None:
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "use"])
        return run

    for _ in range(rounds):
        # One row for each piece of the vocabulary file at most.
        rows = (counts.mapInArrow(expect(now), "piece long, use double").groupBy("piece")
                .agg(F.sum("use").alias("use")).toPandas())
        use = pieces.prior * prior
        use[rows["piece"].to_numpy(np.int64)] += rows["use"].to_numpy()
        use[pieces.end] += ends
        now = use / use.sum()
    return now


# ---------------------------------------------------------------- scoring

def word_scores(counts: DataFrame, probability: np.ndarray, vocabulary: str) -> DataFrame:
    """(word, c, log10): the marginal log10 probability of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(Pieces(vocabulary), probability)
        for b in batches:
            texts = [w.decode("utf-8", "surrogatepass") for w in b["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["word"], b["c"], pa.array(lattice.log10(texts), pa.float64())],
                                             ["word", "c", "log10"])

    return counts.mapInArrow(run, "word binary, c long, log10 double")


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most ``most`` of them: all whose count reaches a power of 2 ** (1 / 8)."""
    level = F.floor(F.log2("c") * 8)
    sizes = (counts.where("c > 0").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
             .collect())  # 64 * 8 rows at most
    least, room = None, most
    for r in sorted(sizes, key=lambda r: -r.level):
        room -= r.n
        if room < 0:
            break
        least = r.level
    return counts.where(F.lit(False) if least is None else (F.col("c") > 0) & (level >= least))


def score(docs: DataFrame, vocabulary: str, folds: int = 7, held: int = 2, head: int = HEAD) -> DataFrame:
    """Scores of every row of (doc_id, text), learning from the rows outside the held-out fold.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; the
    last is the lattice's, ``base_score`` that of whole words with one added to each count.
    """
    spark = docs.sparkSession
    arrow_tasks(spark)
    rows = docs.select(F.col("doc_id").cast("long"), (id_crc32(F.col("doc_id")) % folds == held).alias("held_out"),
                       "text")
    counts = written(word_counts(rows), "words")
    ends = rows.where("NOT held_out").count()
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, kinds = n_words + ends, distinct + (ends > 0)
    whole = float(total + kinds + 1)
    probability = fit(counts.where("c > 0"), ends, vocabulary)
    scores = written(word_scores(counts, probability, vocabulary), "word_scores")
    top = _frequent(scores.where(F.octet_length("word") <= HEAD_BYTES), head).collect()
    common = spark.sparkContext.broadcast(  # at most head words of HEAD_BYTES
        {bytes(r.word): (math.log10((r.c + 1) / whole), r.log10) for r in top})
    end_base, end_score = math.log10((ends + 1) / whole), float(np.log10(probability[-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value.get
        for b in batches:
            cols: list[list] = [[] for _ in range(4)]
            names, numbers, cuts = [], [], [0]
            for text in b["text"].to_pylist():
                n_tokens, n_known, base, mine = 1, int(ends > 0), end_base, end_score
                for w, n in Counter(words(text)).items():
                    n_tokens += n
                    both = known(w)
                    if both is None:
                        names.append(w)
                        numbers.append(n)
                    else:
                        n_known += n
                        base += n * both[0]
                        mine += n * both[1]
                cuts.append(len(names))
                for col, v in zip(cols, (n_tokens, n_known, base, mine)):
                    col.append(v)
            rest = pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rest)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"])

    table = written(rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                         "base_score double, score double, rest array<struct<word:binary,n:bigint>>")
                    .withColumn("uid", F.monotonically_increasing_id()), "scored")
    # Words outside the head meet their counts and scores in a join; none of them is frequent.
    rest = table.select("uid", F.explode("rest").alias("r")).select("uid", "r.word", "r.n")
    added = (rest.join(scores, "word").groupBy("uid")
             .agg(F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(whole))).alias("base"),
                  F.sum(F.col("n") * F.col("log10")).alias("mine"),
                  F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known")))
    zero = F.lit(0.0)
    return (table.drop("rest").join(added, "uid", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("base", zero)).alias("base_score"),
                    (F.col("score") + F.coalesce("mine", zero)).alias("score")))
