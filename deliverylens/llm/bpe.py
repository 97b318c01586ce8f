"""Byte-level BPE encoding by backtracking, and decoding through an offset table.

The encoder finds every vocabulary entry that begins at each byte of a word in
one Aho-Corasick pass, takes the longest at the present place, and keeps it if
it may stand beside the token before it; otherwise it tries the next shorter
one, and where none is left it gives up the token before and marks the place
as a dead end, so that no place is left twice. Two tokens may stand side by
side when merging their bytes from the start never merges across their border;
that is found once for each pair from the merge order and kept in a table. What
remains is exactly what applying the merges in order gives, in time linear in
the length of the word.

Texts are cut into words by the vocabulary's own pattern, and the ids of
frequent words are kept, so most words cost one look-up.

Defined cases: null counts as empty (no ids, decoded text empty); special
tokens in a text become their ids, as the library's default has it; ids beyond
the table raise; repeated rows are encoded each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, arrow_tasks

#: Fixed value: the public pattern that cuts a text into words before merging.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE_WORDS = 250_000
PAIR_LIMIT = 2_000_000
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: printable Latin-1 as is, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = [b""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.text[i] = bytes(alphabet[c] for c in token)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank of the merge
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[left, right] = rank
            self.parts.setdefault(whole, (left, right, rank))
        self.search = ahocorasick.Automaton()
        for i, t in enumerate(self.text):
            if t:
                self.search.add_word(t.decode("latin-1"), (len(t), i))
        self.search.make_automaton()
        self.single = {t: i for i, t in enumerate(self.text) if len(t) == 1}
        # Offset table: token i is blob[offset[i]:offset[i + 1]].
        by_id = list(self.text)
        for t, i in self.special.items():
            by_id[i] = t.encode()
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(t) for t in by_id]))).astype(np.int64)
        self.words = regex.compile(WORDS)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.fits: dict[int, bool] = {}
        self.cache = BoundedCache(lambda w: tuple(self.encode_bytes(w.encode("utf-8", "surrogatepass"))), CACHE_WORDS)

    # -- pair compatibility

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that uses it up) at one end of a token, from its outermost byte to itself."""
        out, until = [], _NEVER
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out[::-1]
            left, right, until = self.parts[token]
            token = right if side else left

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b in order leaves the border between them."""
        key = a * len(self.text) + b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIR_LIMIT:
                self.fits.clear()
            known = self.fits[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        left, right, i, j = self.edge(a, 1), self.edge(b, 0), 0, 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            # Both stand at the border until the earlier of their next merges; of equal ranks the left one is first.
            across = self.rank.get((x, y), _NEVER)
            if across < x_end and across <= y_end and across < _NEVER:
                return False
            if x_end == y_end == _NEVER:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    # -- encoding

    def encode_bytes(self, word: bytes) -> list[int]:
        if len(word) == 1:
            return [self.single[word]]
        starting: list[list[tuple[int, int]]] = [[] for _ in word]
        for end, entry in self.search.iter(word.decode("latin-1")):
            starting[end + 1 - entry[0]].append(entry)  # in order of length
        ids: list[int] = []
        tries: list[int] = []  # how many of the entries at the token's place are still to be tried
        dead = bytearray(len(word) + 1)
        at, left = 0, len(starting[0])
        while at < len(word):
            here = starting[at]
            while left:
                left -= 1
                size, token = here[left]
                if not dead[at + size] and (not ids or self.compatible(ids[-1], token)):
                    ids.append(token)
                    tries.append(left)
                    at += size
                    left = len(starting[at]) if at < len(word) else 0
                    break
            else:
                if not ids:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[at] = 1
                at -= len(self.text[ids.pop()])
                left = tries.pop()
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a whole text."""
        ids = array("I")
        if not text:
            return ids
        pieces = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
        for piece in pieces:
            if piece in self.special:
                ids.append(self.special[piece])
            else:
                ids.extend(chain.from_iterable(map(self.cache.__getitem__, self.words.findall(piece))))
        return ids

    # -- decoding

    def decode_bytes(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        first, size = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
        return self.blob[place].tobytes()

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The encoder of a file, once for each worker process."""
    return Bpe(path)


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of (doc_id, text); ids are longs, decoded the text they give."""
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for b in batches:
            ids = [bpe.encode(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([i.tolist() for i in ids], pa.list_(pa.int64())),
                 pa.array([bpe.decode(i) for i in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<bigint>, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, computed where the ids are made."""
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for b in batches:
            rows = []
            for t in b["text"].to_pylist():
                ids = np.array(bpe.encode(t), dtype="<u4")
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
