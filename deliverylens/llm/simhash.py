"""SimHash near-duplicates found by vantage-point trees.

A fingerprint has 64 bits: a bit is set where over half the hashes of the
document's word shingles have it. Distinct fingerprints are spread over shards
by the top of a vantage-point tree: a node holds a fingerprint and a radius;
what is as near as the radius goes to the near child, what is farther to the
far child, and what is within the link distance of the radius to both. By the
triangle inequality every pair within the link distance shares a shard. Each
shard goes on splitting in its task by the same rule until a leaf is small, and
compares the leaf exactly. A shard returns a spanning forest of its links, not
its pairs; the forests are joined by `components`.

Each split repeats what lies near its radius, in 64 bits nearly a third of the
rows, so the copies grow with the number of splits. A fingerprint has 8 bytes:
shards are as large as a task can well hold (`SHARD_TARGET`), so that most
splits happen in a task's memory and not in the shuffle.

The tree's top is chosen from a bounded sample (`SAMPLE`) of the distinct
fingerprints, which affects balance only, never which pairs are found. A shard
that no vantage point splits well may hold over `SHARD_LIMIT` fingerprints; it
is dealt out again as pairs of blocks of at most that size. A task splits the
two blocks of a pair by vantage points of their own.

Defined cases: null and empty texts have fingerprint zero and link like any
other; texts with fewer words than a shingle are one shingle; rows are never
merged, a repeated row comes out as often as it goes in; a null id belongs to
its text's component but is never its name (a component of null ids alone has
a null name); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_tasks, hash_sample, numbered, written
from .components import components

SEED = 42
SAMPLE = 16_384
SHARD_TARGET = 262_144
SHARD_LIMIT = 1_048_576
LEAF = 768
#: A split that leaves more than this share in one child is not worth its copies, across tasks and within one.
_DENSE_TOP, _DENSE = 0.72, 0.85


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist())
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[s:e], SEED) for s, e in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[i: i + 65_536]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: Column | None = None) -> DataFrame:
    """(doc_id, key, fp) of every row of (doc_id, text); fp is the fingerprint as a signed long.

    ``key``: a long that travels with the row, null if not given.
    """
    arrow_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["key"], pa.array(fps, pa.int64())],
                                             ["doc_id", "key", "fp"])

    key = F.lit(None) if key is None else key
    return (docs.select(F.col("doc_id").cast("long"), key.cast("long").alias("key"), "text")
            .mapInArrow(run, "doc_id long, key long, fp long"))


# ---------------------------------------------------------------- vantage points

def _split(x: np.ndarray, bits: int, dense: float) -> tuple[np.uint64, int, np.ndarray, np.ndarray] | None:
    """Vantage point, radius, near mask and far mask (they overlap by ``bits``, 1 at least); None if no split pays."""
    bits = max(1, bits)
    best = None
    sample = x[:: max(1, len(x) // 256)][:256]
    for v in sample[:: max(1, len(sample) // 6)][:6]:
        within = np.cumsum(np.bincount(np.bitwise_count(sample ^ v), minlength=65))
        worst = np.maximum(within, len(sample) - np.concatenate((np.zeros(bits, np.int64), within[:-bits])))
        radius = int(np.argmin(worst))
        if best is None or worst[radius] < best[0] * len(sample):
            best = (worst[radius] / len(sample), v, radius)
    if best is None or best[0] > dense:
        return None
    _, v, radius = best
    d = np.bitwise_count(x ^ v).astype(np.int64)
    near, far = d <= radius, d > radius - bits
    if max(near.sum(), far.sum()) >= len(x):
        return None
    return v, radius, near, far


def build_top(sample: np.ndarray, shards: int, bits: int) -> list:
    """Nodes (vantage point, radius, near child, far child) of a tree with about ``shards`` leaves.

    A child that is not negative is a node; a negative child c is shard -c - 1.
    """
    nodes: list = []
    leaves = 0

    def grow(x: np.ndarray, want: float) -> int:
        nonlocal leaves
        split = _split(x, bits, _DENSE_TOP) if want > 1 and len(x) >= 16 else None
        if split is None:
            leaves += 1
            return -leaves
        v, radius, near, far = split
        at = len(nodes)
        nodes.append(None)
        share = near.sum() / len(x), far.sum() / len(x)
        nodes[at] = (int(v), radius, grow(x[near], want * share[0]), grow(x[far], want * share[1]))
        return at

    grow(sample, float(shards))
    return nodes


def place(x: np.ndarray, nodes: list, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every shard each fingerprint belongs to."""
    if not nodes:
        return np.arange(len(x)), np.zeros(len(x), np.int64)
    rows, shards, todo = [], [], [(0, np.arange(len(x)))]
    while todo:
        at, who = todo.pop()
        if not len(who):
            continue
        if at < 0:
            rows.append(who)
            shards.append(np.full(len(who), -at - 1))
            continue
        v, radius, near, far = nodes[at]
        d = np.bitwise_count(x[who] ^ np.uint64(v)).astype(np.int64)
        todo += [(near, who[d <= radius]), (far, who[d > radius - bits])]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(shards)


def _dense_links(x: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(members, first of their group) of the link groups in ``x``, by growing one group at a time."""
    left, found = np.arange(len(x)), []
    while len(left):
        seed, left = left[0], left[1:]
        group, front = [], np.array([seed])
        while len(front) and len(left):
            step = max(1, 4_000_000 // max(1, len(left)))
            hit = np.zeros(len(left), bool)
            for i in range(0, len(front), step):
                todo = ~hit
                near = np.bitwise_count(x[left[todo]][:, None] ^ x[front[i: i + step]][None]) <= bits
                hit[todo] = near.any(axis=1)
                if hit.all():
                    break
            front, left = left[hit], left[~hit]
            group.append(front)
        members = np.concatenate(group) if group else np.zeros(0, np.int64)
        if len(members):
            found.append((members, np.full(len(members), seed)))
    return found


def _close(y: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs a < b of positions within ``bits``, some rows at a time so that they stay in cache."""
    found = []
    for i in range(0, len(y), 32):
        hit = np.bitwise_count(y[i: i + 32, None] ^ y[None, i:]) <= bits
        if np.count_nonzero(hit) > len(hit):  # each meets itself
            a, b = np.nonzero(hit)
            found.append((a[a < b] + i, b[a < b] + i))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def linked(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, position) that connect exactly what links within ``bits`` connect in distinct ``x``."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [np.arange(len(x))]
    while todo:
        who = todo.pop()
        y = x[who]
        split = _split(y, bits, _DENSE) if len(who) > LEAF else None
        if split is not None:
            todo += [who[split[2]], who[split[3]]]
            continue
        if len(who) <= 2 * LEAF:
            a, b = _close(y, bits)
            if len(a) <= 2 * len(who):  # so few that the pairs themselves are a short answer
                out.append((who[b], who[a]))
                continue
        out += [(who[a], who[b]) for a, b in _dense_links(y, bits)]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


# ---------------------------------------------------------------- Spark

def links(fps: DataFrame, bits: int = 3, shard_target: int = SHARD_TARGET,
          shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all pairs within ``bits``."""
    spark = fps.sparkSession
    n = fps.count()
    sample = np.array([r.fp for r in hash_sample(fps.select("fp"), SAMPLE, "fp").collect()],
                      np.int64).view(np.uint64)
    nodes = build_top(sample, -(-n // shard_target), bits)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["fp"].to_numpy(zero_copy_only=False)
            rows, shards = place(x.view(np.uint64), nodes, bits)
            yield pa.RecordBatch.from_pydict({"fp": pa.array(x[rows], pa.int64()),
                                              "shard": pa.array(shards, pa.int64())})

    placed = written(fps.select("fp").mapInArrow(assign, "fp long, shard long"), "shards")
    # Blocks of a shard that is too large for one task; every pair of its blocks is compared.
    sizes = (placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", F.ceil(F.col("n") / shard_limit).cast("long").alias("blocks")).where("blocks > 1"))
    dealt = (placed.join(sizes, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("fp", "shard", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def compare(table: pa.Table) -> pa.Table:
        x = np.unique(table["fp"].to_numpy())
        a, b = linked(x.view(np.uint64), bits)
        return pa.table({"a": pa.array(x[a], pa.int64()), "b": pa.array(x[b], pa.int64())})

    return dealt.groupBy("shard", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def classes(distinct: DataFrame, bits: int) -> DataFrame:
    """(fp, root): the class of every distinct fingerprint, named by one of its fingerprints."""
    found = components(links(distinct, bits), "a", "b").select(F.col("node").alias("fp"), "root")
    return distinct.select("fp").join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of (doc_id, text)."""
    rows = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = distinct.join(classes(distinct, bits), "fp")
    name = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(name, "root").select("fp", "component_id")
    return (rows.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs``, columns as given, that stay when one row of each component stays.

    That is the row of the smallest id, null ids last; among rows of one id
    the first by a hash of the row, and of rows alike in every column one.
    """
    given, (doc_id, text) = numbered(docs, "doc_id", "text")
    row, key = F.struct(*given.columns), F.xxhash64(*given.columns)
    rows = fingerprints(given.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("key")),
                        shingle, F.col("key"))
    alike = rows.groupBy("fp", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "key", "n")).alias("first")
    distinct = written(alike.groupBy("fp").agg(first), "distinct")
    rooted = distinct.join(classes(distinct, bits), "fp")
    stay = written(rooted.groupBy("root").agg(F.min("first").alias("first"))
                   .select(F.col("first.doc_id").alias("id_"), F.col("first.key").alias("key_"),
                           F.col("first.n").alias("n_")), "stay")
    kept = (given.select(row.alias("row"), key.alias("key"))
            .join(stay, (F.col("key") == F.col("key_")) & F.col(f"row.{doc_id}").eqNullSafe(F.col("id_"))))
    # Rows that occur once need no further shuffle; whole copies of a staying row are reduced to one.
    once = kept.where("n_ = 1").select("row")
    again = kept.where("n_ > 1").groupBy("key", "id_").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*").toDF(*docs.columns)
