"""Decontamination, periodic runs and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from deliverylens.llm import decontam, runs, spelling
from deliverylens.llm.queries import SQL

from conftest import SF_SMALL
from hard_cases import hard_docs, hard_texts, no_docs  # noqa: F401

ITEM_DDL = "item_id long, text string, doc_id string, window string, spans string"


def _documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _key(r):
    return tuple((v is None, v) for v in r)


# ---------------------------------------------------------------- decontamination

def _tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))


def _marks(rows, items, size=10):
    """(marked words, item ids) of each row, every item word by word."""
    windows = []
    for i, text in items:
        w = _tokens(text)
        k = min(size, len(w))
        windows += [(i, tuple(w[a: a + k])) for a in range(len(w) - k + 1) if k]
    out = []
    for _, text in rows:
        w = _tokens(text)
        marked, ids = set(), set()
        for i, g in windows:
            for a in range(len(w) - len(g) + 1):
                if tuple(w[a: a + len(g)]) == g:
                    marked |= set(range(a, a + len(g)))
                    ids |= {i} - {None}
        out.append((marked, ids))
    return out


def _contamination(rows, items):
    return sorted([(i, len(_tokens(t)), len(m), len(ids), _sha(",".join(sorted(map(str, ids)))), bool(m))
                   for (i, t), (m, ids) in zip(rows, _marks(rows, items))], key=_key)


@pytest.fixture(scope="module")
def items(spark):
    """Short, empty, repeated and overlapping items, one id twice, and one without an id."""
    return spark.createDataFrame([
        (1, "Plain words", "c", "w", "s"), (2, None, "c", "w", "s"), (3, " ..!", "c", "w", "s"),
        (4, "three four five one two three four five one two three", "c", "w", "s"),
        (4, "one two three four five one two three four five", "c", "w", "s"),
        (5, "die strasse", "c", "w", "s"), (6, "die straße ñandú école", "c", "w", "s"), (7, "DIE straße, ñandú? École", "c", "w", "s"),
        (10, "x" * 30_000, "c", "w", "s"), (None, "0f" * 20, "c", "w", "s"), (11, "0f" * 20, "c", "w", "s"),
        (12, "words of", "c", "w", "s"), (12, "words of", "c", "w", "s")], ITEM_DDL)


@pytest.mark.parametrize("bounds", [{}, {"windows_at_once": 3}, {"bytes_at_once": 20_000}])
def test_contamination_equals_brute_force(spark, hard_docs, no_docs, items, bounds):
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()]
    given = [(r.item_id, r.text) for r in items.collect()]
    got = decontam.contamination(hard_docs, items, **bounds)
    assert sorted(map(tuple, got.collect()), key=_key) == _contamination(rows, given)
    assert sum(r.contaminated for r in got.collect()) >= 4
    if not bounds:
        assert decontam.contamination(no_docs, items).count() == 0
        none = decontam.contamination(hard_docs, items.limit(0)).collect()
        assert len(none) == len(rows) and not any(r.contaminated or r.n_items for r in none)


def test_contamination_equals_its_sql_and_brute_force_on_the_smallest_table(spark):
    docs, bench = _documents(spark), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = decontam.contamination(docs, bench)
    mine = sorted(map(tuple, got.collect()), key=_key)
    assert any(r[5] for r in mine)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    found = con.execute(SQL["op11_decontamination"])
    assert [c[0] for c in found.description] == got.columns
    assert sorted(found.fetchall(), key=_key) == mine


def test_contamination_runs_no_python_and_shuffles_only_marks(spark):
    docs, bench = _documents(spark), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    plan = decontam.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin [hash" in plan


def test_cleaned_texts_equal_brute_force(spark, hard_docs, no_docs, items):
    given = [(r.item_id, r.text) for r in items.collect()]
    rows = hard_docs.collect()
    want_rows, want_texts = Counter(), Counter()
    for r, (marked, _) in zip(rows, _marks([(r.doc_id, r.text) for r in rows], given)):
        text = r.text
        if marked:
            places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
            keep = [True] * len(text)
            for i in marked:
                last = places[i + 1][0] if i + 1 in marked else places[i][1]
                keep[places[i][0]: last] = [False] * (last - places[i][0])
            text = "".join(c for c, k in zip(text, keep) if k)
        else:
            want_rows[tuple(r)] += 1
        want_texts[(r.doc_id, text, *tuple(r)[2:])] += 1
    for clean, want in ((decontam.without_documents, want_rows), (decontam.without_spans, want_texts)):
        got = clean(hard_docs, items)
        assert got.columns == hard_docs.columns and clean(no_docs, items).count() == 0
        assert Counter(map(tuple, got.collect())) == want


# ---------------------------------------------------------------- periodic runs

def _runs(w):
    """Every lag by itself, the least lag of a stretch being its period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def _periodic(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _digest(doc_id, text):
    w = _periodic(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = _runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in found), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *longest, _sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            _sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def _fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("chars", [300, 2_000_000])
def test_runs_equal_brute_force(monkeypatch, chars):
    monkeypatch.setattr(runs, "CHARS", chars)
    r = random.Random(chars)
    texts = [_fibonacci(400), [0] * 300, [0] * 90 + [1] + [0] * 90, ([0] * 20 + [1]) * 12, ([0, 1] * 10 + [2]) * 8,
             list(range(30)) * 3, list(range(30)) * 2 + [1], [], [3] * 11, [3] * 12]
    for _ in range(500):
        w = [r.randint(0, r.choice([1, 2, 4, 30])) for _ in range(r.choice([12, 25, 60, 150, 300]))]
        for _ in range(r.randint(0, 4)):
            a, p = r.randrange(len(w)), r.randint(1, len(w) // 3)
            for i in range(a, min(len(w), a + r.randint(p, len(w)))):
                w[i] = w[a + (i - a) % p]
        texts.append(w)
    found = runs.searched(range(len(texts)), [" ".join(map(str, w)) for w in texts])
    total = 0
    for w, (words, own) in zip(texts, found, strict=True):
        assert [int(x) for x in words] == w
        assert [tuple(x) for x in own.tolist()] == _runs(w)
        total += len(own)
    assert total > 300


@pytest.mark.parametrize("make", [lambda n: [0] * n, _fibonacci, lambda n: [0] * (n // 2) + [1] + [0] * (n // 2),
                                  lambda n: ([0] * (n // 20) + [1]) * 20, lambda n: list(range(n // 10)) * 10])
def test_seeds_stay_in_proportion_to_the_text(monkeypatch, make):
    walked = []
    walk = runs._stretch
    monkeypatch.setattr(runs, "_stretch", lambda w, x, q: walked.append(walk(w, x, q)) or walked[-1])
    n = 30_000
    w = np.array([*make(n), -1], np.int64)
    found = runs.find_runs(w, np.zeros(len(w), np.int64))
    assert len(found) and len(walked) < 2 * n and sum(b - a for a, b in walked) < 60 * n


def test_run_digests_equal_brute_force(spark, hard_docs, no_docs):
    more = spark.createDataFrame([(90, "one two three " * 30), (91, "a " * 40)], "doc_id long, text string")
    short = hard_docs.where("text IS NULL OR length(text) < 40000").unionByName(more, allowMissingColumns=True)
    for docs in (_documents(spark), short):
        got = runs.digests(docs).collect()
        want = [_digest(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(map(tuple, got), key=_key) == sorted(want, key=_key)
        assert sum(r.n_runs > 0 for r in got) >= 2
    assert runs.digests(hard_docs).count() == hard_docs.count() and runs.digests(no_docs).count() == 0
    plain = {r.doc_id: r for r in runs.find(hard_docs).collect()}
    assert plain[9].runs[0].period == 5 and plain[9].collapsed == "one two three four five"
    assert plain[0].runs == [] and plain[0].collapsed == "" and plain[13].collapsed == "plain words of the day"


# ---------------------------------------------------------------- spelling variants

def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows, slip=True):
    count = Counter()
    for i, text in rows:
        for w in map(_lower, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if slip and h % 31 == 0 else w] += 1
    n = {w: c for w, c in count.items() if len(w) >= 7 and c >= 2}
    words = sorted(n)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if _near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted([(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in words], key=_key)


def _words_table(spark, words, copies=2):
    return spark.createDataFrame([(None, " ".join(words))] * copies, "doc_id long, text string")


@pytest.fixture(scope="module")
def misspelt():
    """Few letters, long chains of forms, ties, words that collide over few symbols, accents and one huge word."""
    r = random.Random(8)
    words = ["".join(r.choices("abÀñß÷", k=r.choice([6, 7, 7, 8, 9]))) for _ in range(150)]
    words += ["lettering"] * 3000 + ["letering"] * 290 + ["leterin"] * 28 + ["leterun"] * 2 + ["lettéring"] * 3
    words += ["Tweedle", "tweedle", "tweedlx", "tweedlx"] * 20 + ["tweedly"] * 4 + ["x" * 9000, "x" * 8999, "x" * 8999 + "y"]
    r.shuffle(words)
    return words


@pytest.mark.parametrize("symbols", [2, 8, 0x110000])
def test_variants_equal_brute_force(spark, monkeypatch, misspelt, symbols):
    monkeypatch.setattr(spelling, "SYMBOLS", symbols)
    docs = _words_table(spark, misspelt)
    got = spelling.variants(docs, None).collect()
    want = _variants([(r.doc_id, r.text) for r in docs.collect()], slip=False)
    assert sorted(map(tuple, got), key=_key) == want
    by = {r.word: r for r in got}
    assert by["leterin"].root == "lettering" and by["leterin"].form == "letering" and by["tweedly"].form == "tweedle"


def test_variants_of_tables_equal_brute_force(spark, hard_docs, no_docs):
    for docs in (_documents(spark), hard_docs):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = spelling.variants(docs)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect()), key=_key) == _variants(rows)
    assert spelling.variants(no_docs).count() == 0
    assert spelling.variants(hard_docs.where("doc_id = 0")).count() == 0


def test_a_hot_reduced_word_is_split_by_a_larger_alphabet(spark, monkeypatch):
    """Words over letters of one symbol are one group until the alphabet tells them apart."""
    one = spelling._symbols(np.arange(ord("a"), ord("z") + 1), 8)
    letters = [chr(ord("a") + i) for i in np.flatnonzero(one == np.bincount(one.astype(int)).argmax())]
    assert len(letters) > 2
    r = random.Random(4)
    words = sorted({"".join(r.choices(letters, k=9)) for _ in range(900)})
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    used = []
    make = spelling.reduced_pairs
    monkeypatch.setattr(spelling, "reduced_pairs", lambda w, s: used.append(s) or make(w, s))
    got = {(r.a, r.b) for r in spelling.near_pairs(table).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if _near(a, b)}
    assert used[0] == 8 and len(used) > 1


def test_neighbours_are_all_of_one_edit():
    """The generating end of each edit reaches the other's name."""
    r = random.Random(6)
    letters = np.arange(1, 5, dtype=np.uint64)
    for _ in range(200):
        w = "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
        points = np.frombuffer(w.encode("utf-32-le"), np.uint32).reshape(1, -1)
        got = {int(n) for _, part in spelling.neighbours(points, 4, letters) for n in part}
        symbol = lambda c: int(spelling._symbols(np.array([ord(c)]), 4)[0])
        i = r.randrange(len(w))
        for c in "abcdefghijklmn":
            other = w[:i] + c + w[i + 1:]
            if symbol(c) >= symbol(w[i]):
                assert int(spelling.names([other], 4)[0]) in got
        assert int(spelling.names([w[:i] + w[i + 1:]], 4)[0]) in got
