"""Periodic runs against a search over every period, the contract's digests
against plain Python, and defined cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from catalog_engine.llm.periodic import EXPONENT, MIN_LENGTH, maximal_pairs, periodic_runs, runs, suffix_groups, with_repeated_tails
from catalog_engine.llm.queries import op12_periodic_runs

from .conftest import frame, prose


def brute_force(words):
    """(start, end) -> least period, by comparing every word with the one a period on."""
    n, out = len(words), {}
    for q in range(1, n // EXPONENT + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(MIN_LENGTH, EXPONENT * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return out


def numbered(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], np.int64)


def periodic_words(r, n, letters):
    w = [str(r.randrange(letters)) for _ in range(n)]
    for _ in range(r.randrange(3)):
        if n > 10:
            a, p = r.randrange(n), r.randrange(1, 7)
            for i in range(a + p, min(n, a + p * r.randrange(3, 12))):
                w[i] = w[i - p]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_neighbouring_documents(seed):
    r = random.Random(seed)
    for _ in range(400):
        docs = [periodic_words(r, r.randrange(60), r.choice([1, 2, 3, 6])) for _ in range(3)]
        starts = np.cumsum([0, *map(len, docs)])
        want = {(s + lo, e + lo): q for w, lo in zip(docs, starts.tolist()) for (s, e), q in brute_force(w).items()}
        tokens = numbered([(k, x) for k, w in enumerate(docs) for x in w])
        assert runs(tokens, starts[:-1]) == want


@pytest.mark.parametrize("seed", range(3))
def test_pairs_are_maximal_and_complete(seed):
    """All pairs of equal stretches, close enough, that cannot be extended; each once."""
    r = random.Random(seed)
    w = periodic_words(r, 150, 2)
    tokens, left = numbered(w), [None, *w[:-1]]
    place, shared = suffix_groups(tokens, 5)
    heads = [*np.flatnonzero(shared == 0).tolist(), len(place)]
    got = [p for lo, hi in zip(heads, heads[1:]) for p in maximal_pairs(place[lo:hi].tolist(), shared[lo:hi].tolist(), left)]
    want = []
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            same = next((k for k in range(len(w) - j) if w[i + k] != w[j + k]), len(w) - j)
            if same >= max(5, 3 * (j - i), MIN_LENGTH - (j - i)) and left[i] != left[j]:
                want.append((i, j, same))
    assert sorted(got) == want


def test_least_exponent():
    with pytest.raises(ValueError):
        maximal_pairs([0, 1], [0, 5], [-1, 0], exponent=3)


@pytest.mark.parametrize("words, count", [(["a"] * 60_000, 1), (["a", "b", "c"] * 20_000, 1),
                                          ([str(k) for k in range(9_000)] * 5, 1), ([str(k) for k in range(60_000)], 0)])
def test_very_long_text(words, count):
    found = runs(numbered(words), np.array([0]))
    assert len(found) == count
    if count:
        assert next(iter(found)) == (0, len(words))


def test_defined_cases(spark):
    text = "x " + "go on " * 4 + "then stop"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, text), (4, text), (None, text), (5, prose(1, 300)), (6, "a a a a a"),
            (7, "a\na\ta a  a a"), (8, "b b b b b b b c c c c c c")]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text)
                  for r in periodic_runs(frame(spark, rows)).collect()), key=repr)
    run = [(1, 8, 2)]
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 11, run, "x go on then stop"), (4, 11, run, "x go on then stop"),
            (None, 11, run, "x go on then stop"), (5, 300, [], prose(1, 300)), (6, 5, [], "a a a a a"),
            (7, 6, [(0, 6, 1)], "a"), (8, 13, [(0, 7, 1), (7, 6, 1)], "b c")]
    assert got == sorted(want, key=repr)
    assert periodic_runs(frame(spark, [])).collect() == []


def expected(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted((s, e - s, q) for (s, e), q in brute_force(w).items())
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()),
            digest(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_plain_python(spark, tmp_path):
    r = random.Random(5)
    rows = [(k, " ".join(periodic_words(r, r.randrange(1, 120), r.choice([1, 2, 4, 30])))) for k in range(300)]
    rows += [(900, None), (901, ""), (7, rows[7][1])]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(x) for x in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(expected(*x) for x in rows)
    assert sum(x[1] > 0 for x in got) > 60


def test_query_on_given_documents(spark, documents):
    rows = [tuple(x) for x in documents.select("doc_id", "text").collect()]
    got = [tuple(x) for x in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(expected(*x) for x in rows)


def test_tails_leave_other_documents(spark):
    rows = [(k, f"a{k} b  c\nd e f g h") for k in range(60)] + [(None, "a b c d"), (3, None)]
    got = {(r.doc_id, r.text) for r in with_repeated_tails(frame(spark, rows)).collect()}
    kept = {(k, t or "") for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 10 or not t}
    assert kept <= got and len(got) == len(rows)
