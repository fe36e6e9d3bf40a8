import hashlib
import random

import numpy as np
import pytest

from catalog_engine.llm import substring_dedup as S
from tests.llm.conftest import frame, prose


def brute(rows, k):
    big = 1 << 63
    words = [(t or "").encode().split() for _, t in rows]
    low = {}
    for (i, _), w in zip(rows, words):
        i = big if i is None else i
        for a in range(len(w) - k + 1):
            x = tuple(w[a:a + k])
            low[x] = min(low.get(x, big + 1), i)
    out = []
    for (i, t), w in zip(rows, words):
        me, gone = big if i is None else i, set()
        for a in range(len(w) - k + 1):
            if low[tuple(w[a:a + k])] < me:
                gone |= set(range(a, a + k))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k", [2, 5, 13])
def test_against_brute_force(spark, k):
    r = random.Random(k)
    base = prose(1, 60, 30).split()
    rows = []
    for i in range(120):
        w = prose(i + 10, r.randint(0, 60), 30).split()
        for _ in range(r.randint(0, 2)):
            a = r.randrange(60)
            at = r.randint(0, len(w))
            w[at:at] = base[a:a + r.randint(1, 40)]
        rows.append((r.randint(0, 90), r.choice([" ", "\n", "\t ", "\x0b"]).join(w)))
    rows += [(None, " ".join(base)), (None, " ".join(base)), (5, None), (6, ""), (7, " \n "), (200, "a " * 3000),
             (201, "a " * 40), (8, " ".join(base)), (8, " ".join(base)), (9, "é x " * 20), (10, "é x " * 20)]
    assert got(S.substring_dedup(frame(spark, rows), k=k)) == brute(rows, k)


def test_spans_cover_the_removed_words(spark):
    t = prose(3, 40)
    rows = [(1, t), (2, "x y " + t + " z"), (3, prose(4, 30))]
    out = {r.doc_id: r for r in S.substring_dedup(frame(spark, rows)).collect()}
    assert [(s.start, s.end) for s in out[2].removed] == [(2, 42)] and out[2].kept_text == "x y z"
    assert out[1].removed == [] and out[3].n_removed == 0


def test_empty_table(spark):
    assert S.substring_dedup(frame(spark, [])).count() == 0


def test_hash_ties_are_sorted_by_words():
    text = b"a b c d a b"
    at, end = np.array([0, 4, 8]), np.array([3, 7, 11])
    out = S.smallest_documents(text, at, end, np.zeros(3, np.uint64), np.array([5, 6, 3]))
    assert out.tolist() == [3, 6, 3]


def test_long_runs_are_cut(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_RUN", 3)
    strings = [b"a " * 50 + b"b", b"", b"x y z"]
    out = list(S.super_kmers(strings, 2))
    assert sum(n for _, _, n, _, _ in out) == 50 + 2 and max(n for _, _, n, _, _ in out) <= 3
    assert all(t.count(b" ") == n for _, _, n, _, t in out)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    from catalog_engine.llm.queries import op1_substring_dedup
    want = {(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows, 13)}
    assert {tuple(r)[:4] for r in op1_substring_dedup(spark, "/root/testdata/sf0.001").collect()} == want
