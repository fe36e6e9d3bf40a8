import random

import numpy as np

from catalog_engine.llm import near_dedup as N
from tests.llm.conftest import frame, prose


def weights(text):
    w, out = text.split(), {}
    for k in range(max(1, len(w) - 4)) if w else ():
        s = tuple(w[k:k + 5])
        out[s] = out.get(s, 0) + 1
    return out


def jp(a, b):
    total = 0
    for d in set(a) & set(b):
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
    return total


def changed(text, n, seed):
    w, r = text.split(), random.Random(seed)
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.random()}"
    return " ".join(w)


def sim(a, b):
    def one(t):
        _, name, count = N.shingles([t])
        o = np.argsort(name)
        return name[o], count[o].astype(float)
    return N.similarity(one(a), one(b))


def test_probability_jaccard_is_exact():
    for s in range(60):
        a = prose(s, random.Random(s).randint(1, 60), 4)
        b = changed(a, s % 7, s) if s % 2 else prose(s + 99, 40, 4)
        assert abs(sim(a, b) - jp(weights(a), weights(b))) < 1e-9


def test_registers_estimate_the_similarity():
    a = prose(1, 300)
    texts = [a] + [changed(a, n, n) for n in (2, 6, 12, 30)] * 20
    for k in range(20):
        texts[1 + 4 * k:5 + 4 * k] = [changed(a, n, 100 * k + n) for n in (2, 6, 12, 30)]
    reg, has = N.signatures(texts)
    got = [(reg[0] == r).mean() for r in reg[1:]]
    want = [sim(a, t) for t in texts[1:]]
    assert has.all() and abs(np.mean(got) - np.mean(want)) < 0.02
    assert np.abs(np.array(got) - want).max() < 0.2
    assert (N.signatures(["a b c"])[0] == N.signatures(["q r s t u v", "a b c"])[0][1]).all()


def brute(rows):
    n, parent = len(rows), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    w = [weights(t or "") for _, t in rows]
    for i in range(n):
        for j in range(i):
            if None not in (rows[i][1], rows[j][1]) and (rows[i][1] == rows[j][1] or jp(w[i], w[j]) >= 0.8):
                parent[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, low.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def test_classes_against_all_pairs(spark):
    r = random.Random(2)
    rows = []
    for g in range(8):
        t = prose(g, r.randint(20, 60))
        for k in range(r.randint(1, 8)):
            t = changed(t, r.randint(0, 2), 50 * g + k)  # chains: the ends need not be alike
            rows.append((r.randint(0, 10**6), t))
    hot = prose(77, 80)
    rows += [(2000000 + k, changed(hot, 1, k)) for k in range(40)] + [(3000000 + k, hot) for k in range(20)]
    rows += [(7, "a b c"), (8, "a  b c"), (9, "a b"), (10, ""), (11, ""), (12, None), (13, None), (None, "a b c"),
             (14, " \n"), (15, "z " * 2000), (16, "z " * 1990), (17, hot), (17, hot)]
    got = sorted(((x.doc_id, x.class_id) for x in N.near_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_groups_that_meet_in_blocks(spark, monkeypatch):
    from catalog_engine.llm import linking
    monkeypatch.setattr(linking, "BLOCK", 8)
    base = prose(3, 120)
    rows = [(k, changed(base, k % 9, k)) for k in range(90)]
    got = sorted(((x.doc_id, x.class_id) for x in N.near_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_recall_over_all_pairs_of_the_given_documents(spark, documents):
    """Every pair of different texts at the threshold or above, found by a plain
    inverted index of shingles, shares a class."""
    from collections import defaultdict
    base = prose(11, 600)
    texts = sorted({r.text for r in documents.collect() if r.text} | {changed(base, n, n) for n in range(1, 16)})
    by = defaultdict(list)
    for k, t in enumerate(texts):
        for x in weights(t):
            by[x].append(k)
    pairs = {(a, b) for ks in by.values() if len(ks) < 100 for a in ks for b in ks if a < b}
    alike = [(a, b) for a, b in pairs if sim(texts[a], texts[b]) >= 0.8]
    got = {r.doc_id: r.class_id for r in N.near_dedup(frame(spark, list(enumerate(texts)))).collect()}
    assert len(alike) >= 20
    assert sum(got[a] == got[b] for a, b in alike) >= 0.99 * len(alike)


def test_probability_of_a_miss():
    """By calculation, at the threshold: bands and register test together."""
    from math import comb
    bands = (1 - N.SIMILARITY ** N.ROWS) ** N.BANDS
    n, p = N.REGISTERS, N.SIMILARITY
    least = int(n * p - N.DEVIATIONS * (n * p * (1 - p)) ** 0.5)
    test = sum(comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(least))
    assert bands + test < 1e-4


def test_files_of_finished_steps_are_deleted(spark):
    import os
    from urllib.parse import urlparse
    from catalog_engine.llm.common import cut, forget
    one = cut(spark.range(3))
    root = urlparse(spark.sparkContext._jsc.sc().getCheckpointDir().get()).path
    before = set(os.listdir(root))
    forget(one)
    assert len(before - set(os.listdir(root))) == 1
    base, before = prose(3, 120), set(os.listdir(root))
    N.near_dedup(frame(spark, [(k, changed(base, k % 4, k)) for k in range(60)])).collect()
    assert len(set(os.listdir(root)) - before) <= 2  # the labels, which the result reads


def test_one_document_of_each_class_stays(spark):
    t = prose(5, 100)
    rows = [(4, t), (3, changed(t, 1, 1)), (5, t), (5, t), (9, "other text"), (None, None), (8, None), (9, "other text")]
    docs = frame(spark, rows)
    out = N.without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((x.doc_id for x in out.collect()), key=repr) == sorted([3, 9, None, 8], key=repr)


def test_no_rows_and_no_links(spark):
    assert N.near_dedup(frame(spark, [])).count() == 0
    assert [x.class_id for x in N.near_dedup(frame(spark, [(1, "q")])).collect()] == [1]
