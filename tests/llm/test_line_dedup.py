import random

import pytest

from catalog_engine.llm import line_dedup as L
from tests.llm.conftest import frame, prose


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def edit(text, n, r, letters="abcdé "):
    b = list(text)
    for _ in range(n):
        k, o = r.randint(0, len(b)), r.randint(0, 2)
        if o == 0:
            b.insert(k, r.choice(letters))
        elif k < len(b):
            if o == 1:
                b.pop(k)
            else:
                b[k] = r.choice(letters)
    return "".join(b)


def test_banded_distance():
    for s in range(2000):
        r = random.Random(s)
        t, a = r.randint(0, 4), "".join(r.choice("abé") for _ in range(r.randint(0, 14)))
        b = edit(a, r.randint(0, 5), r, "abé")
        assert L.within(a, b, t) == (distance(a, b) <= t), (a, b, t)


def test_lines_within_tau_share_a_key():
    for s in range(2000):
        r = random.Random(s)
        t = r.randint(1, 3)
        a = "".join(r.choice("abc") for _ in range(r.randint(t + 1, 30)))
        b = edit(a, t, r, "abc")
        if len(b) > t:
            n, k = L.line_keys([a, b], t)
            assert set(k[n == 0].tolist()) & set(k[n == 1].tolist()), (a, b, t)


def test_crowded_keys(spark, monkeypatch):
    """Long lines that share most of their text but few of which are alike."""
    from catalog_engine.llm import linking
    monkeypatch.setattr(linking, "BLOCK", 10)  # groups meet in several blocks
    r = random.Random(3)
    base = prose(1, 30)
    lines = []
    for k in range(60):
        w = base.split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"v{r.randrange(40)}"
        lines.append(edit(" ".join(w), r.choice([0, 0, 1, 2]), r))
    rows = [(k, x) for k, x in enumerate(lines)]
    got = L.line_dedup(frame(spark, rows)).collect()
    assert sorted((x.doc_id, x.kept_text) for x in got) == sorted(brute(rows, 2, 24))


def brute(rows, tau, least):
    places = [((i is None, i or 0, k), n, x) for k, (i, t) in enumerate(rows)
              for n, x in enumerate(t.split("\n") if t is not None else []) if len(x) >= least]
    lines = list(dict.fromkeys(x for _, _, x in places))
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, x in enumerate(lines):
        for y in lines[:a]:
            if abs(len(x) - len(y)) <= tau and find(x) != find(y) and distance(x, y) <= tau:
                parent[find(x)] = find(y)
    first = {}
    for p, n, x in places:
        first[find(x)] = min(first.get(find(x), (p, n)), (p, n))
    gone = {(p[2], n) for p, n, x in places if first[find(x)] != (p, n)}
    return [(i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone))
            for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("tau,least", [(1, 6), (2, 8), (3, 10)])
def test_against_all_pairs(spark, tau, least):
    r = random.Random(tau)
    pool = ["".join(r.choice("abcdé ") for _ in range(r.randint(3, 24))) for _ in range(25)]
    rows = [(i, "\n".join(edit(r.choice(pool), r.choice([0, 0, 1, 2, 3]), r) for _ in range(r.randint(0, 6))))
            for i in range(70)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, pool[0] * 400), (104, pool[0] * 400 + "x"), (None, pool[1] * 2)]
    got = L.line_dedup(frame(spark, rows), tau=tau, min_chars=least).collect()
    assert sorted(((x.doc_id, x.kept_text) for x in got), key=repr) == sorted(brute(rows, tau, least), key=repr)
    assert all(x.n_lines - x.n_dropped == (len(x.kept_text.split("\n")) if x.kept_text else x.n_lines - x.n_dropped)
               for x in got if x.kept_text is not None)


def test_ties_and_other_columns(spark):
    a, b = prose(1, 12), prose(2, 12)
    docs = frame(spark, [(1, a), (1, a), (2, a + "\n" + b), (3, b + "!\nshort\nshort"), (None, b), (None, a + "?\nend")])
    out = L.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in out.collect()), key=repr) == sorted(
        [(1, a), (1, a), (2, b), (3, "short\nshort"), (None, ""), (None, "end")], key=repr)


def test_exact_repeats_of_short_lines(spark):
    from catalog_engine.llm.queries import op8_line_dedup
    sf = "/root/testdata/sf0.001"
    a = prose(1, 12)
    rows = [(1, "All rights reserved.\n\nOf."), (2, "Of.\n" + a + "\n \n\n}"), (3, "All rights reserved\n" + a + "!\n}\nOf.\n")]
    got = {r.doc_id: r.kept_text for r in L.line_dedup(frame(spark, rows), every_repeat=True).collect()}
    assert got == {1: rows[0][1], 2: a + "\n \n\n}", 3: "All rights reserved\n"}
    texts = {r.doc_id: (r.text or "").split("\n") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    gone = {r.doc_id: set(r.dropped) for r in op8_line_dedup(spark, sf).collect()}
    seen, repeats = set(), 0
    for i in sorted(texts):
        for n, x in enumerate(texts[i]):
            if len(x) < L.MIN_CHARS:
                assert (n in gone[i]) == (x in seen and x.strip() != ""), (i, n, x)
                repeats += n in gone[i]
                seen.add(x)
    assert repeats


def test_empty_table_and_parameters(spark):
    assert L.line_dedup(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        L.line_dedup(frame(spark, []), tau=3, min_chars=3)


def test_common_lines_are_salted(spark):
    from pyspark.sql import functions as F
    common, alike, rare = prose(1, 12), prose(1, 12) + "!", [prose(s, 9) for s in range(2, 200)]
    rows = [(i, "\n".join([common if i % 3 else alike, rare[i % 198], "x"])) for i in range(600)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = L.line_dedup(frame(spark, rows)).collect()
        assert sorted((x.doc_id, x.kept_text) for x in got) == sorted(brute(rows, L.TAU, L.MIN_CHARS))
        lines = spark.range(1000).selectExpr("if(id < 400, 0, id) AS key", "id")
        values = lines.groupBy("key").agg(F.min("id").alias("first"), F.count("id").alias("rows"))
        met = L._meeting(lines, values, "key", 1000)
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 400, "the rows of key 0 meet in one task"
        assert sorted(map(tuple, met.collect())) == sorted((0 if i < 400 else i, i, 0 if i < 400 else i) for i in range(1000))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
