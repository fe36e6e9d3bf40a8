import hashlib
import random

from catalog_engine.llm import fingerprints as P
from tests.llm.conftest import frame, prose


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", (order[(k + 1) % len(order)][1] or "")
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]

        def near(a, b):
            a, b = set(P.digests(a)), set(P.digests(b))
            return len(a & b) / len(a | b) if a | b else 1.0
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), P.Sketch(P.CELLS).add(P.digests(t)).text(),
                    P.Sketch(P.CELLS).add(P.digests(new)).text(), near(t, new), near(t, nxt)))
    return sorted(out, key=repr)


def check(spark, rows):
    got = [tuple(r) for r in P.edited_fingerprints(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_against_sets(spark):
    r = random.Random(1)
    lines = [prose(k, 5) for k in range(40)]
    rows = [(r.randrange(-10**18, 10**18), "\n".join(r.choice(lines) for _ in range(r.randint(0, 90)))) for _ in range(300)]
    rows += [(5, None), (6, ""), (7, "\n \n"), (8, "日本" * 50 + "\nx"), (None, "a\nb"), (None, None), (9, "q"), (9, "r")]
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(1, "a\nb\nc")])
    check(spark, [(None, "a\nb\nc"), (None, "d")])
    check(spark, [(1, "a\nb\nc"), (2, None), (2, "zz")])
    assert P.edited_fingerprints(frame(spark, [])).count() == 0


def test_peeling_recovers_differences_and_retries():
    for s in range(300):
        r = random.Random(s)
        a = [r.getrandbits(64) for _ in range(r.randint(0, 200))]
        b = [x for x in a if r.random() < .7] + [r.getrandbits(64) for _ in range(r.randint(0, 50))]
        left, right = P.difference(a, b, P.Sketch(18).add(a), P.Sketch(18).add(b))
        assert (set(left), set(right)) == (set(a) - set(b), set(b) - set(a))


def test_fingerprint_reads_back(spark):
    row = P.fingerprints(frame(spark, [(1, "a\nb\na")])).first()
    items = [d + (1 << 63) for d in row.digests]
    assert len(set(items)) == 3
    assert sorted(P.from_text(row.fingerprint).peel()[0]) == sorted(items)
