import random
import re
from collections import Counter

import numpy as np

from catalog_engine.llm import repetition as R
from tests.llm.conftest import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lengths(t):
    out = [0] * len(t)
    for i in range(len(t)):
        for j in range(len(t)):
            k = 0
            while i != j and i + k < len(t) and j + k < len(t) and t[i + k] == t[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_longest_repeats():
    for s in range(300):
        r = random.Random(s)
        seen = {}
        t = [seen.setdefault(r.randint(0, s % 5), len(seen)) for _ in range(r.randint(0, 40))]
        assert R.longest_repeats(np.array(t, np.int64)).tolist() == brute_lengths(t)


def brute(i, text):
    text = text or ""
    w = WORD.findall(text)
    length = brute_lengths(w)

    def cover(m):
        return len({k for a, n in enumerate(length) if n >= m for k in range(a, a + n)})
    windows = Counter(tuple(w[a:a + 3]) for a in range(len(w) - 2))
    repeat = len({k for a in range(len(w) - 2) if windows[tuple(w[a:a + 3])] > 1 for k in range(a, a + 3)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * repeat > 50 * len(w)
    assert repeat == cover(3)
    kept = not failed and cover(R.MIN_REPEAT) <= R.MAX_COVERED * len(w) and max(length, default=0) <= R.MAX_LONGEST
    return (i, len(w), sum(map(len, w)), sum(map(text.count, R.SYMBOLS)), len(lines) - len(set(lines)), repeat,
            cover(R.MIN_REPEAT), max(length, default=0), failed, kept)


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, "a b"), (4, "a " * 300), (5, prose(1, 120) + "\x1c\x85 b\n\x0bé #$"),
            (6, (prose(2, 130, 10**6) + "\n") * 2), (6, prose(3, 60)), (7, "x\ny\nx\n x\nx ")]
    for k in range(60):
        t = prose(k, r.randint(30, 150), 10**5)
        for _ in range(r.randint(0, 3)):
            a = r.randrange(len(t))
            t += "\n" + t[a:a + r.randint(0, 400)]
        rows.append((10 + k, t))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words",
            "longest_repeat", "base_failed", "kept"]
    out = R.repetition_rules(frame(spark, rows)).collect()
    assert sorted((tuple(x[c] for c in cols) for x in out), key=repr) == sorted((brute(*x) for x in rows), key=repr)
    assert {x.kept for x in out} == {True, False} and any(x.covered_words and x.kept for x in out)
    assert all(sum(s.end - s.start for s in x.repeats) == x.covered_words for x in out)
    docs = frame(spark, rows)
    kept = R.with_verdict(docs)
    assert kept.columns == ["row", "kept"] and kept.schema["row"].dataType.names == docs.columns
    assert sorted(map(repr, ((x.row.doc_id, x.row.text, x.kept) for x in kept.collect()))) == sorted(
        map(repr, ((i, t, brute(i, t)[-1]) for i, t in rows)))


def test_long_text_and_empty_table(spark):
    t = prose(9, 60_000, 10**6)
    x = R.repetition_rules(frame(spark, [(1, t)])).first()
    assert x.n_words == 60_000 and x.kept
    assert R.repetition_rules(frame(spark, [])).count() == 0 and R.with_verdict(frame(spark, [])).count() == 0


def test_short_text_with_a_repeated_line_stays(spark):
    line = prose(11, 12, 10**6)
    text = "\n".join([line, prose(12, 40, 10**6), line, prose(13, 36, 10**6)])
    x = R.repetition_rules(frame(spark, [(1, text)])).first()
    assert (x.n_words, x.covered_words, x.base_failed, x.kept) == (100, 24, False, True)
