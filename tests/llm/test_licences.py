from catalog_engine.llm import licences as L
from tests.llm.conftest import frame, prose


def test_finds_families_and_leaves_the_rest(spark, documents):
    model = L.train(documents)
    assert 0 <= model.least < 1
    assert all(any(x in t.lower() for x in L.STEMS) for ts in L.TEMPLATES.values() for t in ts)
    rows = [(k, prose(k, 30) + "\n" + t + "\nend") for k, t in enumerate(t for ts in L.TEMPLATES.values() for t in ts)]
    truth = {k: f for k, f in enumerate(f for f, ts in L.TEMPLATES.items() for _ in ts)}
    others = [(1000 + k, t) for k, t in enumerate(L.OTHERS)] + [
        (2000, None), (2001, ""), (2002, "a license"), (2003, "This game is licensed to nobody in particular."), (None, "x y")]
    out = L.find_licences(frame(spark, rows + others), model=model).collect()
    named = {r.doc_id: r.family for r in out if r.family != L.UNKNOWN}
    right = sum(named.get(k) == f for k, f in truth.items())
    assert right >= 0.9 * len(truth), {k: (named.get(k), f) for k, f in truth.items() if named.get(k) != f}
    assert all(truth.get(k, named[k]) == named[k] for k in named)
    assert not [k for k in named if k is None or k >= 1000]
    assert all(r.paragraph == 1 for r in out if r.doc_id < 1000)


def test_corpus_paragraphs(spark, documents):
    """Every licence line of the corpus is found, and nothing else is named."""
    found = {(r.doc_id, r.paragraph): r.family for r in L.find_licences(documents).collect() if r.family != L.UNKNOWN}
    lines = {(r.doc_id, k): x for r in documents.collect() for k, x in enumerate((r.text or "").split("\n"))}
    want = {t: f for f, ts in L.TEMPLATES.items() for t in ts}
    expected = {k: want[x] for k, x in lines.items() if x in want}
    assert {k: f for k, f in found.items() if lines[k] in want} == expected and expected
    assert all("licen" in lines[k].lower() or "rights" in lines[k] for k in found)


def test_empty_table(spark):
    assert L.find_licences(frame(spark, [], 1)).count() == 0


def test_every_paragraph_is_judged(spark, documents, monkeypatch):
    """Notices without a licence word are found, and what is left out before the
    model runs is what the model calls 'none'."""
    model = L.train(documents)
    notices = {1: ("All rights reserved.", "Proprietary"), 2: ("ALL RIGHTS RESERVED", "Proprietary"),
               3: ("Apache 2.0, released under the Apache 2.0 terms.", "Apache-2.0"), 4: ("Released under CC BY 4.0.", "CC-BY")}
    others = ["All seats are reserved for members.", "to " * 300, "of the " * 200, "Released under pressure.", "", None,
              prose(1, 3000) + " is to be used by any of this or that source", "a", "rights " * 8, "under"]
    rows = [(k, prose(k, 20) + "\n" + t) for k, (t, _) in notices.items()] + [(100 + k, t) for k, t in enumerate(others)]
    docs = documents.select("doc_id", "text").unionByName(frame(spark, rows).selectExpr("doc_id - 1000 AS doc_id", "text"))
    key = lambda df: sorted((r.doc_id, r.paragraph, r.family, r.guess, round(r.probability, 9), r.template_share)
                            for r in df.collect())
    found = key(L.find_licences(docs, model=model))
    guesses = {i + 1000: g for i, _, _, g, _, _ in found if i < 0}
    assert {k: guesses.get(k) for k in notices} == {k: f for k, (_, f) in notices.items()}
    named = {i + 1000: f for i, _, f, _, _, _ in found if i < 0 and f != L.UNKNOWN}
    assert named[1] == named[2] == "Proprietary" and not [k for k in named if k >= 100]
    lines = [(r.doc_id, k) for r in documents.collect() for k, x in enumerate((r.text or "").split("\n"))
             if x == "All rights reserved."]
    assert {(i, k) for i, k, f, _, _, _ in found if f == "Proprietary"} >= set(lines)
    skipped = L.paragraphs(docs, "doc_id", "text").filter(~model.possible("text")).count()
    assert skipped > 100  # the shortcut is in use
    monkeypatch.setattr(L.LicenceModel, "possible", lambda self, text: L.F.lit(True))
    assert key(L.find_licences(docs, model=model)) == found


def test_long_paragraphs_have_the_same_grams(spark):
    w = prose(3, 40).split()
    row = spark.createDataFrame([(w, w[:1], [])], "a array<string>, b array<string>, c array<string>")
    for n in (1, 2, 3):
        got = row.select(*[L.grams(c, n).alias(c) for c in "abc"]).first()
        assert got.a == [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
        assert got.b == ([w[0]] if n == 1 else []) and got.c == []
