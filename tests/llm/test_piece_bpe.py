import hashlib
import random

import numpy as np
import pytest

from catalog_engine.llm import piece_bpe as B
from catalog_engine.llm.queries import PIECE_MODEL, op4_piece_bpe
from tests.llm.conftest import frame


@pytest.fixture(scope="module")
def both():
    from sentencepiece import SentencePieceProcessor
    model = B.read_model(PIECE_MODEL)
    return B.tokenizer(model), SentencePieceProcessor(model_proto=model)


def samples(n):
    letters = "abcdefgh iIt\n\t  ▁éü😀日本語ขthe and ing\x00\r.,<s>0x0A²"
    for s in range(n):
        r = random.Random(s)
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 80)))
        yield " " * r.randint(0, 40) + t + "  " * r.randint(0, 20) if s % 3 == 0 else t
    yield from ("", " ", "▁", "\n", "a" * 50_000, " " * 5000, "word " * 4000, "é" * 3000)


def test_same_ids_and_text_as_the_library(both):
    mine, lib = both
    for t in samples(3000):
        ids = mine.encode(t)
        assert ids.tolist() == lib.encode(t), repr(t[:80])
        assert mine.decode(ids) == lib.decode(lib.encode(t)), repr(t[:80])


def test_decoding_of_any_ids(both):
    mine, lib = both
    for s in range(3000):
        r = random.Random(s)
        ids = [r.choice([r.randrange(3, 259), r.randrange(32000), 29871]) for _ in range(r.randint(1, 12))]
        assert mine.decode(np.array(ids, np.int32)) == lib.decode(ids), ids


def test_small_caches_change_nothing(both, monkeypatch):
    _, lib = both
    monkeypatch.setattr(B, "CACHE_WORDS", 10)
    mine = B.PieceBpe(B.read_model(PIECE_MODEL))
    assert all(mine.encode(t).tolist() == lib.encode(t) for t in samples(200))


def test_words_of_a_task_are_cut_once(both):
    """A task's documents have some hundred thousand different words; those that come again are known."""
    _, lib = both
    mine, r = B.PieceBpe(B.read_model(PIECE_MODEL)), random.Random(3)
    words = list({"".join(r.choices("abcdefghiklmnoprstu", k=6)) for _ in range(200_000)})
    text, cut = " ".join(words), []
    ids, word = mine.encode(text), mine._word
    mine._word = lambda w: cut.append(w) or word(w)
    assert (mine.encode(text) == ids).all() and not cut
    assert ids[:1000].tolist() == lib.encode(text)[:1000]


def test_whole_table(spark, documents, both):
    _, lib = both
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op4_piece_bpe(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = set()
    for r in documents.collect():
        ids = lib.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    assert got == want


def test_defined_cases(spark):
    out = B.encode_texts(frame(spark, [(1, None), (2, ""), (None, "a▁b"), (2, "")]), PIECE_MODEL).collect()
    assert sorted(((r.doc_id, len(r.ids) > 0, r.decoded) for r in out), key=repr) == sorted(
        [(1, False, ""), (2, False, ""), (2, False, ""), (None, True, "a b")], key=repr)
    docs = frame(spark, [(1, "x y"), (2, None)])
    rows = B.encode_rows(docs, PIECE_MODEL)
    assert rows.columns == [c for c in docs.columns if c != "text"] + ["ids", "decoded"]
    assert {r.doc_id: r.decoded for r in rows.collect()} == {1: "x y", 2: ""}
    assert B.encode_texts(frame(spark, []), PIECE_MODEL).count() == 0
