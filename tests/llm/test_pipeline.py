from pyspark.sql import functions as F

import corpus_pipeline as P
from catalog_engine.llm import repetition as R
from catalog_engine.llm.piece_bpe import read_model, tokenizer
from catalog_engine.llm.queries import PIECE_MODEL
from tests.llm.conftest import frame, prose

SF = "/root/testdata/sf0.001"


def test_stage_by_stage(spark, documents, tmp):
    docs, kept = documents, []
    for n, (name, stage) in enumerate(P.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp}/{n}")
        docs = spark.read.parquet(f"{tmp}/{n}")
        kept.append((name, before, docs.collect()))
        if n < len(P.STAGES) - 1:
            assert docs.dtypes == documents.dtypes
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = kept
    verdict = {r.doc_id: r.kept for r in R.repetition_rules(documents).collect()}
    assert {r.doc_id for r in b} == {i for i, k in verdict.items() if k} and len(b) < len(a)
    assert {r.doc_id for r in c} == {r.doc_id for r in b}
    assert sum(len(r.text) for r in c) < sum(len(r.text) for r in b) and all(r.n_chars == len(r.text) for r in c)
    seen = set()
    for r in sorted(c, key=lambda r: r.doc_id):  # no long line twice
        for line in r.text.split("\n"):
            assert len(line) < 24 or line not in seen
            seen.add(line)
    from catalog_engine.llm.near_dedup import near_dedup
    source = spark.createDataFrame(c, documents.schema)
    classes = {r.doc_id: r.class_id for r in near_dedup(source).collect()}
    assert sorted(r.doc_id for r in d) == sorted(set(classes.values()))
    assert {r.doc_id for r in e} <= {r.doc_id for r in d} and max(sum(r.doc_id == x.doc_id for r in e) for x in e) <= 3
    bpe = tokenizer(read_model(PIECE_MODEL))
    texts = {r.doc_id: r.text for r in d}
    assert len(f) == len(e) and all(r.ids == bpe.encode(texts[r.doc_id]).tolist() for r in f)


def test_no_column_name_clashes(spark, tmp):
    """Columns by any name that a stage uses inside keep their values."""
    names = ["kept", "_id", "_n", "_r", "_copies", "_copy", "_md5", "_node", "row", "label", "node", "i", "m", "n", "r", "copies",
             "first", "salt", "doc", "dropped", "size", "start", "missing", "name", "shard", "text_md5", "source_size"]
    docs = frame(spark, [(k, prose(k, 90), "ab"[k % 2]) for k in range(12)])
    docs = docs.select(*[c for c in docs.columns if c not in names], *[F.concat_ws("-", F.lit(n), "doc_id").alias(n) for n in names])
    for n, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp}/{n}")
        docs = spark.read.parquet(f"{tmp}/{n}")
        rows = docs.collect()
        assert len(rows) >= 6 and all(r[x] == f"{x}-{r.doc_id}" for r in rows for x in names)


def test_run_and_odd_rows(spark, tmp):
    assert P.run(spark, SF).count() > 100
    rows = [(1, None), (2, ""), (None, prose(1, 80)), (3, prose(2, 90)), (3, prose(2, 90)), (4, prose(2, 90)), (5, "a b")]
    docs = frame(spark, rows)
    for n, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp}/{n}")
        docs = spark.read.parquet(f"{tmp}/{n}")
    assert docs.filter("decoded is null").count() == 0
    empty = frame(spark, [], 1)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
        empty = empty if "text" not in empty.columns else spark.createDataFrame([], empty.schema)
