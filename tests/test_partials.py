"""Mergeable partials: equal to the batch statistics, after drops, replays and merges."""

import os

import pytest

from catalog_engine.operators import aggregates as AG
from catalog_engine.operators import partials as PA
from catalog_engine.operators import ranking as R
from catalog_engine.operators import trends as TR
from catalog_engine.operators.prep import clean_releases, preprocess
from catalog_engine.schemas import RAW_RELEASE
from catalog_engine.streaming.ingest import ingest_stream, read_store
from tests.test_streaming import payload, write_drop


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    x, y = ([tuple(r[c] for c in cols) for r in df.collect()] for df in (a, b))
    key = lambda r: repr([v for v in r if not isinstance(v, float)])
    x, y = sorted(x, key=key), sorted(y, key=key)
    assert len(x) == len(y)
    for r, s in zip(x, y):
        for u, v in zip(r, s):
            assert u == (pytest.approx(v, rel=1e-12) if isinstance(v, float) else v), (r, s)


def equals_batch(parts, raw):
    df, clean = preprocess(raw), clean_releases(raw)
    for entity in ("artist", "label"):
        same(PA.leaderboard(parts, entity), R.leaderboard(clean, entity))
    same(PA.label_stats(parts), AG.label_stats(df))
    stats = PA.artist_stats(parts)
    same(stats.drop("average_rating_coeff"), AG.artist_stats(df, "want", "average_want"))
    same(stats.drop("average_want"), AG.artist_stats(df, "rating_coefficient", "average_rating_coeff"))
    for family in ("genre", "style", "format"):
        same(PA.top_counts(parts, family, 50), AG.top_tokens(df, family, 50))
    same(PA.top_counts(parts, "country", 50), AG.top_values(df, "country", 50))
    same(PA.best_styles_stats(parts), R.style_stats(df))
    same(PA.style_trend(parts, 3, "Pop"), TR.style_trend(df, 3, "Pop"))
    same(PA.country_trend(parts), TR.country_trend(df))
    same(PA.label_trend(parts, 2), TR.label_trend(df, 2))
    same(PA.mean_per_year(parts).drop("release_count"), TR.gem_per_year(df))
    same(PA.mean_per_year(parts).drop("average_gem_value"), TR.releases_per_year(df))


def odd(i):
    p = payload(i)
    if i % 5 == 0:
        p["labels"] = []
    if i % 7 == 0:
        p["labels"] = [{"name": None}, {"name": "L"}, {"name": "L"}]
    if i % 6 == 0:
        p["styles"] = ["Indie", " Dub ", ""]
    if i % 4 == 0:
        p.update(country=None, genres=None, artists_sort=" ")
    if i % 11 == 0:
        p.update(year=None, released=None)
    return p


def replay_last(ckpt):
    commits = os.path.join(ckpt, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))


def test_partials_follow_the_ingest(spark, tmp):
    src, store, ckpt, parts = (f"{tmp}/{n}" for n in ("in", "store", "ckpt", "parts"))
    run = lambda: ingest_stream(spark, src, store, ckpt, partials=parts)
    write_drop(src, "drop1.json", [odd(i) for i in range(40)])
    run()
    write_drop(src, "drop2.json", [odd(i) for i in range(25, 60)] + [odd(59)])
    run()
    rows = lambda: sorted(map(repr, PA.merged(PA.read_partials(spark, parts), "family", "key", "year").collect()))
    before = rows()
    replay_last(ckpt)                                  # the last batch runs again: nothing counts twice
    run()
    held = read_store(spark, store).cache()
    assert held.count() == 60 and rows() == before
    kept = PA.merged(PA.read_partials(spark, parts), "family", "key", "year").cache()
    equals_batch(kept, spark.createDataFrame(held.collect(), held.schema).coalesce(1).cache())


def test_merged_batches(spark, tmp):
    rows = [tuple([f] + list(r)) for f, r in (("genre", ("a", 1990, 2, 2, 3.0, 1, 1.0)), ("genre", ("a", 1990, 1, 0, None, 1, 2.0)),
                                              ("genre", ("b", None, 1, 1, 1.0, 1, 1.0)))]
    path = f"{tmp}/merged"
    for n, row in enumerate(rows):
        PA.write_partials(spark.createDataFrame([row], PA.SCHEMA), path, n)
    before = sorted(map(tuple, PA.merged(PA.read_partials(spark, path), "family", "key", "year").collect()))
    assert before[0] == ("genre", "a", 1990, 3, 2, 3.0, 2, 3.0)
    PA.compact_partials(spark, path, 1)
    assert PA.merged_through(spark, path) == 1
    PA.write_partials(spark.createDataFrame([rows[0]], PA.SCHEMA), path, 0)      # covered: no second count
    os.makedirs(f"{path}/through=2")                                            # a merge that did not finish
    os.makedirs(f"{path}/batch=7")                                              # a batch that did not finish
    assert PA.merged_through(spark, path) == 1
    read = PA.read_partials(spark, path)
    assert sorted(map(tuple, PA.merged(read, "family", "key", "year").collect())) == before
    assert {f.split("/")[-2] for f in read.inputFiles()} == {"through=1", "batch=2"}
    PA.compact_partials(spark, path, 2)
    assert PA.merged_through(spark, path) == 2
    assert sorted(map(tuple, PA.merged(PA.read_partials(spark, path), "family", "key", "year").collect())) == before


def test_no_rows(spark, tmp):
    empty = PA.read_partials(spark, f"{tmp}/absent")
    assert empty.count() == 0 and PA.leaderboard(empty).count() == 0
    none = spark.createDataFrame([], RAW_RELEASE)
    assert PA.release_partials(none).count() == 0


def test_one_scan_and_one_shuffle(spark, tmp):
    raw = f"{tmp}/raw_for_partials"
    spark.createDataFrame([], RAW_RELEASE).write.parquet(raw)
    plan = PA.partials(PA.cells(preprocess(spark.read.parquet(raw))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
