"""Ranked tables, postings search, trigram candidates and exact quantiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_engine.operators import etl as ET
from catalog_engine.operators import positions as PO
from catalog_engine.operators import prep as PR
from catalog_engine.operators.quantiles import exact_median, exact_quantiles


def files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(3)
    rows = [(k, f"Artist {k % 17} - Song {r.randrange(400)}", ", ".join(r.sample(["Rock", "Jazz", "Dub", ""], r.randint(1, 3))),
             r.choice(["A, B", "A", "B, C", None]), r.choice(["LP", "CD, LP"]), r.choice(["1995", "1996", "1997", "x", None, "1996.5"]),
             r.choice([None, 1.5, 2.25, 3.0, 4.5]), "Label é") for k in range(3000)]
    df = spark.createDataFrame(rows, "id long, title string, genre string, style string, format string, year string, "
                                     "average_rating double, label string").repartition(5)
    path = str(tmp_path_factory.mktemp("index"))
    fields = {**ET.search_fields(), **PR.text_fields()}
    PO.write_index(df, ET.search_order("rating", "desc"), fields, path, partitions=6)
    return df.cache(), path


CRITERIA = [dict(genres=["Rock"]), dict(genres=["Rock", "Dub"], formats=["CD"]), dict(styles=["C"], year="1996"),
            dict(year="1995-1997", formats=["LP"]), dict(genres=["none"]), dict(genres=[""]), dict(), dict(year="19x6", styles=["A"])]


@pytest.mark.parametrize("criteria", CRITERIA)
def test_postings_give_the_same_pages_and_totals(spark, index, monkeypatch, criteria):
    df, path = index
    terms = ET.search_terms(**criteria)
    total = ET.search_state(df, per_page=40, **criteria).first()["total_items"]
    assert PO.search_total(spark, path, terms).first()["total_items"] == total
    for page in (1, 2, total // 40 + 1, total // 40 + 2):
        want = [r.id for r in ET.search(df, sort="rating", order="desc", per_page=40, page=page, **criteria).collect()]
        got = [r.id for r in PO.search_page(spark, path, terms, page, 40).orderBy("position").collect()]
        assert got == want


def test_blocks_smaller_than_the_table(spark, index, tmp_path, monkeypatch):
    df, _ = index
    monkeypatch.setattr(PO, "BLOCK_BITS", 6)
    path = str(tmp_path / "i")
    PO.write_index(df, ET.search_order("title", "asc"), ET.search_fields(), path, partitions=4)
    terms = ET.search_terms(genres=["Jazz"], year="1996")
    assert PO.matches(spark, path, terms).count() > 20
    for page in (1, 3, 6):
        want = [r.id for r in ET.search(df, sort="title", order="asc", genres=["Jazz"], year="1996", per_page=30, page=page).collect()]
        assert [r.id for r in PO.search_page(spark, path, terms, page, 30).orderBy("position").collect()] == want


def test_a_deep_page_opens_one_partition(spark, index):
    df, path = index
    ranked = PO.Ranked(spark, f"{path}/ranked")
    assert ranked.total == 3000 and len(ranked.starts) == 6
    assert len(files_read(ranked.rows())) == 6
    part, start, size = ranked.starts[4]
    inside = ranked.between(start + 3, start + 12)
    assert len(files_read(inside)) == 1 and [r.position for r in inside.orderBy("position").collect()] == list(range(start + 3, start + 13))
    order = [r.id for r in df.orderBy(*ET.search_order("rating", "desc")).select("id").collect()]
    assert [(r["rank"], r.id) for r in ranked.page(61, 40).collect()] == [(k + 1, order[k]) for k in range(2400, 2440)]
    across = ranked.between(start - 2, start + 1)
    assert len(files_read(across)) == 2 and across.count() == 4
    assert ranked.page(10 ** 5, 40).count() == 0


def test_search_reads_neither_all_postings_nor_the_store(spark, index):
    df, path = index
    terms = ET.search_terms(genres=["Dub"], formats=["CD"])
    plan = PO.search_total(spark, path, terms)._jdf.queryExecution().executedPlan().toString()
    assert "/ranked" not in plan and "PushedFilters" in plan and "EqualTo(field,genre)" in plan
    rows = PO.search_page(spark, path, terms, 1, 10)
    assert len(files_read(rows)) < 6


@pytest.mark.parametrize("query", ["song 12", "ARTIST 3 ", "rtist 16 - song 1", "no such text", "12", "", "é", "song song"])
def test_trigram_candidates_lose_nothing(spark, index, query):
    df, path = index
    found = PR.text_candidates(spark, path, query)
    want = sorted(r.id for r in PR.filter_releases(df, "artist", query).collect())
    assert sorted(r.id for r in PR.filter_releases(found, "artist", query).collect()) == want
    if len(query.strip()) >= 7:
        assert found.count() < 1500


def test_rows_of_postings_are_short_and_whole(spark, tmp_path):
    """A token that all rows share is read in short rows, in the order of the places."""
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 == 0, "rare, all").otherwise("all").alias("genre"))
    PO.write_index(df, [F.col("id").asc()], {"genre": F.split("genre", ", ")}, str(tmp_path / "i"), 3)
    rows = spark.read.schema(PO.POSTINGS).parquet(f"{tmp_path}/i/postings").collect()
    assert max(len(r.places) for r in rows) <= 1024 and all(r.places == sorted(r.places) for r in rows)
    assert {t: sorted(x for r in rows if r.token == t for x in r.places) for t in ("all", "rare")} == {
        "all": list(range(5000)), "rare": list(range(0, 5000, 7))}
    terms = [("genre", ["all"]), ("genre", ["rare"])]
    assert PO.search_total(spark, f"{tmp_path}/i", terms).first()[0] == 715
    assert [r.id for r in PO.search_page(spark, f"{tmp_path}/i", terms, 20, 20).orderBy("position").collect()] == list(range(7 * 380, 7 * 400, 7))


def test_grams(spark):
    df = spark.createDataFrame([("abcd",), ("ab",), ("",), (None,), ("𝄞éxé𝄞éx",)], "t string")
    got = {r.t: r.g for r in df.select("t", PO.grams(F.col("t")).alias("g")).collect()}
    assert got == {"abcd": ["abc", "bcd"], "ab": [], "": [], None: [], "𝄞éxé𝄞éx": ["𝄞éx", "éxé", "xé𝄞", "é𝄞é"]}


def test_empty_index(spark, tmp_path):
    df = spark.createDataFrame([], "id long, title string, genre string, style string, format string, year string, average_rating double")
    PO.write_index(df, [F.col("id").asc()], ET.search_fields(), str(tmp_path / "i"))
    assert PO.search_total(spark, str(tmp_path / "i"), [("genre", ["a"])]).first()[0] == 0
    assert PO.search_total(spark, str(tmp_path / "i"), []).first()[0] == 0
    assert PO.search_page(spark, str(tmp_path / "i"), [("genre", ["a"])], 1, 5).count() == 0


@pytest.mark.parametrize("buckets", [32, 1024])
def test_quantiles_equal_numpy(spark, buckets):
    r = np.random.default_rng(2)
    groups = {"even": r.normal(size=301), "few": r.integers(0, 4, 500).astype(float), "one": np.array([7.5]),
              "wide": np.array([-1e308, 1e308, 0.0, 1e-300, -5.0, 3.0]), "steep": 10.0 ** r.integers(-30, 30, 200), "same": np.full(9, 2.0)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("even", None), ("even", float("nan")), (None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {x.g: x for x in exact_quantiles(df, "v", probs, "g", buckets).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        v = np.sort(v)
        at = np.array(probs) * (len(v) - 1)
        lo, hi = np.floor(at).astype(int), np.ceil(at).astype(int)
        want = np.where(lo == hi, v[lo], (np.ceil(at) - at) * v[lo] + (at - np.floor(at)) * v[hi])
        assert got[g].n == len(v) and got[g].quantiles == pytest.approx(want.tolist(), rel=1e-12)


def test_infinite_values_and_no_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (inf, -inf, 3.0, inf, 4.0)], "v double")
    assert exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75], buckets=4).first()["quantiles"] == [-inf, 3.0, 4.0, inf]
    assert exact_median(df.filter("false"), "v") is None
    assert [tuple(x) for x in exact_quantiles(df.filter("false"), "v", [0.5]).collect()] == [(0, None)]
    assert exact_quantiles(df.filter("false").withColumn("g", F.lit(1)), "v", [0.5], "g").count() == 0


def test_a_million_distinct_values_in_one_group(spark):
    df = spark.range(1_000_000).select((F.col("id") % 3 == 0).alias("g"), (F.pow(F.col("id") + 0.5, 1.5) * 0.001).alias("v"))
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    v = np.sort((np.arange(1_000_000) + 0.5) ** 1.5 * 0.001)
    assert got.n == 1_000_000 and got.quantiles == pytest.approx(np.quantile(v, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)


def test_no_value_map_in_the_plans(spark, tmp_path):
    from catalog_engine.operators import aggregates as AG, distributions as D, ranking as R
    df = spark.createDataFrame([(k, f"S{k % 5}", "A, B", float(k % 9), k % 4) for k in range(60)],
                               "id long, genre string, style string, rating_coefficient double, num_tracks int")
    for out in (D.box_stats(df, "genre", "num_tracks"), R.best_styles(df), exact_quantiles(df, "num_tracks", [0.5])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile(" not in plan and "median(" not in plan
