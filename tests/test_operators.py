"""Operators on hand-written rows: semantics, properties and golden values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_engine.operators import aggregates as AG
from catalog_engine.operators import distributions as D
from catalog_engine.operators import etl as ET
from catalog_engine.operators import ranking as R
from catalog_engine.operators import stats as ST
from catalog_engine.operators import store as IO
from catalog_engine.operators.prep import clean_releases, filter_releases, preprocess
from catalog_engine.schemas import CLEAN_RELEASE, RAW_RELEASE


def raw_rows(spark, rows):
    """Raw releases from partial dicts (missing fields null)."""
    names = [f.name for f in RAW_RELEASE.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW_RELEASE)


def test_label_stats_edge_rows(spark):
    labels = ["[]", None, "bad", "null", '{"name":"x"}', '[{"catno":"1"}]', '[{"name":null}]',
              '[{"name":"L"},{"name":"L"}]', '[{"name":"M"}, 5]']
    df = raw_rows(spark, [dict(id=i, year="2000", want=10 * i, rating_coefficient=float(i), labels=lab)
                          for i, lab in enumerate(labels)])
    st = {r["label_name"]: r for r in AG.label_stats(preprocess(df)).collect()}
    # ids 0..5 and the non-object member of id 8 are 'Unknown'; id 6 is dropped; L counts twice
    assert st["Unknown"]["release_count"] == 7
    assert st["L"]["release_count"] == 2 and st["L"]["average_want"] == 70.0
    assert st["M"]["release_count"] == 1
    assert None not in st
    assert st["Unknown"]["average_want"] == pytest.approx(np.mean([0, 10, 20, 30, 40, 50, 80]))


def test_preprocess_edge_rows(spark):
    df = raw_rows(spark, [
        dict(id=1, year="1999", released=None, genre=None, average_rating=None),
        dict(id=2, year="0"), dict(id=3, year="Unknown", released="1998-01-01"),
        dict(id=4, year=None, released="1998-03-01", tracklist='[{"duration":"5:30"}]'),
        dict(id=5, year=None, released=None),
    ])
    out = {r["id"]: r for r in preprocess(df).collect()}
    assert sorted(out) == [1, 4]
    assert out[1]["genre"] == "Unknown" and out[1]["average_rating"] == 0.0 and out[1]["num_tracks"] == 0
    assert out[4]["year"] == 1998 and out[4]["total_duration_min"] == 5.5 and out[4]["num_tracks"] == 1


def test_top_tokens_counts_and_ties(spark):
    df = raw_rows(spark, [dict(id=1, genre="Folk, World, & Country"), dict(id=2, genre="Rock, Folk"),
                          dict(id=3, genre=""), dict(id=4, genre="Rock")])
    got = [tuple(r) for r in AG.top_tokens(df, "genre", 10).collect()]
    assert got == [("Folk", 2), ("Rock", 2), ("", 1), ("& Country", 1), ("World", 1)]
    got = [tuple(r) for r in AG.top_tokens(df, "genre", 2, exclude=["Folk"]).collect()]
    assert got == [("Rock", 2), ("", 1)]


def test_term_frequencies(spark):
    df = raw_rows(spark, [dict(id=1, style="Deep House, House"), dict(id=2, style="Drum n Bass, Techno")])
    got = {r["term"]: r["frequency"] for r in AG.term_frequencies(df, "style", exclude=["Techno"]).collect()}
    assert got == {"deep": 1, "house": 2, "drum": 1, "bass": 1}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.gamma(2.0, 3.0, 2000), [0.0, 0.0, 37.5]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    for k in (1, 7, 20, 30):
        h = sorted(D.histogram(df, "v", k).collect(), key=lambda r: r["bin"])
        counts, edges = np.histogram(x, bins=k)
        assert [r["count"] for r in h] == counts.tolist()
        assert [r["bin_start"] for r in h] == pytest.approx(edges[:-1].tolist())
        assert sum(r["count"] for r in h) == len(x)


def test_histogram_constant_and_empty_bins(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "v double")
    h = sorted(D.histogram(df, "v", 4).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in h] == np.histogram([5.0] * 3, bins=4)[0].tolist()
    u = sorted(D.unit_histogram(spark.createDataFrame([(0,), (3,), (3,)], "n int"), "n").collect())
    assert [tuple(r) for r in u] == [(0, 1), (1, 0), (2, 0), (3, 2)]


def test_kde_close_to_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(10, 2, 3000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = sorted(D.kde(df, "v", grid=50).collect(), key=lambda r: r["grid_index"])
    h = x.std(ddof=1) * len(x) ** (-0.2)
    grid = np.linspace(x.min(), x.max(), 50)
    exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in got] == pytest.approx(grid.tolist())
    assert [r["density"] for r in got] == pytest.approx(exact.tolist(), rel=1e-4, abs=1e-9)


def test_box_stats_match_numpy(spark):
    data = {"a": [1, 2, 3, 4, 100], "b": [5, 5, 5, 6], "c": [7]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    got = {r["g"]: r for r in D.box_stats(df, "g", "v").collect()}
    for g, vs in data.items():
        q1, med, q3 = np.percentile(vs, [25, 50, 75])
        iqr = q3 - q1
        inside = [v for v in vs if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
        wl, wh = min(inside), max(inside)
        assert (got[g]["q1"], got[g]["median"], got[g]["q3"]) == pytest.approx((q1, med, q3))
        assert (got[g]["whisker_low"], got[g]["whisker_high"]) == (wl, wh)
        assert got[g]["n_outliers"] == sum(1 for v in vs if v < wl or v > wh)


def _clean(spark, rows):
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in CLEAN_RELEASE.fields) for r in rows], CLEAN_RELEASE)


def test_leaderboard_properties_and_pages(spark):
    rng = np.random.default_rng(11)
    rows = [dict(id=i, title=f"Artist {int(rng.integers(0, 37))} - T{i}", year=str(1990 + i % 20),
                 genre="Rock, Pop" if i % 3 else "Jazz", style="", rating_coeff=float(rng.uniform(1, 5)))
            for i in range(600)]
    df = _clean(spark, rows)
    lb = R.leaderboard(df, "artist")
    g = np.mean([r["rating_coeff"] for r in rows])
    for r in lb.collect():
        lo, hi = sorted([g, r["average_rating_coeff"]])
        assert lo - 1e-12 <= r["bayesian_score"] <= hi + 1e-12
    full = [r["artist"] for r in lb.orderBy(*R.ranking_order("bayesian_score", "artist")).collect()]
    pages = []
    for p in range(1, 5):
        page = R.leaderboard_page(lb, p).collect()
        assert [r["rank"] for r in page] == list(range((p - 1) * 10 + 1, (p - 1) * 10 + 1 + len(page)))
        pages += [r["artist"] for r in page]
    assert pages == full
    assert R.page_totals(lb).first()["page_count"] == 4
    # filtered: a page of nothing is empty
    assert R.leaderboard(df, "artist", query="no such artist").count() == 0


def test_filter_releases(spark):
    df = _clean(spark, [dict(id=1, title="Foo - A", year="1999", genre="Rock, Pop", style="Indie"),
                        dict(id=2, title="Bar - B", year="x", genre="Pop", style=""),
                        dict(id=3, title="Baz - C", year="2005", genre=None, label="Foo Records")])
    ids = lambda df_: sorted(r["id"] for r in df_.collect())
    assert ids(filter_releases(df, year_min="1990", year_max="2000")) == [1]
    assert ids(filter_releases(df, year_max="2000")) == [1, 2]          # unparseable year counts as 0
    assert ids(filter_releases(df, year_min="0", year_max="")) == [1, 2, 3]  # 0 / blank are open
    assert ids(filter_releases(df, genre="Pop")) == [1, 2]
    assert ids(filter_releases(df, style="Indie")) == [1]
    assert ids(filter_releases(df, query="  FOO ")) == [1]
    assert ids(filter_releases(df, entity="label", query="foo")) == [1, 3]   # label or title
    assert ids(filter_releases(df, entity="label", query="records")) == [3]


def test_insert_or_ignore(spark):
    target = raw_rows(spark, [dict(id=1, release_id="1", title="stored")])
    batch = raw_rows(spark, [dict(id=1, release_id="1", title="new"), dict(id=2, release_id="2", title="first"),
                             dict(id=3, release_id="2", title="second"), dict(id=4, release_id="4", title="x")])
    batch = batch.withColumn("_pos", F.col("id"))
    once = IO.insert_or_ignore(target, batch, "release_id", "_pos", [f.name for f in RAW_RELEASE.fields])
    got = sorted((r["release_id"], r["title"]) for r in once.collect())
    assert got == [("1", "stored"), ("2", "first"), ("4", "x")]
    twice = IO.insert_or_ignore(once, batch, "release_id", "_pos", [f.name for f in RAW_RELEASE.fields])
    assert sorted((r["release_id"], r["title"]) for r in twice.collect()) == got


def test_ids_and_missing(spark):
    ids = spark.createDataFrame([(" 12 ",), ("abc",), ("",), (None,), ("12",), ("7",), ("٣",)], "release_id string")
    clean = ET.clean_id_list(ids)
    assert [r["release_id"] for r in clean.collect()] == ["12", "12", "7"]
    store = raw_rows(spark, [dict(id=7, release_id="7")])
    assert sorted(r["release_id"] for r in ET.missing_ids(clean, store).collect()) == ["12", "12"]


def test_search(spark):
    df = raw_rows(spark, [
        dict(id=i, title=f"t{i}", year=str(1990 + i), genre="Electronic, Rock" if i % 2 else "Rock",
             style="House", format="Vinyl, LP", average_rating=float(i % 4)) for i in range(10)])
    hits = ET.search(df, genres=["Electronic"], year="1991-1997", sort="rating", order="desc", per_page=2, page=1)
    assert [r["id"] for r in hits.collect()] == [3, 7]
    hits2 = ET.search(df, genres=["Electronic"], year="1991-1997", sort="rating", order="desc", per_page=2, page=2)
    assert [r["id"] for r in hits2.collect()] == [1, 5]
    assert ET.search(df, year="19x0-2000", paged=False).count() == 10     # malformed year: no filter
    assert ET.search(df, formats=["Vinyl", "LP"], paged=False).count() == 10
    assert ET.search(df, formats=["Vinyl", "CD"], paged=False).count() == 0
    st = ET.search_state(df, per_page=3, genres=["Electronic"]).first()
    assert (st["total_items"], st["total_pages"]) == (5, 2)


def test_clean_releases(spark):
    df = raw_rows(spark, [dict(id=1, title="Song", artists_sort="Band", youtube_links="u1, u2",
                               rating_coefficient=3.0, demand_coefficient=0.5)])
    r = clean_releases(df).first()
    assert (r["title"], r["youtube_links"], r["rating_coeff"], r["demand_coeff"]) == ("Band - Song", "u1", 3.0, 0.5)
    assert len(clean_releases(df).columns) == 18


# Recorded best-rated styles of a one-style catalogue: style, sum, count, score.
RECORDED_STYLES = [
    ("French House", 120.73572711689853, 30, 3.8802608368331937),
    ("Neo Trance", 1161.236560319544, 302, 3.8327882949699723),
    ("Bleep", 5179.651234385579, 1357, 3.8144042298898078),
    ("Ambient", 30393.59218618099, 8022, 3.788383539066464),
    ("Dub Techno", 33270.96178236741, 8788, 3.785595948050216),
]


def test_best_styles_recorded_scores(spark):
    rows = []
    for style, s, n, _ in RECORDED_STYLES:
        rows += [dict(id=len(rows) + i, style=style, rating_coefficient=0.0) for i in range(n - 1)]
        rows.append(dict(id=len(rows) + n, style=style, rating_coefficient=s))
    df = raw_rows(spark, rows)
    got = R.best_styles(df, m=12.5, C=3.534028675881197).collect()
    assert [r["style_list"] for r in got] == [r[0] for r in RECORDED_STYLES]
    for r, (_, s, n, score) in zip(got, RECORDED_STYLES):
        assert r["release_count"] == n
        assert r["sum_rating_coeff"] == pytest.approx(s, rel=1e-12)
        assert r["bayesian_avg"] == pytest.approx(score, abs=1e-12)


def test_corr_matrix_properties(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=500)
    data = [(float(x), float(2 * x + rng.normal()), 1.0, float(rng.normal())) for x in a]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in ST.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    arr = np.array(data)
    for i, x in enumerate("abd"):
        assert m[(x, x)] == pytest.approx(1.0)
        for y in "abd":
            assert m[(x, y)] == pytest.approx(m[(y, x)])
            j = "abcd".index(y)
            assert m[(x, y)] == pytest.approx(np.corrcoef(arr[:, "abcd".index(x)], arr[:, j])[0, 1])
    assert m[("a", "c")] is None and m[("c", "c")] is None


def _vif_numpy(X):
    out = []
    Xc = np.column_stack([np.ones(len(X)), X])
    for i in range(Xc.shape[1]):
        y, others = Xc[:, i], np.delete(Xc, i, axis=1)
        beta, *_ = np.linalg.lstsq(others, y, rcond=None)
        ssr = ((y - others @ beta) ** 2).sum()
        tss = ((y - y.mean()) ** 2).sum() if i > 0 else (y ** 2).sum()
        out.append(1.0 / (ssr / tss))
    return out


def test_vif_matches_regressions(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(400, 3))
    X[:, 2] = X[:, 0] + 0.5 * X[:, 1] + rng.normal(scale=0.3, size=400)
    X[:, 1] += 4
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in ST.vif(df, ["a", "b", "c"]).collect()}
    want = _vif_numpy(X)
    assert [got[k] for k in ["const", "a", "b", "c"]] == pytest.approx(want, rel=1e-8)


def test_vif_collinear_is_inf(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 7)) for i in range(50)], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in ST.vif(df, ["a", "b", "c"]).collect()}
    assert math.isinf(got["a"]) and math.isinf(got["b"]) and not math.isinf(got["c"])


def test_ols_against_numpy(spark):
    rng = np.random.default_rng(1)
    n = 800
    X = rng.normal(size=(n, 2))
    y = 1.5 + 2.0 * X[:, 0] - 0.7 * X[:, 1] + rng.normal(size=n)
    df = spark.createDataFrame([(i, float(y[i]), float(X[i, 0]), float(X[i, 1])) for i in range(n)],
                               "id long, y double, a double, b double")
    solved = ST.fit_ols(df, "y", ["a", "b"])
    c = {r["term"]: r for r in ST.ols_coef(df, solved).collect()}
    tails = {(r["statistic"], r["term"]): r["value"] for r in ST.ols_tails(df, solved, "y").collect()}
    Xc = np.column_stack([np.ones(n), X])
    beta, *_ = np.linalg.lstsq(Xc, y, rcond=None)
    resid = y - Xc @ beta
    sigma2 = resid @ resid / (n - 3)
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(Xc.T @ Xc)))
    for k, name in enumerate(["const", "a", "b"]):
        assert c[name]["coef"] == pytest.approx(beta[k], rel=1e-9)
        assert c[name]["std_err"] == pytest.approx(se[k], rel=1e-6)
        assert c[name]["t"] == pytest.approx(beta[k] / se[k], rel=1e-6)
        assert tails["ci_low", name] == pytest.approx(beta[k] - ST.t_ppf(0.975, n - 3) * se[k], rel=1e-6)
        assert tails["p_value", name] == pytest.approx(2 * ST.t_sf(abs(beta[k] / se[k]), n - 3), rel=1e-6)
    assert tails["condition_number", ""] == pytest.approx(np.linalg.cond(Xc), rel=1e-6)
    f = ST.ols_fit(df, solved).first()
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(resid @ resid / n) + 1)
    assert f["log_likelihood"] == pytest.approx(llf, rel=1e-9)
    assert f["aic"] == pytest.approx(2 * 3 - 2 * llf, rel=1e-9)
    r2 = 1 - resid @ resid / ((y - y.mean()) ** 2).sum()
    assert f["r_squared"] == pytest.approx(r2, rel=1e-9)
    diag = ST.ols_diagnostics(df, solved, "y").first()
    dw = (np.diff(resid) ** 2).sum() / (resid @ resid)
    assert diag["durbin_watson"] == pytest.approx(dw, rel=1e-8)
    m2, m3, m4 = (resid - resid.mean()) ** 2, (resid - resid.mean()) ** 3, (resid - resid.mean()) ** 4
    skew = m3.mean() / m2.mean() ** 1.5
    kurt = m4.mean() / m2.mean() ** 2
    assert diag["skew"] == pytest.approx(skew, rel=1e-6, abs=1e-9)
    assert diag["kurtosis"] == pytest.approx(kurt, rel=1e-6)
    assert diag["jarque_bera"] == pytest.approx(n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4), rel=1e-6)


def test_distribution_tails():
    # symmetric t: P(T > 0) = 1/2; known quantiles
    assert ST.t_sf(0.0, 10) == pytest.approx(0.5)
    assert ST.t_ppf(0.975, 1e6) == pytest.approx(1.959966, abs=1e-5)
    assert ST.t_ppf(0.975, 10) == pytest.approx(2.228139, abs=1e-5)
    # F(1, d) tail equals the two-sided t tail
    assert ST.f_sf(4.0, 1, 20) == pytest.approx(2 * ST.t_sf(2.0, 20), rel=1e-9)


def test_train_test_split(spark):
    df = spark.range(2000)
    a, b = ST.train_test_split(df, 0.25, seed=3)
    na, nb = a.count(), b.count()
    assert na + nb == 2000 and 350 < nb < 650
    assert a.join(b, "id").count() == 0
    parts = [sorted(r["id"] for r in ST.train_test_split(df.repartition(n), 0.25, seed=3)[1].collect()) for n in (4, 9)]
    assert parts[0] == parts[1] != sorted(r["id"] for r in ST.train_test_split(df, 0.25, seed=4)[1].collect())


def test_report_sections(spark):
    from catalog_engine.plans.report import render_report, report_table, write_report
    from catalog_engine.sources.tables import analysis_store
    df = analysis_store(spark, "/root/testdata/sf0.001")
    table = report_table(df, excluded_style="Brand#1")
    assert table.columns == ["section", "rank", "key", "metric", "value"]
    assert table.select("section").distinct().count() == 10
    text = render_report(table, excluded_style="Brand#1")
    assert text.startswith("=== Release Catalogue Analysis Summary ===")
    assert "Top 10 Genres:" in text and "Key Correlations:" in text
    assert f"Total Releases: {df.count()}" in text and "Average Lowest Price: $" in text and " minutes" in text
    import tempfile
    out = tempfile.mkdtemp(prefix="catalog-report-") + "/report"
    write_report(spark, text, out)
    assert spark.read.text(out).count() == len(text.split("\n"))


def test_new_rows_of_a_batch(spark):
    target = raw_rows(spark, [dict(id=i, release_id=str(i), title="stored") for i in range(0, 40, 2)])
    batch = raw_rows(spark, [dict(id=i, release_id=str(i % 25), title=f"b{i}") for i in range(60)])
    batch = batch.withColumn("_pos", F.col("id"))
    added = sorted((r["release_id"], r["title"]) for r in IO.new_rows(target, batch, "release_id", "_pos").collect())
    assert added == sorted((str(i), f"b{i}") for i in range(25) if not (i % 2 == 0 and i < 40))


def test_idlist_ingest(spark):
    from catalog_engine.schemas import RELEASE_PAYLOAD
    import json
    payloads = [{"id": i, "title": f"A - T{i}", "labels": [{"name": "L"}]} for i in (1, 2, 3, 5)] + [{"title": "no id"}]
    lines = spark.createDataFrame([(json.dumps(p),) for p in payloads], "t string")
    rows = lines.select(F.from_json("t", RELEASE_PAYLOAD).alias("r")).select("r.*")
    ids = ET.clean_id_list(spark.createDataFrame([("1",), (" 2 ",), ("2",), ("4",), ("x",), ("5",)], "release_id string"))
    store = raw_rows(spark, [dict(id=1, release_id="1")])
    assert [r["release_id"] for r in ET.existing_ids(store).collect()] == ["1"]
    out = ET.ingest_ids(ids, store, rows).collect()
    assert sorted(r["release_id"] for r in out) == ["2", "5"]        # 1 is stored, 4 has no payload


def test_rare_category_reaches_the_top(spark):
    rng = np.random.default_rng(1)
    rows = [(float(v), float(v) / 2, f"common{i % 7}" if i % 400 else "rare and dear", "CD",
             float(v) + (0 if i % 400 else 5000)) for i, v in enumerate(rng.normal(50, 5, 4000))]
    rows += [(50.0, 25.0, f"once{i}", "LP", 50.0) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, style string, format string, price double")
    for kind in ("rf", "gbt"):
        top = ST.tree_importance(df, kind, "price", ["a", "b"], ["style", "format"], trees=3, k=2000).collect()
        assert top[0]["feature"] == "style_rare and dear"
        assert sum(r["importance"] for r in top) == pytest.approx(1.0, abs=1e-6) and all(r["importance"] >= 0 for r in top)
    order = ST.category_index(df, "style", "price", 5.0).collect()
    assert sorted(r["index"] for r in order) == list(range(608))
    assert max(order, key=lambda r: r["index"])["text"] == "rare and dear"


def test_text_that_matters_only_after_another_split(spark):
    """Its mean is that of all others; only beside `a` does it move the price."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(6000):
        a, style = float(rng.integers(0, 2)), "hidden" if i % 50 == 0 else f"s{i % 300}"
        rows.append((a, float(rng.normal()), style, "CD", 50.0 + (40 * (2 * a - 1) if style == "hidden" else 0) + float(rng.normal(0, 0.1))))
    df = spark.createDataFrame(rows, "a double, b double, style string, format string, price double")
    for kind in ("rf", "gbt"):
        top = ST.tree_importance(df, kind, "price", ["a", "b"], ["style", "format"], trees=5).collect()
        assert len(top) == 20 and "style_hidden" in [r["feature"] for r in top[:3]]


def test_gain_parts_equal_the_model_gains(spark):
    """Without text splits the gains are those of the learner itself."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(3)
    rows = [(float(x), float(y), "only", 3 * float(x) + (5 if y > 0 else 0) + float(e)) for x, y, e in rng.normal(size=(800, 3))]
    df = spark.createDataFrame(rows, "a double, b double, style string, price double")
    got = {r["feature"]: r["importance"] for r in ST.tree_importance(df, "gbt", "price", ["a", "b"], ["style"], trees=4, bins=32).collect()}
    data = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    own = GBTRegressor(featuresCol="f", labelCol="price", maxIter=4, maxDepth=4, maxBins=32, seed=42).fit(data).featureImportances.toArray()
    assert got["a"] == pytest.approx(own[0], abs=0.02) and got["b"] == pytest.approx(own[1], abs=0.02)
    assert ST.tree_importance(df.filter("false"), "rf", "price", ["a", "b"], ["style"]).count() == 0



def test_sorted_positions(spark):
    from catalog_engine.sources.files import sorted_positions
    df = raw_rows(spark, [dict(id=i, gem_value=float(i % 7) if i % 5 else None) for i in range(200)]).repartition(5)
    got = {r["id"]: r["position"] for r in sorted_positions(df).collect()}
    order = sorted(range(200), key=lambda i: (-(i % 7 if i % 5 else 0), i))
    assert got == {i: p for p, i in enumerate(order)}


def test_kde_of_heavy_tails(spark):
    """Bins follow the bandwidth, so a long range costs no accuracy."""
    rng = np.random.default_rng(4)
    x = rng.lognormal(0, 2.5, 4000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = [r["density"] for r in sorted(D.kde(df, "v", grid=200).collect(), key=lambda r: r["grid_index"])]
    h = x.std(ddof=1) * len(x) ** (-0.2)
    grid = np.linspace(x.min(), x.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert got == pytest.approx(exact.tolist(), rel=1e-3, abs=1e-9)


def test_unicode_words_and_white_space(spark):
    df = spark.createDataFrame([("N\u00e9o Kyma, Forr\u00f3, \u00c9ntekhno, don't",)], "genre string")
    assert sorted(r["term"] for r in AG.term_frequencies(df, "genre").collect()) == [
        "don't", "forr\u00f3", "kyma", "n\u00e9o", "\u00e9ntekhno"]
    from catalog_engine.functions import strip
    assert spark.createDataFrame([("\u2003\xa0 a b\u3000\x1f",)], "t string").select(strip("t")).first()[0] == "a b"


def test_two_writers_publish_one_version(spark, tmp):
    from catalog_engine.sources.tables import current_version, publish
    path = f"{tmp}/table"
    assert current_version(spark, path) is None
    a = publish(spark, lambda p: spark.range(3).write.parquet(p), path)
    b = publish(spark, lambda p: spark.range(5).write.parquet(p), path)     # comes second: the first holds
    assert a == b == current_version(spark, path) and spark.read.parquet(a).count() == 3
    c = publish(spark, lambda p: spark.range(7).write.parquet(p), path, replace=True)
    assert current_version(spark, path) == c and spark.read.parquet(c).count() == 7
    assert spark.read.parquet(a).count() == 3                                 # still there for its readers


def test_get_spark_leaves_a_running_session_alone(spark):
    from catalog_engine.session import get_spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark(shuffle_partitions=777).conf.get("spark.sql.shuffle.partitions") == before


def test_normalise_search_missing_payload_defaults(spark):
    from catalog_engine.schemas import RELEASE_PAYLOAD, SEARCH_RESULT
    hits = spark.createDataFrame([(1, "A - X", "1999", ["Rock"], ["Indie"], ["Vinyl", "LP"]),
                                  (2, None, None, [], [], [])], SEARCH_RESULT)
    payloads = spark.createDataFrame([], RELEASE_PAYLOAD)
    kept = {r["id"]: r for r in ET.normalise_search(hits, payloads).collect()}
    assert sorted(kept) == [1, 2]
    r = kept[1]
    assert (r["genre"], r["format"], r["rating_coefficient"], r["demand_coefficient"], r["gem_value"]) == \
        ("Rock", "Vinyl, LP", 3.0, 0.0, 0.0)
    assert (r["label"], r["country"], r["labels"], r["tracklist"], r["lowest_price"]) == ("", "", "[]", "[]", 0.0)
    assert (kept[2]["title"], kept[2]["year"]) == ("N/A", "Unknown")
    assert ET.normalise_search(hits, payloads, keep_missing=False).count() == 0


def test_first_per_key_with_a_hot_key(spark):
    n = 30000
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}", n - i) for i in range(n)]   # a third of rows share one key
    df = spark.createDataFrame(rows, "id long, release_id string, _pos long").repartition(16)
    got = {r["release_id"]: r["id"] for r in IO.first_per_key(df, "release_id", "_pos").collect()}
    assert got["hot"] == max(i for i in range(n) if i % 3 == 0)              # smallest _pos wins
    assert len(got) == 1 + sum(1 for i in range(n) if i % 3)


def test_search_sorts(spark):
    df = raw_rows(spark, [dict(id=i, title=t, year=y, genre="Rock", style="", format="CD")
                          for i, (t, y) in enumerate([("b", "2001"), ("a", "1999"), ("c", "x"), ("a", "2000")])])
    by_title = [r["id"] for r in ET.search(df, sort="title", order="asc", per_page=10).collect()]
    assert by_title == [1, 3, 0, 2]
    by_year = [r["id"] for r in ET.search(df, sort="year", order="desc", per_page=10).collect()]
    assert by_year == [0, 3, 1, 2]                                          # unparseable year last
    assert [r["id"] for r in ET.search(df, per_page=2, page=2).collect()] == [2, 3]


def test_approx_and_sampling_options(spark):
    rng = np.random.default_rng(2)
    vals = rng.integers(0, 50, 5000)
    df = raw_rows(spark, [dict(id=i, year="2000", average_rating=float(v) / 10, genre="Rock" if i % 2 else "Pop",
                               tracklist="[]") for i, v in enumerate(vals)])
    prep = preprocess(df)
    exact = AG.summary(prep).first()["median_rating"]
    approx = AG.summary(prep, approx=True).first()["median_rating"]
    assert exact == pytest.approx(np.median(vals / 10))
    assert abs(approx - exact) <= 0.1
    a = {r["genre"]: r for r in D.box_stats(prep, "genre", "average_rating", approx=True).collect()}
    e = {r["genre"]: r for r in D.box_stats(prep, "genre", "average_rating").collect()}
    for g in ("Rock", "Pop"):
        assert abs(a[g]["median"] - e[g]["median"]) <= 0.1 and a[g]["n"] == e[g]["n"]
    pts = D.points(prep, "average_rating", "have", bins=None)
    assert pts.count() == 5000 and pts.columns == ["average_rating", "have"]
    sample = D.points(prep, "average_rating", "have", bins=None, fraction=0.1, seed=7)
    assert 300 < sample.count() < 700
    assert sample.count() == D.points(prep, "average_rating", "have", bins=None, fraction=0.1, seed=7).count()
    grid = D.points(prep, "average_rating", "have", colour="want", bins=10)
    assert sum(r["count"] for r in grid.collect()) == 5000 and "mean_want" in grid.columns


def test_sample_of_fixed_size(spark):
    rows = [(k, float(k % 13), float(k % 7) if k % 5 else None, "ab"[k % 3 == 0]) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, y double, g string")
    got = [sorted(r.id for r in D.sample_points(df.repartition(n), "x", "y", 50).collect()) for n in (4, 9)]
    assert got[0] == got[1] and len(set(got[0])) == 50 and not any(i % 5 == 0 for i in got[0])
    per = [sorted((r.g, r.id) for r in D.sample_points(df.repartition(n), "x", "y", 20, stratum="g").collect()) for n in (4, 9)]
    assert per[0] == per[1] and [sum(g == s for g, _ in per[0]) for s in "ab"] == [20, 20]
    assert D.sample_points(df, "x", "y", 10 ** 6).count() == 320


def test_moments_in_one_scan_at_a_large_offset(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3)) @ np.array([[1, .5, 0], [0, 1, .2], [0, 0, 2]]) + 1e9
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 2.0)], "a double, b double, c double").repartition(7)
    n, mean, S = ST.moments(df, ["a", "b", "c"])
    z = x - x.mean(axis=0)
    assert n == 3000 and mean == pytest.approx(x.mean(axis=0), rel=1e-14) and S == pytest.approx(z.T @ z, rel=1e-6)
    assert ST.moments(df.filter("false"), ["a", "b"])[0] == 0


def test_durbin_watson_over_ranges(spark):
    rng = np.random.default_rng(5)
    for n, parts in ((0, 4), (1, 4), (3, 9), (400, 1), (400, 2), (400, 7), (400, 50)):
        k = np.sort(rng.integers(0, 10**12, n)) if n != 3 else np.array([5, 5, 9])  # ranges without rows, ties
        e = rng.normal(size=n)
        e = e[np.lexsort((e, k))]
        rows = [(int(a), float(b)) for a, b in zip(k, e)] + [(None, 7.0), (3, None)]
        rng.shuffle(rows)
        df = spark.createDataFrame([(None if a is None else int(a), b) for a, b in rows], "k long, e double").repartition(3)
        got = ST.durbin_watson(df, "k", "e", parts)
        if n == 0:
            assert math.isnan(got)
        else:
            e = np.array([b for _, b in sorted(zip(k.tolist(), e.tolist()))])
            assert got == pytest.approx((np.diff(e) ** 2).sum() / (e @ e), rel=1e-9)


def test_ranges_by_two_steps(spark):
    for n in (0, 1, 2, 5, 17, 100):
        cuts = [3 * i for i in range(n)]
        df = spark.range(-2, 3 * n + 3).withColumn("r", ST._range_of("id", cuts))
        assert all(x.r == sum(c < x.id for c in cuts) for x in df.collect())
