"""Registered queries: one per operator instance of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame. All of them start from
the release store that Spark derives from the test tables (sources.tables),
so their work grows with the tables. Double outputs are rounded to 6
decimals (densities to 9) so that the SQL oracle can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import round_to
from ..operators import aggregates as AG
from ..operators import clustered as CL
from ..operators import distributions as D
from ..operators import etl as ET
from ..operators import positions as PO
from ..operators import prep as PR
from ..operators import ranking as R
from ..operators import stats as ST
from ..operators import store as IO
from ..operators import trends as TR
from ..operators.prep import clean_releases, entity_releases
from ..schemas import CLEAN_COLUMNS, RAW_COLUMNS, RAW_RELEASE
from ..session import checkpoint_root
from ..sources import tables as TB

# The test tables have no 'Techno'; this style token stands in for it.
EXCLUDED_STYLE = "Brand#1"
SEARCH = dict(genres=["MEDIUM"], formats=["R"], year="1996-1998", sort="rating", order="desc",
              per_page=50)
SEARCH_PAGE = 2
DEEP_PAGE = 12
SAMPLE_POINTS = 500
CLUSTERED_YEARS = (1995, 1996)
LEADERBOARD_FILTER = dict(query="order 1", genre="MEDIUM", year_min="1996", year_max="1999")

# Scores that agree to this many decimals are ties in the queries, because two
# engines add up in different orders; the operators compare exact scores.
TIE_DIGITS = 9

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn
    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_to(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def raw(spark, d):
    return TB.release_store(spark, d)


def prep(spark, d):
    return TB.analysis_store(spark, d)


def clean(spark, d):
    return clean_releases(raw(spark, d))


# --- sources, record building, store ---------------------------------------------

@query("q_releases")
def q_releases(spark, d):
    return rounded(raw(spark, d))


@query("q_normalise_payloads")
def q_normalise_payloads(spark, d):
    return rounded(ET.normalise_payloads(TB.payload_store(spark, d)))


@query("q_normalise_search")
def q_normalise_search(spark, d):
    return rounded(ET.normalise_search(TB.search_hits(spark, d), TB.payload_store(spark, d)))


@query("q_clean_releases")
def q_clean_releases(spark, d):
    return rounded(clean(spark, d))


@query("q_missing_ids")
def q_missing_ids(spark, d):
    from ..sources.files import read_release_ids
    ids = read_release_ids(spark, TB.id_list_csv(spark, d))
    return ET.missing_ids(ids, raw(spark, d))


def _search_batch(spark, d):
    """A search ingest batch with one replayed page: the replay carries a
    marked title and a later position, so first-wins is observable."""
    rows = ET.normalise_search(TB.search_hits(spark, d), TB.payload_store(spark, d))
    both = rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumn("_pos", F.col("id") * 2 + F.col("_copy"))
    return both.withColumn("title", F.when(F.col("_copy") == 1, F.concat("title", F.lit(" (replay)")))
                           .otherwise(F.col("title"))).drop("_copy")


@query("q_insert_or_ignore")
def q_insert_or_ignore(spark, d):
    batch = _search_batch(spark, d)
    return rounded(IO.insert_or_ignore(raw(spark, d), batch, "release_id", "_pos", RAW_COLUMNS))


@query("q_bucketed_insert")
def q_bucketed_insert(spark, d):
    """q_insert_or_ignore into a store bucketed by key, the batch as its second one."""
    path = f"{checkpoint_root(spark)}/bucketed-{uuid.uuid4().hex}"
    batch = _search_batch(spark, d)  # first, so that the releases are made from the payloads that it saves
    IO.append_to_buckets(raw(spark, d), path, "release_id", "id", 0, RAW_RELEASE)
    IO.append_to_buckets(batch, path, "release_id", "_pos", 1, RAW_RELEASE)
    return rounded(IO.read_buckets(spark, path, RAW_RELEASE).select(*RAW_COLUMNS))


@query("q_clean_insert")
def q_clean_insert(spark, d):
    batch = clean_releases(_search_batch(spark, d), keep=("_pos",))
    return rounded(IO.insert_or_ignore(clean(spark, d), batch, "id", "_pos", CLEAN_COLUMNS))


@query("q_search")
def q_search(spark, d):
    return rounded(ET.search(raw(spark, d), page=SEARCH_PAGE, **SEARCH))


@query("q_search_state")
def q_search_state(spark, d):
    crit = {k: v for k, v in SEARCH.items() if k not in ("per_page",)}
    return ET.search_state(raw(spark, d), per_page=SEARCH["per_page"], **crit)


def search_index(spark, d):
    """Folder of the releases in the order of the fixed search, with postings."""
    order = ET.search_order(SEARCH["sort"], SEARCH["order"])
    return TB.written(spark, d, "search_index", lambda path: PO.write_index(raw(spark, d), order, ET.search_fields(), path))


def _search_terms():
    return ET.search_terms(**{k: SEARCH[k] for k in ("genres", "formats", "year")})


@query("q_search_postings")
def q_search_postings(spark, d):
    """q_search from the postings: the page's rows alone are read."""
    return rounded(PO.search_page(spark, search_index(spark, d), _search_terms(), SEARCH_PAGE, SEARCH["per_page"]).drop("position"))


@query("q_search_state_postings")
def q_search_state_postings(spark, d):
    """q_search_state from the postings: no row of the store is read."""
    size = SEARCH["per_page"]
    return PO.search_total(spark, search_index(spark, d), _search_terms()).select(
        "total_items", F.lit(size).alias("per_page"), F.ceil(F.col("total_items") / size).cast("long").alias("total_pages"))


@query("q_search_deep_page")
def q_search_deep_page(spark, d):
    """Page DEEP_PAGE of all releases in that order, with ranks: one partition of the ranked table."""
    page = PO.Ranked(spark, f"{search_index(spark, d)}/ranked").page(DEEP_PAGE, SEARCH["per_page"])
    return rounded(page.select("rank", *RAW_COLUMNS))


@query("q_leaderboard_by_text")
def q_leaderboard_by_text(spark, d):
    """q_artist_leaderboard_filtered over the candidates of the trigram postings."""
    path = TB.written(spark, d, "text_index", lambda p: PO.write_index(clean(spark, d), [F.col("id").asc()], PR.text_fields(), p))
    rows = PR.text_candidates(spark, path, LEADERBOARD_FILTER["query"]).drop("position")
    return rounded(R.leaderboard(rows, "artist", **LEADERBOARD_FILTER))


@query("q_sorted_by_gem")
def q_sorted_by_gem(spark, d):
    """The whole table in gem order, with each row's position."""
    from ..sources.files import sorted_positions
    order_free = raw(spark, d).withColumn("gem_value", round_to("gem_value", 9))  # engines multiply alike, add not
    return rounded(sorted_positions(order_free))


@query("q_idlist_ingest")
def q_idlist_ingest(spark, d):
    """The id-list job: an id file, a store that holds the releases up to 1997,
    and the saved payloads; the rows it would append."""
    from ..sources.files import read_release_ids
    ids = read_release_ids(spark, TB.id_list_csv(spark, d))
    stored = raw(spark, d).filter("released < '1998-01-01'")
    return rounded(ET.ingest_ids(ids, stored, TB.payload_store(spark, d)))


def _written(spark, name: str) -> str:
    import uuid
    from ..session import checkpoint_root
    return f"{checkpoint_root(spark)}/catalog_written/{name}-{uuid.uuid4().hex}"


@query("q_csv_written")
def q_csv_written(spark, d):
    """The best-styles table written as CSV with a header and read back."""
    from ..sources.files import write_csv
    path = _written(spark, "styles")
    write_csv(rounded(R.best_styles(prep(spark, d), digits=TIE_DIGITS)), path)
    return spark.read.option("header", True).schema(
        "style_list string, sum_rating_coeff double, release_count long, bayesian_avg double").csv(path)


@query("q_truncated")
def q_truncated(spark, d):
    """A copy of the store emptied for a new search, then filled with the
    releases of 1996: what it holds."""
    from ..sources.files import delete_all
    path = _written(spark, "store")
    raw(spark, d).select("id", "year").write.parquet(path)
    delete_all(spark, path, T.StructType([T.StructField("id", T.LongType()), T.StructField("year", T.StringType())]))
    emptied = spark.read.parquet(path).count()
    raw(spark, d).filter("year = '1996'").select("id", "year").write.mode("append").parquet(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")).withColumn(
        "left_after_delete", F.lit(emptied).cast("long"))


@query("q_saved_search_state")
def q_saved_search_state(spark, d):
    """The progress record of a search, replaced once and read back: the page to resume at."""
    from ..sources.files import load_search_state, save_search_state
    crit = {k: v for k, v in SEARCH.items() if k not in ("per_page",)}
    total = ET.search_state(raw(spark, d), per_page=SEARCH["per_page"], **crit).first()["total_items"]
    path = _written(spark, "state")
    state = dict(SEARCH, sort_order=SEARCH["order"], total_items=total)
    for page in (1, 2):
        save_search_state(spark, path, dict(state, last_page_fetched=page))
    got = load_search_state(spark, path)
    return spark.createDataFrame([(got["last_page_fetched"] + 1, got["total_items"], got["per_page"], got["sort"],
                                   ",".join(got["genres"]), got["year"])],
                                 "resume_page int, total_items int, per_page int, sort string, genres string, year string")


@query("q_existing_ids")
def q_existing_ids(spark, d):
    """The distinct ids that a store written in overlapping batches has."""
    stored = raw(spark, d)
    return ET.existing_ids(stored.unionByName(stored.filter("year = '1996'")))


@query("q_export_written")
def q_export_written(spark, d):
    """The export as JSON lines and as CSV, read back: what each file format holds."""
    from ..sources.files import export_records
    out = None
    for fmt in ("json", "csv"):
        path = _written(spark, f"export-{fmt}")
        export_records(raw(spark, d), path, fmt)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
        rows = (spark.read.schema(schema).json(path) if fmt == "json" else
                spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path))
        rows = rows.select(F.lit(fmt).alias("format"), "id", "title", "labels", "year", "average_rating", "gem_value")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("q_sorted_written")
def q_sorted_written(spark, d):
    """The table rewritten in gem order: each row with its position in the files,
    in the order of their names."""
    from ..sources.files import rewrite_sorted
    path = _written(spark, "sorted")
    rewrite_sorted(raw(spark, d).withColumn("gem_value", round_to("gem_value", 9)).select("id", "gem_value"), path)
    rows = spark.read.parquet(path).select("id", "gem_value", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    sizes = {r["file"]: r["count"] for r in rows.groupBy("file").count().collect()}  # one number per file
    starts, before = [], 0
    for name in sorted(sizes):
        starts += [F.lit(name), F.lit(before).cast("long")]
        before += sizes[name]
    if not starts:
        return rows.select("id", "gem_value", F.col("row").alias("position"))
    return rounded(rows.select("id", "gem_value", (F.create_map(*starts)[F.col("file")] + F.col("row")).alias("position")))


@query("q_export_records")
def q_export_records(spark, d):
    from ..sources.files import as_records
    return as_records(raw(spark, d))


# --- aggregations ------------------------------------------------------------------

@query("q_top_genres")
def q_top_genres(spark, d):
    return AG.top_tokens(prep(spark, d), "genre", 10)


@query("q_top_styles")
def q_top_styles(spark, d):
    return AG.top_tokens(prep(spark, d), "style", 10, exclude=[EXCLUDED_STYLE])


@query("q_top_formats")
def q_top_formats(spark, d):
    return AG.top_tokens(prep(spark, d), "format", 10)


@query("q_top_countries")
def q_top_countries(spark, d):
    return AG.top_values(prep(spark, d), "country", 20)


@query("q_top_labels_popularity")
def q_top_labels_popularity(spark, d):
    return rounded(R.top_k(AG.label_stats(prep(spark, d)), "popularity_score", 100, "label_name", TIE_DIGITS))


@query("q_top_labels_rating")
def q_top_labels_rating(spark, d):
    return rounded(R.top_k(AG.label_stats(prep(spark, d)), "average_rating_coeff", 100, "label_name", TIE_DIGITS))


@query("q_top_artists_want")
def q_top_artists_want(spark, d):
    return rounded(R.top_k(AG.artist_stats(prep(spark, d), "want", "average_want"), "average_want", 100, "artist", TIE_DIGITS))


@query("q_top_artists_rating")
def q_top_artists_rating(spark, d):
    s = AG.artist_stats(prep(spark, d), "rating_coefficient", "average_rating_coeff")
    return rounded(R.top_k(s, "average_rating_coeff", 100, "artist", TIE_DIGITS))


@query("q_summary")
def q_summary(spark, d):
    return rounded(AG.summary(prep(spark, d)))


@query("q_facets_genre")
def q_facets_genre(spark, d):
    return AG.facets(clean(spark, d), "genre")


@query("q_facets_style")
def q_facets_style(spark, d):
    return AG.facets(clean(spark, d), "style")


@query("q_terms_genre")
def q_terms_genre(spark, d):
    return AG.term_frequencies(prep(spark, d), "genre")


@query("q_terms_style")
def q_terms_style(spark, d):
    return AG.term_frequencies(prep(spark, d), "style", exclude=[EXCLUDED_STYLE])


# --- rankings ---------------------------------------------------------------------------

@query("q_artist_leaderboard")
def q_artist_leaderboard(spark, d):
    return rounded(R.leaderboard(clean(spark, d), "artist"))


@query("q_label_leaderboard")
def q_label_leaderboard(spark, d):
    return rounded(R.leaderboard(clean(spark, d), "label"))


@query("q_artist_leaderboard_page")
def q_artist_leaderboard_page(spark, d):
    return rounded(R.leaderboard_page(R.leaderboard(clean(spark, d), "artist"), page=1, digits=TIE_DIGITS))


@query("q_label_leaderboard_page")
def q_label_leaderboard_page(spark, d):
    return rounded(R.leaderboard_page(R.leaderboard(clean(spark, d), "label"), page=2, digits=TIE_DIGITS))


@query("q_artist_leaderboard_filtered")
def q_artist_leaderboard_filtered(spark, d):
    return rounded(R.leaderboard(clean(spark, d), "artist", **LEADERBOARD_FILTER))


@query("q_artist_pages")
def q_artist_pages(spark, d):
    return R.page_totals(R.leaderboard(clean(spark, d), "artist"))


@query("q_label_pages")
def q_label_pages(spark, d):
    return R.page_totals(R.leaderboard(clean(spark, d), "label"))


@query("q_artist_releases")
def q_artist_releases(spark, d):
    c = clean(spark, d)
    top = R.leaderboard_page(R.leaderboard(c, "artist"), page=1, digits=TIE_DIGITS).first()
    value = top["artist"] if top else ""
    return rounded(entity_releases(c, "artist", value, TB.interacted_ids(spark, d)))


@query("q_artist_releases_display")
def q_artist_releases_display(spark, d):
    """The drill-down rows as displayed: 2-decimal scores, 'x.xx (n)' rating,
    placeholders for empty values, video id or link status."""
    c = clean(spark, d)
    top = R.leaderboard_page(R.leaderboard(c, "artist"), page=1, digits=TIE_DIGITS).first()
    value = top["artist"] if top else ""
    return entity_releases(c, "artist", value, TB.interacted_ids(spark, d), display=True)


@query("q_best_styles")
def q_best_styles(spark, d):
    return rounded(R.best_styles(prep(spark, d), digits=TIE_DIGITS))


# --- trends -----------------------------------------------------------------------------

@query("q_releases_per_year")
def q_releases_per_year(spark, d):
    return TR.releases_per_year(prep(spark, d))


@query("q_gem_per_year")
def q_gem_per_year(spark, d):
    return rounded(TR.gem_per_year(prep(spark, d)))


@query("q_gem_per_year_clustered")
def q_gem_per_year_clustered(spark, d):
    """Gem value per year of one style in a range of years: row groups outside are skipped."""
    path = TB.written(spark, d, "clustered", lambda p: CL.write_clustered(prep(spark, d), p))
    return rounded(TR.gem_per_year(CL.clustered_rows(spark, path, CLUSTERED_YEARS, EXCLUDED_STYLE)))


@query("q_label_trend")
def q_label_trend(spark, d):
    return TR.label_trend(prep(spark, d), digits=TIE_DIGITS)


@query("q_style_trend")
def q_style_trend(spark, d):
    return TR.style_trend(prep(spark, d), exclude=EXCLUDED_STYLE)


@query("q_style_trend_wide")
def q_style_trend_wide(spark, d):
    p = prep(spark, d)
    return TR.positional(TR.style_trend(p, exclude=EXCLUDED_STYLE), "style",
                         TR.top_style_names(p, exclude=EXCLUDED_STYLE), 10)


@query("q_style_defining")
def q_style_defining(spark, d):
    return TR.style_defining(prep(spark, d), exclude=EXCLUDED_STYLE)


@query("q_country_trend")
def q_country_trend(spark, d):
    return TR.country_trend(prep(spark, d))


@query("q_country_trend_wide")
def q_country_trend_wide(spark, d):
    p = prep(spark, d)
    return TR.positional(TR.country_trend(p), "country", AG.top_values(p, "country", 10), 10)


# --- distributions ------------------------------------------------------------------------

HISTOGRAMS = {
    "q_hist_average_rating": ("average_rating", 20),
    "q_hist_rating_count": ("rating_count", 30),
    "q_hist_demand": ("demand_coefficient", 20),
    "q_hist_gem": ("gem_value", 20),
    "q_hist_price": ("lowest_price", 30),
    "q_hist_duration": ("total_duration_min", 30),
}
KDES = {
    "q_kde_average_rating": "average_rating",
    "q_kde_rating_count": "rating_count",
    "q_kde_demand": "demand_coefficient",
    "q_kde_gem": "gem_value",
    "q_kde_price": "lowest_price",
    "q_kde_duration": "total_duration_min",
}
SCATTERS = {
    "q_xy_rating_demand": ("rating_coefficient", "demand_coefficient", None),
    "q_xy_gem_rating": ("gem_value", "average_rating", None),
    "q_xy_price_gem": ("lowest_price", "gem_value", None),
    "q_xy_have_want": ("have", "want", None),
    "q_xy_have_demand_want": ("have", "demand_coefficient", "want"),
    "q_xy_rating_price": ("average_rating", "lowest_price", None),
    "q_xy_demand_price": ("demand_coefficient", "lowest_price", None),
}
SCATTER_BINS = 50
PAIRWISE_COLUMNS = ["lowest_price", "gem_value", "demand_coefficient", "rating_coefficient",
                    "average_rating", "rating_count", "have", "want"]
PAIRWISE_BINS = 20
KDE_GRID = 200


def _hist(col, bins):
    return lambda spark, d: rounded(D.histogram(prep(spark, d), col, bins))


def _kde(col):
    return lambda spark, d: rounded(D.kde(prep(spark, d), col, KDE_GRID), 9)


def _xy(x, y, c):
    return lambda spark, d: rounded(D.points(prep(spark, d), x, y, colour=c, bins=SCATTER_BINS))


for _n, (_c, _b) in HISTOGRAMS.items():
    QUERIES[_n] = _hist(_c, _b)
for _n, _c in KDES.items():
    QUERIES[_n] = _kde(_c)
for _n, (_x, _y, _c) in SCATTERS.items():
    QUERIES[_n] = _xy(_x, _y, _c)


@query("q_hist_num_tracks")
def q_hist_num_tracks(spark, d):
    return D.unit_histogram(prep(spark, d), "num_tracks")


@query("q_xy_sample")
def q_xy_sample(spark, d):
    """A sample of fixed size of the rating and price scatter."""
    return rounded(D.sample_points(prep(spark, d), "average_rating", "lowest_price", SAMPLE_POINTS))


@query("q_box_tracks")
def q_box_tracks(spark, d):
    return rounded(D.box_by_top_genres(prep(spark, d), "num_tracks"))


@query("q_box_duration")
def q_box_duration(spark, d):
    return rounded(D.box_by_top_genres(prep(spark, d), "total_duration_min"))


@query("q_pairwise")
def q_pairwise(spark, d):
    return D.pairwise(prep(spark, d), PAIRWISE_COLUMNS, PAIRWISE_BINS)


@query("q_pairwise_diagonal")
def q_pairwise_diagonal(spark, d):
    return rounded(D.column_densities(prep(spark, d), PAIRWISE_COLUMNS, KDE_GRID), 9)


# --- statistics and models ----------------------------------------------------------------------

@query("q_corr_matrix")
def q_corr_matrix(spark, d):
    return rounded(ST.corr_matrix(prep(spark, d), ST.CORR_COLUMNS))


@query("q_corr_report")
def q_corr_report(spark, d):
    return rounded(ST.corr_matrix(prep(spark, d), ST.CORR_COLUMNS + ["total_duration_min"]))


@query("q_corr_price")
def q_corr_price(spark, d):
    return rounded(ST.corr_with(prep(spark, d), ST.PRICE_FEATURES, "lowest_price"))


@query("q_vif")
def q_vif(spark, d):
    return rounded(ST.vif(prep(spark, d), ST.VIF_FEATURES), 3)


@query("q_ols_simple")
def q_ols_simple(spark, d):
    fit = ST.fit_ols(prep(spark, d), "lowest_price", ["gem_value"])
    return rounded(spark.createDataFrame([(float(fit.coef[1]), float(fit.coef[0]), 1 - fit.ssr / fit.sst)],
                                         "slope double, intercept double, r_squared double"))


@query("q_ols_coef")
def q_ols_coef(spark, d):
    return rounded(ST.ols_coef(prep(spark, d), ST.fit_ols(prep(spark, d))))


@query("q_ols_fit")
def q_ols_fit(spark, d):
    return rounded(ST.ols_fit(prep(spark, d), ST.fit_ols(prep(spark, d))))


@query("q_ols_diagnostics")
def q_ols_diagnostics(spark, d):
    return rounded(ST.ols_diagnostics(prep(spark, d), ST.fit_ols(prep(spark, d))))


@query("q_ols_tails")
def q_ols_tails(spark, d):
    """p-values, bounds, omnibus test and condition number (no SQL: tested in pytest)."""
    return rounded(ST.ols_tails(prep(spark, d), ST.fit_ols(prep(spark, d))))


@query("q_importance_checks")
def q_importance_checks(spark, d):
    """What must hold of any importance table: rows, and the order."""
    imp = ST.tree_importance(prep(spark, d), "rf").cache()
    pairs = [r["importance"] for r in imp.collect()]
    return spark.createDataFrame([(len(pairs), pairs == sorted(pairs, reverse=True), 0 < sum(pairs) <= 1 + 1e-9)],
                                 "n_rows int, sorted boolean, sum_in_range boolean")


@query("q_rf_importance")
def q_rf_importance(spark, d):
    return rounded(ST.tree_importance(prep(spark, d), "rf"))


@query("q_gbt_importance")
def q_gbt_importance(spark, d):
    return rounded(ST.tree_importance(prep(spark, d), "gbt"))


# --- streaming ---------------------------------------------------------------------------------------

@query("q_stream_ingest")
def q_stream_ingest(spark, d):
    from ..streaming.ingest import ingest_payload_drops
    return rounded(ingest_payload_drops(spark, d))


def _live(spark, d):
    """Partials that the ingest of two drops kept current."""
    from ..operators import partials as PA
    from ..streaming.ingest import ingest_drops_to_partials
    path = TB.written(spark, d, "live_partials", lambda p: ingest_drops_to_partials(spark, d, p))
    return PA, PA.read_partials(spark, path)


@query("q_live_artist_leaderboard")
def q_live_artist_leaderboard(spark, d):
    """q_artist_leaderboard from the partials, without the store."""
    PA, parts = _live(spark, d)
    return rounded(PA.leaderboard(parts, "artist"))


@query("q_live_label_leaderboard")
def q_live_label_leaderboard(spark, d):
    PA, parts = _live(spark, d)
    return rounded(PA.leaderboard(parts, "label"))


@query("q_live_top_styles")
def q_live_top_styles(spark, d):
    PA, parts = _live(spark, d)
    return PA.top_counts(parts, "style", 10, exclude=[EXCLUDED_STYLE])


@query("q_live_labels_popularity")
def q_live_labels_popularity(spark, d):
    PA, parts = _live(spark, d)
    return rounded(R.top_k(PA.label_stats(parts), "popularity_score", 100, "label_name", TIE_DIGITS))


@query("q_live_label_trend")
def q_live_label_trend(spark, d):
    PA, parts = _live(spark, d)
    return PA.label_trend(parts, digits=TIE_DIGITS)


@query("q_live_style_trend")
def q_live_style_trend(spark, d):
    PA, parts = _live(spark, d)
    return PA.style_trend(parts, exclude=EXCLUDED_STYLE)


@query("q_live_gem_per_year")
def q_live_gem_per_year(spark, d):
    PA, parts = _live(spark, d)
    return rounded(PA.mean_per_year(parts, "gem_value").drop("release_count"))


# --- report and split ----------------------------------------------------------------------------

@query("q_report")
def q_report(spark, d):
    """The report's contents as one long table (section, rank, key, metric, value)."""
    from .report import report_table
    return rounded(report_table(prep(spark, d), excluded_style=EXCLUDED_STYLE, digits=TIE_DIGITS))


@query("q_split_counts")
def q_split_counts(spark, d):
    train, test = ST.train_test_split(prep(spark, d), 0.25, seed=42)
    return train.agg(F.count(F.lit(1)).alias("n")).select(F.lit("train").alias("part"), "n").unionByName(
        test.agg(F.count(F.lit(1)).alias("n")).select(F.lit("test").alias("part"), "n"))
