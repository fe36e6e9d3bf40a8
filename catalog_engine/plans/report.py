"""The summary report (IO-11): one long table of all sections, and its text.

The table (section, rank, key, metric, value) is a union of small frames, all but
the median and the correlations from one aggregate. Formatting it as text is a thin driver-side step
over those few hundred rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EXCLUDED_STYLE, REPORT_SECTIONS, REPORT_SUMMARY, REPORT_TITLE
from ..operators import partials as PA
from ..operators import ranking as R
from ..operators import stats as ST
from ..operators.quantiles import exact_median
from ..session import cut

SCHEMA = "section string, rank int, key string, metric string, value double"
#: Summary lines that are means, by their column.
SUMMARY_MEANS = {c: "average_rating" if c == "average_rating" else "average_total_duration" if c == "total_duration_min"
                 else f"average_{c}" for c in PA.MEANS}


def _section(name: str, df: DataFrame, key: str, metrics: list[str], order: str, tie: str,
             digits: int | None) -> DataFrame:
    """A ranked section as long rows; `df` is the output of a limit."""
    ranked = df.withColumn("rank", F.row_number().over(Window.orderBy(*R.ranking_order(order, tie, digits))))
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return ranked.select(F.lit(name).alias("section"), "rank", F.col(key).alias("key"), F.inline(cells))


def report_table(df: DataFrame, excluded_style: str = EXCLUDED_STYLE, digits: int | None = None) -> DataFrame:
    """All sections over the prepared analysis frame. Counts and means of all of
    them come from one aggregate over the cells of every row (operators/partials),
    written once; besides it only the median and the correlations read the frame."""
    totals = cut(PA.partials(PA.cells(df), "family", "key"))
    labels, artists = PA.label_stats(totals), PA.artist_stats(totals)
    corr_cols = ST.CORR_COLUMNS + (["total_duration_min"] if "total_duration_min" in df.columns else [])
    counts = ["release_count"]
    means = totals.filter("family = 'mean'").select(
        "key", F.col("n").alias("rows"), (F.col("x") / F.col("n_x")).alias("mean"))
    names = F.create_map(*[F.lit(x) for c, name in SUMMARY_MEANS.items() for x in (c, name)])
    whole = means.select(names[F.col("key")].alias("metric"), F.col("mean").alias("value")).unionByName(
        means.agg(F.coalesce(F.max("rows"), F.lit(0)).cast("double").alias("value")).select(
            F.lit("total_releases").alias("metric"), "value")).unionByName(
        df.sparkSession.createDataFrame([("median_rating", exact_median(df, "average_rating"))], "metric string, value double"))
    parts = [
        whole.select(F.lit("summary").alias("section"), F.lit(0).alias("rank"), F.lit("").alias("key"), "metric", "value"),
        _section("genres", PA.top_counts(totals, "genre", 10), "genre", counts, "release_count", "genre", None),
        _section("styles", PA.top_counts(totals, "style", 10, exclude=[excluded_style]), "style", counts, "release_count",
                 "style", None),
        _section("labels_by_popularity", R.top_k(labels, "popularity_score", 100, "label_name", digits), "label_name",
                 ["average_want", "average_rating_coeff", "release_count", "popularity_score"], "popularity_score",
                 "label_name", digits),
        _section("labels_by_rating", R.top_k(labels, "average_rating_coeff", 100, "label_name", digits), "label_name",
                 ["average_rating_coeff", "release_count"], "average_rating_coeff", "label_name", digits),
        _section("artists_by_popularity", R.top_k(artists, "average_want", 100, "artist", digits), "artist",
                 ["average_want", "release_count"], "average_want", "artist", digits),
        _section("artists_by_rating", R.top_k(artists, "average_rating_coeff", 100, "artist", digits), "artist",
                 ["average_rating_coeff", "release_count"], "average_rating_coeff", "artist", digits),
        _section("countries", PA.top_counts(totals, "country", 20), "country", counts, "release_count", "country", None),
        _section("formats", PA.top_counts(totals, "format", 10), "format", counts, "release_count", "format", None),
        ST.corr_matrix(df, corr_cols).select(F.lit("correlations").alias("section"), F.lit(0).alias("rank"),
                                             F.col("col_a").alias("key"), F.col("col_b").alias("metric"),
                                             F.col("r").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def render_report(table: DataFrame, excluded_style: str = EXCLUDED_STYLE) -> str:
    """The report as text: named summary lines (prices with $, durations in
    minutes), ranked lists, and the correlations as a matrix."""
    rows = table.collect()
    lines = [REPORT_TITLE, ""]
    for section, title in REPORT_SECTIONS.items():
        mine = [r for r in rows if r["section"] == section]
        lines.append(title.format(excluded=excluded_style) + ":")
        if section == "summary":
            value = {r["metric"]: r["value"] for r in mine}
            lines += [text.format(value[m]) for m, text in REPORT_SUMMARY.items() if value.get(m) is not None]
        elif section == "correlations":
            names = list(dict.fromkeys(r["key"] for r in mine))
            cell = {(r["key"], r["metric"]): r["value"] for r in mine}
            wide = max(map(len, names), default=0) + 2
            lines.append(" " * wide + "".join(n.rjust(wide) for n in names))
            for a in names:
                shown = ["NaN" if cell[a, b] is None else f"{cell[a, b]:.6f}" for b in names]
                lines.append(a.ljust(wide) + "".join(x.rjust(wide) for x in shown))
        else:
            for rank in sorted({r["rank"] for r in mine}):
                row = [r for r in mine if r["rank"] == rank]
                shown = ", ".join(f"{r['metric']}={r['value']:.6g}" for r in row)
                lines.append(f"{rank}. {row[0]['key']}: {shown}")
        lines.append("")
    return "\n".join(lines)


def write_report(spark, text: str, path: str) -> None:
    """Write the report as one text file (a single small partition)."""
    spark.createDataFrame([(line,) for line in text.split("\n")], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
