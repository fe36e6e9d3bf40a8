"""Aggregations over the analysis frame.

Every grouped measure here (count, sum, avg, min, max) aggregates partially
before the shuffle, so a key holding a large share of rows (one style on a
third of the catalogue) costs one partial row per task, not a hot reducer.
Rankings end with the key ascending so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LIST_SEPARATOR, WORD_PATTERN
from ..functions import artist_key, csv_tokens, json_list, label_name
from .quantiles import exact_median


def tokens(df: DataFrame, col: str, exclude=(), alias: str | None = None) -> DataFrame:
    """One row per ', ' token of a multi-valued text ('' stays a token)."""
    t = F.explode(F.split(F.col(col), LIST_SEPARATOR)).alias(alias or col)
    out = df.select(t)
    if exclude:
        out = out.filter(~F.col(alias or col).isin(list(exclude)))
    return out


def token_counts(df: DataFrame, col: str, exclude=()) -> DataFrame:
    return tokens(df, col, exclude).groupBy(col).agg(F.count(F.lit(1)).alias("release_count"))


def top_tokens(df: DataFrame, col: str, n: int, exclude=()) -> DataFrame:
    """Most frequent tokens of a ', '-joined column (value counts of the
    exploded tokens), top n."""
    return token_counts(df, col, exclude).orderBy(F.desc("release_count"), F.asc(col)).limit(n)


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """Most frequent whole values (no split), top n."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("release_count"))
              .orderBy(F.desc("release_count"), F.asc(col)).limit(n))


def exploded_labels(df: DataFrame, keep=("id", "want", "rating_coefficient", "year")) -> DataFrame:
    """One row per label member of the JSON `labels` text; a release without
    labels keeps one 'Unknown' row; an explicit null name gives a null key."""
    keep = [c for c in keep if c in df.columns]
    e = df.select(*keep, F.explode_outer(json_list("labels")).alias("_lab"))
    return e.select(*keep, label_name(F.col("_lab")).alias("label_name"))


def label_stats(df: DataFrame) -> DataFrame:
    """Per label: mean want, mean rating coefficient, release count and
    popularity = the sum of the two means. A label listed twice on one release
    counts twice; null names are dropped."""
    e = exploded_labels(df).filter(F.col("label_name").isNotNull())
    return (e.groupBy("label_name").agg(
                F.avg("want").alias("average_want"),
                F.avg("rating_coefficient").alias("average_rating_coeff"),
                F.count("id").alias("release_count"))
             .withColumn("popularity_score", F.col("average_want") + F.col("average_rating_coeff")))


def artist_stats(df: DataFrame, measure: str, alias: str) -> DataFrame:
    """Per artist (stripped artists_sort, '' -> 'Unknown'): mean of a measure
    and release count."""
    a = df.select(artist_key("artists_sort").alias("artist"), F.col(measure))
    return (a.filter(F.col("artist").isNotNull()).groupBy("artist")
             .agg(F.avg(measure).alias(alias), F.count("artist").alias("release_count")))


def summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """Whole-table summary, one row. The median is exact (linear interpolation),
    by rank selection; approx=True uses percentile_approx in the same pass."""
    med = (F.percentile_approx("average_rating", 0.5, 10000).cast("double") if approx
           else F.lit(exact_median(df, "average_rating")).cast("double"))
    cols = [F.count(F.lit(1)).alias("total_releases"),
            F.avg("average_rating").alias("average_rating"),
            med.alias("median_rating"),
            F.avg("rating_count").alias("average_rating_count"),
            F.avg("demand_coefficient").alias("average_demand_coefficient"),
            F.avg("gem_value").alias("average_gem_value"),
            F.avg("lowest_price").alias("average_lowest_price"),
            F.avg("num_tracks").alias("average_num_tracks")]
    if "total_duration_min" in df.columns:
        cols.append(F.avg("total_duration_min").alias("average_total_duration"))
    return df.agg(*cols)


def facets(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct comma tokens (stripped, empties dropped): the values of
    a filter drop-down."""
    return df.select(F.explode(csv_tokens(col)).alias(col)).distinct().orderBy(col)


def term_frequencies(df: DataFrame, col: str, exclude=()) -> DataFrame:
    """Word counts behind a word cloud: the ', ' tokens (less `exclude`) are
    re-tokenised into words matching \\w[\\w']+, lower-cased."""
    t = tokens(df, col, exclude, alias="_tok")
    words = t.select(F.explode(F.regexp_extract_all("_tok", F.lit(WORD_PATTERN), 0)).alias("_w"))
    return (words.select(F.lower("_w").alias("term")).groupBy("term")
                 .agg(F.count(F.lit(1)).alias("frequency")))
