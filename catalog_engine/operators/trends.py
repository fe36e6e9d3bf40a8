"""Time trends and pivots over the analysis frame (year is an int)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EXCLUDED_STYLE, LIST_SEPARATOR
from .aggregates import exploded_labels, label_stats, top_tokens, top_values
from .prep import restrict_to_top
from .ranking import top_k


def releases_per_year(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("year").isNotNull()).groupBy("year")
              .agg(F.count(F.lit(1)).alias("release_count")).orderBy("year"))


def gem_per_year(df: DataFrame) -> DataFrame:
    return (df.dropna(subset=["year", "gem_value"]).groupBy("year")
              .agg(F.avg("gem_value").alias("average_gem_value")).orderBy("year"))


def label_trend(df: DataFrame, n: int = 10, digits: int | None = None) -> DataFrame:
    """(year, label, count) for the n most popular labels."""
    top = top_k(label_stats(df), "popularity_score", n, "label_name", digits)
    e = restrict_to_top(exploded_labels(df), "label_name", top).dropna(subset=["year"])
    return e.groupBy("year", "label_name").agg(F.count(F.lit(1)).alias("release_count"))


def stripped_styles(df: DataFrame, keep=("id", "title", "artists_sort", "year")) -> DataFrame:
    keep = [c for c in keep if c in df.columns]
    t = F.explode(F.split(F.col("style"), LIST_SEPARATOR)).alias("style")
    return df.select(*keep, t).withColumn("style", F.regexp_replace("style", r"^\s+|\s+$", ""))


def top_style_names(df: DataFrame, n: int = 10, exclude: str = EXCLUDED_STYLE) -> DataFrame:
    """Top n style tokens (unstripped, less the excluded one); a limit, so bounded."""
    return top_tokens(df, "style", n, exclude=[exclude])


def style_trend(df: DataFrame, n: int = 10, exclude: str = EXCLUDED_STYLE) -> DataFrame:
    """(year, style, count) of the top n styles; the top list uses unstripped
    tokens, the counts stripped ones."""
    s = restrict_to_top(stripped_styles(df), "style", top_style_names(df, n, exclude))
    return s.groupBy("year", "style").agg(F.count(F.lit(1)).alias("release_count"))


def wide(long: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Year x key counts, one column per value (explicit values: no extra
    distinct job), gaps 0."""
    w = long.groupBy("year").pivot(key, values).agg(F.sum("release_count"))
    return w.fillna(0, subset=values).orderBy("year")


def positional(long: DataFrame, key: str, top: DataFrame, n: int) -> DataFrame:
    """Year x rank counts with fixed columns c01..cNN: the count of the
    key that is first, second, ... in `top` (its keys and release counts)."""
    w = Window.orderBy(F.desc("release_count"), F.asc(key))  # over the n rows of a limit
    ranks = top.select(F.col(key).alias("_key"), F.row_number().over(w).alias("_rank"))
    ranked = long.join(F.broadcast(ranks), F.col(key) == F.col("_key"))
    return ranked.groupBy("year").agg(*[
        F.coalesce(F.max(F.when(F.col("_rank") == k, F.col("release_count"))), F.lit(0)).alias(f"c{k:02d}")
        for k in range(1, n + 1)])


def style_trend_wide(df: DataFrame, n: int = 10, exclude: str = EXCLUDED_STYLE) -> DataFrame:
    values = [r["style"] for r in top_style_names(df, n, exclude).collect()]
    return wide(style_trend(df, n, exclude), "style", values)


def style_defining(df: DataFrame, n: int = 10, exclude: str = EXCLUDED_STYLE) -> DataFrame:
    """Every release of each top style in the first year the style appears:
    id, title, artists_sort, year, style."""
    s = restrict_to_top(stripped_styles(df), "style", top_style_names(df, n, exclude))
    s = s.filter(F.col("year").isNotNull())
    first = (s.groupBy("style").agg(F.min("year").alias("_first"))  # <= n rows
              .withColumnRenamed("style", "_style"))
    on = (F.col("style") == F.col("_style")) & (F.col("year") == F.col("_first"))
    return s.join(F.broadcast(first), on).select("id", "title", "artists_sort", "year", "style")


def country_trend(df: DataFrame, n: int = 10) -> DataFrame:
    top = top_values(df, "country", n)
    c = restrict_to_top(df.select("year", "country"), "country", top)
    return c.groupBy("year", "country").agg(F.count(F.lit(1)).alias("release_count"))


def country_trend_wide(df: DataFrame, n: int = 10) -> DataFrame:
    values = [r["country"] for r in top_values(df, "country", n).collect()]
    return wide(country_trend(df, n), "country", values)
