"""Rankings: Bayesian leaderboards, pages, top-k, best styles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LEADERBOARD_PAGE_SIZE, LEADERBOARD_PRIOR_WEIGHT, LIST_SEPARATOR
from ..functions import as_number, round_to
from ..session import cut
from .prep import entity_key, filter_releases
from .quantiles import exact_median


def leaderboard(df: DataFrame, entity: str = "artist", m: float = LEADERBOARD_PRIOR_WEIGHT,
                rating_col: str = "rating_coeff", **filters) -> DataFrame:
    """Bayesian leaderboard over the filtered clean releases. G is the mean
    rating of all kept rows; per entity: sum, count, mean and
    score = (m*G + sum) / (m + count). Unsorted: rank with leaderboard_page
    or top_k. No rows in -> no rows out."""
    rows = filter_releases(df, entity=entity, **filters) if filters else df
    dtype = rows.schema[rating_col].dataType
    r = as_number(rating_col, dtype)
    keyed = rows.select(entity_key(entity).alias(entity), r.alias("_r"))
    grouped = keyed.groupBy(entity).agg(F.sum("_r").alias("_sum"), F.count(F.lit(1)).alias("release_count"))
    # G from the groups, as a scalar subquery: the rows are scanned once, lazily
    prior = grouped.agg((F.sum("_sum") / F.sum("release_count")).alias("g")).scalar()
    return grouped.select(
        entity, "release_count",
        (F.col("_sum") / F.col("release_count")).alias("average_rating_coeff"),
        ((F.lit(float(m)) * prior + F.col("_sum")) / (F.lit(float(m)) + F.col("release_count"))).alias("bayesian_score"),
    )


def ranking_order(score: str, name: str, digits: int | None = None):
    """Score descending, then name. `digits` makes scores that agree to so many
    decimals ties (for comparing engines that add in another order)."""
    return [(F.col(score) if digits is None else round_to(score, digits)).desc(), F.col(name).asc()]


def top_k(df: DataFrame, by: str, k: int, tie: str, digits: int | None = None) -> DataFrame:
    """First k rows by `by` descending, then `tie` ascending (TakeOrderedAndProject)."""
    key = round_to(by, digits) if digits is not None else F.col(by)
    return df.orderBy(key.desc(), F.col(tie).asc()).limit(k)


def leaderboard_page(lb: DataFrame, page: int = 1, size: int = LEADERBOARD_PAGE_SIZE,
                     score: str = "bayesian_score", name: str | None = None, digits: int | None = None) -> DataFrame:
    """Page `page` (1-based) of a ranked leaderboard with its 1-based rank.
    Only the first page*size rows are taken (a bounded top-k); the rank window
    runs over that small set, never over the whole input."""
    name = name or lb.columns[0]
    order = ranking_order(score, name, digits)
    head = lb.orderBy(*order).limit(page * size)
    w = Window.orderBy(*order)
    ranked = head.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") > (page - 1) * size).select("rank", *lb.columns)


def page_totals(lb: DataFrame, size: int = LEADERBOARD_PAGE_SIZE) -> DataFrame:
    """Number of entities and pages of a leaderboard (one row)."""
    return lb.agg(F.count(F.lit(1)).alias("entity_count")).select(
        "entity_count", F.ceil(F.col("entity_count") / F.lit(size)).cast("long").alias("page_count"))


def style_stats(df: DataFrame, rating_col: str = "rating_coefficient") -> DataFrame:
    t = df.select(F.explode(F.split(F.col("style"), LIST_SEPARATOR)).alias("style_list"), F.col(rating_col).alias("_r"))
    return t.groupBy("style_list").agg(F.sum("_r").alias("sum_rating_coeff"),
                                       F.count(F.lit(1)).alias("release_count"))


def style_priors(stats: DataFrame) -> tuple[float, float]:
    """Default priors: m = median style size, C = mean of per-style means."""
    c = stats.agg(F.avg(F.col("sum_rating_coeff") / F.col("release_count"))).first()[0]
    return float(exact_median(stats, "release_count") or 0.0), float(c or 0.0)


def best_styles(df: DataFrame, m: float | None = None, C: float | None = None, k: int = 100,
                digits: int | None = None) -> DataFrame:
    """Best-rated styles: per style token, sum and count of the rating
    coefficient, bayesian_avg = (sum + m*C) / (count + m), top k."""
    stats = style_stats(df)
    if m is None or C is None:
        stats = cut(stats)  # read several times by the priors
        dm, dc = style_priors(stats)
        m = dm if m is None else m
        C = dc if C is None else C
    scored = stats.withColumn(
        "bayesian_avg", (F.col("sum_rating_coeff") + F.lit(m * C)) / (F.col("release_count") + F.lit(float(m))))
    return top_k(scored, "bayesian_avg", k, "style_list", digits)
