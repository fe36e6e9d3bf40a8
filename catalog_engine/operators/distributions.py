"""The data behind the charts: histograms, densities, box statistics and
binned point relations. Nothing is drawn.

Scalars a plan needs (min, max, n, sd) are computed by one small aggregate
first and passed in as literals; every per-row step is then a projection
plus a partial aggregate, so the output size depends on the bin count only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import top_tokens
from .prep import genre_contains_any
from .quantiles import exact_quantiles


def _range(df: DataFrame, col: str):
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def _edges(lo: float, hi: float):
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return lo, hi


def edge(j: Column, lo: float, hi: float, k: int) -> Column:
    """Edge j of k equal bins over [lo, hi] (the last edge is hi itself)."""
    step = (hi - lo) / k
    return F.when(j == k, F.lit(hi)).otherwise(j.cast("double") * F.lit(step) + F.lit(lo))


def bin_index(x: Column, lo: float, hi: float, k: int) -> Column:
    """Index of the bin holding x: edge[i] <= x < edge[i+1], the last bin
    closed. A first estimate from the scaled value is corrected by comparing
    with the neighbouring edges."""
    norm = k / (hi - lo)
    i0 = F.least(F.floor((x - F.lit(lo)) * F.lit(norm)), F.lit(k - 1)).cast("int")
    return (F.when(x < edge(i0, lo, hi, k), i0 - 1)
             .when((x >= edge(i0 + 1, lo, hi, k)) & (i0 != k - 1), i0 + 1)
             .otherwise(i0))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """k equal-width bins over [min, max]: (bin, bin_start, bin_end, count),
    empty bins included with 0. A constant column is widened by 0.5 each side."""
    lo, hi, n = _range(df, col)
    spark = df.sparkSession
    if n == 0 or lo is None:
        return spark.range(0).select(F.col("id").cast("int").alias("bin"), F.lit(0.0).alias("bin_start"),
                                     F.lit(0.0).alias("bin_end"), F.lit(0).cast("long").alias("count"))
    lo, hi = _edges(lo, hi)
    x = F.col(col).cast("double")
    counts = (df.filter(F.col(col).isNotNull()).select(bin_index(x, lo, hi, bins).alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    allbins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (allbins.join(counts, "bin", "left")
                   .select("bin", edge(F.col("bin"), lo, hi, bins).alias("bin_start"),
                           edge(F.col("bin") + 1, lo, hi, bins).alias("bin_end"),
                           F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def unit_histogram(df: DataFrame, col: str) -> DataFrame:
    """Counts per integer value 0..max (unit bins), gaps 0."""
    lo, hi, n = _range(df, col)
    spark = df.sparkSession
    top = int(hi) if hi is not None else -1
    counts = df.groupBy(F.col(col).cast("long").alias(col)).agg(F.count(F.lit(1)).alias("count"))
    allv = spark.range(0, top + 1).select(F.col("id").alias(col))
    return allv.join(counts, col, "left").select(col, F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# Bins per bandwidth, and bandwidths beyond which a kernel adds nothing that a double shows.
KDE_BINS, KDE_REACH = 20, 8.5


def column_densities(df: DataFrame, cols: list[str], grid: int = 200) -> DataFrame:
    """Gaussian densities of several columns in one long frame (column,
    grid_index, x, density), on `grid` points over each column's [min, max] with
    the Scott bandwidth h = sd * n^(-1/5) (sd with ddof 1).

    Rows are first reduced to weighted centres (count, mean) of bins h / 20
    wide, whatever the range, so a bin's spread stays far below the bandwidth at
    any size; a centre adds only to the grid points within 8.5 h. One aggregate
    gives all ranges and deviations, one stacked aggregate all centres.
    Constant or empty columns have no density."""
    spark = df.sparkSession
    r = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{k}") for k, c in enumerate(cols)
                 for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count), ("sd", F.stddev_samp))]).first()
    facts = []
    for k, c in enumerate(cols):
        lo, hi, n, sd = (r[f"{x}{k}"] for x in ("lo", "hi", "n", "sd"))
        if n and sd and not math.isnan(sd):
            facts.append((c, float(lo), float(hi), n, float(sd) * n ** (-1.0 / 5.0)))
    if not facts:
        return spark.range(0).select(F.lit("").alias("column"), F.col("id").cast("int").alias("grid_index"),
                                     F.lit(0.0).alias("x"), F.lit(0.0).alias("density"))
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v"))
                                           for k, (c, *_) in enumerate(facts)]))).filter("v IS NOT NULL")

    def per(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("k") + 1)

    lo, h = per([f[1] for f in facts]), per([f[4] for f in facts])
    step = per([(f[2] - f[1]) / (grid - 1) if grid > 1 else 0.0 for f in facts])
    norm = per([1.0 / (f[3] * f[4] * math.sqrt(2 * math.pi)) for f in facts])
    centres = (stacked.groupBy("k", F.floor((F.col("v") - lo) * F.lit(float(KDE_BINS)) / h).alias("b"))
               .agg(F.count(F.lit(1)).alias("w"), F.avg("v").alias("c")))
    reach = F.lit(KDE_REACH) * h
    first = F.greatest(F.lit(0), F.ceil((F.col("c") - reach - lo) / step))
    last = F.least(F.lit(grid - 1), F.floor((F.col("c") + reach - lo) / step))
    g = F.col("grid_index").cast("double") * step + lo
    z = (g - F.col("c")) / h
    sums = (centres.filter(first <= last)
            .withColumn("grid_index", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
            .groupBy("k", "grid_index").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s")))
    every = spark.range(len(facts) * grid).select((F.col("id") / grid).cast("int").alias("k"),
                                                  (F.col("id") % grid).cast("int").alias("grid_index"))
    return every.join(sums, ["k", "grid_index"], "left").select(
        per([f[0] for f in facts]).alias("column"), "grid_index", g.alias("x"),
        (F.coalesce("s", F.lit(0.0)) * norm).alias("density"))


def kde(df: DataFrame, col: str, grid: int = 200) -> DataFrame:
    """The density of one column (grid_index, x, density); see column_densities."""
    return column_densities(df, [col], grid).drop("column")


def box_stats(df: DataFrame, group: str, value: str, approx: bool = False) -> DataFrame:
    """Per group: q1, median, q3 (linear interpolation), whiskers = furthest
    values within 1.5 IQR of the quartiles, and the number of points beyond
    the whiskers. Exact quartiles come by rank selection, whatever a group's
    size; approx=True uses percentile_approx."""
    rows = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).filter(
        F.col("_g").isNotNull() & F.col("_v").isNotNull())
    probs = [0.25, 0.5, 0.75]
    quart = (rows.groupBy("_g").agg(F.percentile_approx("_v", probs, 10000).alias("_q"), F.count(F.lit(1)).alias("n")) if approx
             else exact_quantiles(rows, "_v", probs, "_g").withColumnRenamed("quantiles", "_q"))
    quart = quart.select("_g", "n", F.col("_q")[0].cast("double").alias("q1"), F.col("_q")[1].cast("double").alias("median"),
        F.col("_q")[2].cast("double").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    fences = quart.select("_g", "n", "q1", "median", "q3",
                          (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    # One row per group: the planner broadcasts it when small, else shuffles.
    # A value lies beyond a whisker exactly when it lies beyond the fence (the
    # whiskers are the extreme values inside the fences, and the quartiles
    # themselves are inside), so one aggregate gives whiskers and outliers.
    j = rows.join(fences, "_g")
    whisk = j.groupBy("_g").agg(
        F.min(F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).alias("_wl"),
        F.max(F.when(F.col("_v") <= F.col("_hi"), F.col("_v"))).alias("_wh"),
        F.count_if((F.col("_v") < F.col("_lo")) | (F.col("_v") > F.col("_hi"))).alias("n_outliers"))
    return fences.join(whisk, "_g").withColumnRenamed("_g", group).select(
        group, "n", "q1", "median", "q3",
        F.coalesce("_wl", "q1").alias("whisker_low"), F.coalesce("_wh", "q3").alias("whisker_high"), "n_outliers")


def box_by_top_genres(df: DataFrame, value: str, n: int = 5) -> DataFrame:
    """Box statistics of `value` per raw genre text, over rows whose genre
    text contains any of the n most frequent genre tokens."""
    top = [r["genre"] for r in top_tokens(df, "genre", n).collect()]
    return box_stats(genre_contains_any(df, top), "genre", value)


def points(df: DataFrame, x: str, y: str, colour: str | None = None, bins: int | None = 50,
           fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Point relation behind a scatter. bins: a bins x bins grid over the two
    ranges with the count (and mean colour) per cell. fraction: a seeded
    sample of the points. Neither: the projected points."""
    if bins is None:
        p = df.select(x, y, *([colour] if colour else []))
        return p.sample(fraction=fraction, seed=seed) if fraction else p
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = both.agg(F.min(x).alias("xl"), F.max(x).alias("xh"), F.min(y).alias("yl"), F.max(y).alias("yh")).first()
    if r["xl"] is None:
        xl, xh, yl, yh = 0.0, 1.0, 0.0, 1.0
    else:
        (xl, xh), (yl, yh) = _edges(r["xl"], r["xh"]), _edges(r["yl"], r["yh"])
    xb = bin_index(F.col(x).cast("double"), xl, xh, bins).alias("x_bin")
    yb = bin_index(F.col(y).cast("double"), yl, yh, bins).alias("y_bin")
    aggs = [F.count(F.lit(1)).alias("count")]
    if colour:
        aggs.append(F.avg(colour).alias(f"mean_{colour}"))
    return both.groupBy(xb, yb).agg(*aggs)


def sample_points(df: DataFrame, x: str, y: str, k: int, seed: int = 42, key: str = "id", stratum: str | None = None) -> DataFrame:
    """Exactly k points (all, if there are fewer) behind a scatter, per stratum
    if one is named: those with the least md5 of seed and key, so the same ones
    however the data are partitioned. Rows with a null coordinate, key or stratum
    are left out; equal keys follow by their coordinates."""
    named = [stratum] if stratum else []
    rows = df.select(*named, key, x, y).dropna()
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key), F.col(x), F.col(y)]
    if not stratum:
        return rows.orderBy(*order).limit(k)
    # a limit per group keeps at most k rows of each in every task before the shuffle
    return (rows.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))
            .filter(F.col("_r") <= k).drop("_r"))


def pairwise(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """Binned relation of every column pair (a < b in the given order):
    (x_col, y_col, x_bin, y_bin, count). Each row is binned once per column;
    rows in the same bins are counted before they emit one cell per pair."""
    clean = df.select(*cols).dropna()
    r = clean.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    if r[f"lo_{cols[0]}"] is None:
        return df.sparkSession.createDataFrame([], "x_col string, y_col string, x_bin int, y_bin int, count long")
    binned = clean.select(*[bin_index(F.col(c).cast("double"), *_edges(r[f"lo_{c}"], r[f"hi_{c}"]), bins).alias(c)
                            for c in cols])
    # equal rows of bins first, so that a row is expanded to pairs once per distinct cell
    binned = binned.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    cells = [F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"), F.col(a).alias("x_bin"), F.col(b).alias("y_bin"))
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    return (binned.select("_n", F.inline(F.array(*cells)))
                  .groupBy("x_col", "y_col", "x_bin", "y_bin").agg(F.sum("_n").alias("count")))
