"""Statistics and models: correlations, VIF, OLS with its diagnostics, tree
feature importances.

The data pass of every statistic is one distributed aggregate of constant
size (counts, sums, cross products of at most a dozen columns) or a Spark ML
fit; only that p x p summary reaches the driver, where numpy solves it.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .positions import with_positions

CORR_COLUMNS = ["average_rating", "rating_count", "have", "want", "rating_coefficient",
                "demand_coefficient", "gem_value", "num_for_sale", "lowest_price", "num_tracks"]
PRICE_FEATURES = ["average_rating", "rating_count", "have", "want", "rating_coefficient",
                  "demand_coefficient", "gem_value", "num_for_sale", "year", "num_tracks",
                  "total_duration_min"]
VIF_FEATURES = ["gem_value", "demand_coefficient", "rating_coefficient", "average_rating",
                "rating_count", "have", "want", "num_for_sale", "year", "num_tracks",
                "total_duration_min"]
OLS_FEATURES = ["gem_value", "demand_coefficient", "rating_coefficient", "average_rating",
                "want", "have"]
TREE_NUMERIC = ["gem_value", "demand_coefficient", "rating_coefficient", "average_rating",
                "rating_count", "have", "want", "num_for_sale", "year", "num_tracks",
                "total_duration_min"]
TREE_CATEGORICAL = ["style", "format", "country"]


# --- correlation --------------------------------------------------------------

def _corr(a: str, b: str):
    """Pearson r; null where a column is constant (pandas gives NaN)."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long correlation matrix (col_a, col_b, r), all ordered pairs. The data
    pass is the centred moment matrix (two constant-size aggregates); r is
    S_ab / sqrt(S_aa S_bb), null where a column is constant."""
    _, _, S = moments(df, cols)
    d = np.sqrt(np.diag(S))
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            r = float(S[i, j] / (d[i] * d[j])) if d[i] > 0 and d[j] > 0 else None
            rows.append((a, b, r))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def corr_with(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """(feature, r) of each column with the target, rows with nulls dropped."""
    d = df.select(*[F.col(c).cast("double") for c in cols + [target]]).dropna()
    one = d.agg(*[_corr(c, target).alias(f"r_{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"r_{i}").alias("r")) for i, c in enumerate(cols)])))


# --- moments, VIF -------------------------------------------------------------

def moments(df: DataFrame, cols: list[str]):
    """n, column means and the centred cross-product matrix S of the non-null
    rows, in two scans: the means, then plain sums of the products of what is
    left of each column beside its mean, so large offsets cost no digits. Sums
    of products cost a row far less than p (p + 1) / 2 merged covariances."""
    d = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).dropna()
    p = len(cols)
    first = d.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(p)]).first()
    n, mean = int(first["n"]), [first[f"m{i}"] or 0.0 for i in range(p)]
    e = d.select(*[(F.col(f"c{i}") - F.lit(float(mean[i]))).alias(f"e{i}") for i in range(p)])
    r = e.agg(*[F.sum(f"e{i}").alias(f"d{i}") for i in range(p)],
              *[F.sum(F.col(f"e{i}") * F.col(f"e{j}")).alias(f"s_{i}_{j}") for i in range(p) for j in range(i, p)]).first()
    left = [r[f"d{i}"] or 0.0 for i in range(p)]  # what rounding of the means leaves
    S = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            S[i, j] = S[j, i] = (r[f"s_{i}_{j}"] or 0.0) - (left[i] * left[j] / n if n else 0.0)
    return n, np.array(mean, dtype=float), S


def _vif_values(n: int, mean: np.ndarray, S: np.ndarray) -> list[float]:
    p = len(mean)
    # unit scales: the inflation does not depend on them, the solver does
    scale = np.where(np.diag(S) > 0, np.sqrt(np.abs(np.diag(S)) / max(n, 1)), 1.0)
    mean, S = mean / scale, S / np.outer(scale, scale)
    out = []
    # constant: regressing 1 on the uncentred features (no intercept) leaves
    # n / (1 + n m' S^-1 m), so its inflation is that divisor
    d = np.sqrt(np.where(np.diag(S) > 0, np.diag(S), 1.0))
    unit, m = S / np.outer(d, d), mean / d
    if np.linalg.cond(unit) < 1e12:
        out.append(float(1 + n * m @ np.linalg.solve(unit, m)))
    else:
        xtx, xt1 = S + n * np.outer(mean, mean), n * mean
        ssr0 = n - xt1 @ np.linalg.pinv(xtx) @ xt1
        out.append(math.inf if ssr0 <= 1e-12 * n else float(n / ssr0))
    for i in range(p):
        others = [j for j in range(p) if j != i]
        sii = S[i, i]
        if sii <= 0:
            out.append(math.inf)
            continue
        if not others:
            out.append(1.0)
            continue
        soo = S[np.ix_(others, others)]
        soi = S[others, i]
        ssr = sii - soi @ np.linalg.pinv(soo) @ soi
        out.append(math.inf if ssr <= 1e-12 * sii else float(sii / ssr))
    return out


def vif(df: DataFrame, features: list[str]) -> DataFrame:
    """Variance inflation of each feature and of the constant: 1/(1-R^2) of
    its regression on all the others (the constant's R^2 is uncentred)."""
    n, mean, S = moments(df, features)
    vals = _vif_values(n, mean, S)
    rows = list(zip(["const"] + features, vals))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


# --- distributions used by the tests ----------------------------------------------

def _betacf(a, b, x):
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbeta) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbeta) * _betacf(b, a, 1 - x) / b


def t_sf(t: float, dof: float) -> float:
    """P(T > t) for Student's t."""
    x = dof / (dof + t * t)
    tail = 0.5 * betainc(dof / 2.0, 0.5, x)
    return tail if t >= 0 else 1.0 - tail


def t_ppf(q: float, dof: float) -> float:
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if 1.0 - t_sf(mid, dof) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution."""
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def skewtest_z(s: float, n: int) -> float:
    y = s * math.sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1))
    y = 1.0 if y == 0 else y
    return delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))


def kurtosistest_z(k: float, n: int) -> float:
    """k is the Pearson (non-excess) kurtosis."""
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5))
    x = (k - e) / math.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / (sb1 ** 2)))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + x * math.sqrt(2 / (a - 4.0))
    term2 = math.copysign(1.0, denom) * ((1 - 2.0 / a) / abs(denom)) ** (1 / 3.0) if denom != 0 else math.inf
    return (term1 - term2) / math.sqrt(2 / (9.0 * a))


# --- OLS ------------------------------------------------------------------------

class OlsFit(NamedTuple):
    """Least squares with an intercept, solved from the moment matrix."""
    terms: list[str]
    coef: np.ndarray
    std_err: np.ndarray
    n: int
    ssr: float
    sst: float
    condition: float

    @property
    def dof(self) -> int:
        return self.n - len(self.terms)


def fit_ols(df: DataFrame, y: str = "lowest_price", xs: list[str] = OLS_FEATURES) -> OlsFit:
    """Two aggregates of constant size give all that the tables need; the
    system of as many unknowns as there are terms is solved on unit scales."""
    n, mean, S = moments(df, [y, *xs])
    scale = np.where(np.diag(S) > 0, np.sqrt(np.abs(np.diag(S))), 1.0)
    unit = S / np.outer(scale, scale)
    inverse = np.linalg.inv(unit[1:, 1:])
    slopes = inverse @ unit[1:, 0] * scale[0] / scale[1:]
    ssr = float(S[0, 0] - slopes @ S[1:, 0])
    dof = n - len(xs) - 1
    variance = ssr / dof
    per_scale = mean[1:] / scale[1:]
    std_err = np.sqrt(variance * np.concatenate([[1 / n + per_scale @ inverse @ per_scale],
                                                 np.diag(inverse) / scale[1:] ** 2]))
    xtx = np.zeros((len(xs) + 1, len(xs) + 1))
    xtx[0, 0] = n
    xtx[0, 1:] = xtx[1:, 0] = n * mean[1:]
    xtx[1:, 1:] = S[1:, 1:] + n * np.outer(mean[1:], mean[1:])
    ev = np.linalg.eigvalsh(xtx)
    return OlsFit(["const", *xs], np.concatenate([[mean[0] - slopes @ mean[1:]], slopes]), std_err, n, ssr, float(S[0, 0]),
                  math.sqrt(ev[-1] / ev[0]) if ev[0] > 0 else math.inf)


def ols_coef(df: DataFrame, fit: OlsFit) -> DataFrame:
    """(term, coef, std_err, t)."""
    rows = [(t, float(c), float(e), float(c / e)) for t, c, e in zip(fit.terms, fit.coef, fit.std_err)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, std_err double, t double")


def ols_fit(df: DataFrame, fit: OlsFit) -> DataFrame:
    """One row: sizes, R^2, F, log-likelihood, AIC and BIC."""
    n, k = fit.n, len(fit.terms)
    r2 = 1 - fit.ssr / fit.sst
    f = (r2 / (k - 1)) / ((1 - r2) / fit.dof) if r2 < 1 else math.inf
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(fit.ssr / n) + 1)
    row = (n, fit.dof, k - 1, r2, 1 - (1 - r2) * (n - 1) / fit.dof, f, llf, -2 * llf + 2 * k, -2 * llf + k * math.log(n))
    return df.sparkSession.createDataFrame([row], "n_obs long, df_resid long, df_model long, r_squared double, "
                                                  "adj_r_squared double, f_statistic double, log_likelihood double, "
                                                  "aic double, bic double")


def residuals(df: DataFrame, fit: OlsFit, y: str = "lowest_price", order_col: str = "id") -> DataFrame:
    """(k, e): the order column and the residual of every row without nulls."""
    xs = fit.terms[1:]
    data = df.select(F.col(order_col).alias("k"), *[F.col(c).cast("double").alias(c) for c in [y, *xs]]).dropna()
    predicted = F.lit(float(fit.coef[0]))
    for c, b in zip(xs, fit.coef[1:]):
        predicted = predicted + F.lit(float(b)) * F.col(c)
    return data.select("k", (F.col(y) - predicted).alias("e"))


def ols_diagnostics(df: DataFrame, fit: OlsFit, y: str = "lowest_price", order_col: str = "id") -> DataFrame:
    """Residual skew, kurtosis, Jarque-Bera and Durbin-Watson (in `order_col` order)."""
    e = residuals(df, fit, y, order_col)
    m = e.agg(F.count(F.lit(1)).alias("n"), F.skewness("e").alias("s"), F.kurtosis("e").alias("k")).first()
    n, s, k = int(m["n"]), float(m["s"]), float(m["k"]) + 3.0
    row = (n, s, k, n / 6.0 * (s * s + (k - 3) ** 2 / 4.0), durbin_watson(e, "k", "e"))
    return df.sparkSession.createDataFrame([row], "n_obs long, skew double, kurtosis double, jarque_bera double, "
                                                  "durbin_watson double")


def ols_tails(df: DataFrame, fit: OlsFit, y: str = "lowest_price", order_col: str = "id") -> DataFrame:
    """What needs distribution functions, as (statistic, term, value): p-values,
    95% bounds, the omnibus test (D'Agostino K^2), and the condition number."""
    rows, tq, k = [], t_ppf(0.975, fit.dof), len(fit.terms)
    for t, c, e in zip(fit.terms, map(float, fit.coef), map(float, fit.std_err)):
        rows += [("p_value", t, 2 * t_sf(abs(c / e), fit.dof)), ("ci_low", t, c - tq * e), ("ci_high", t, c + tq * e)]
    r2 = 1 - fit.ssr / fit.sst
    f = (r2 / (k - 1)) / ((1 - r2) / fit.dof) if r2 < 1 else math.inf
    d = ols_diagnostics(df, fit, y, order_col).first()
    k2 = skewtest_z(d["skew"], d["n_obs"]) ** 2 + kurtosistest_z(d["kurtosis"], d["n_obs"]) ** 2
    rows += [("f_p_value", "", f_sf(f, k - 1, fit.dof)), ("omnibus", "", k2), ("omnibus_p", "", math.exp(-k2 / 2)),
             ("jarque_bera_p", "", math.exp(-d["jarque_bera"] / 2)), ("condition_number", "", fit.condition)]
    return df.sparkSession.createDataFrame(rows, "statistic string, term string, value double")


def _range_of(col: str, cuts: list) -> Column:
    """How many of the sorted cuts lie below a value: found in two steps of about
    the root of their number each."""
    width = math.isqrt(len(cuts)) + 1
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col(col)))
    whole = below(F.array(*map(F.lit, cuts[width - 1::width]))) if len(cuts) >= width else F.lit(0)
    rest = F.slice(F.array(*map(F.lit, cuts)), whole * width + 1, F.lit(width)) if cuts else None
    return whole * width + (below(rest) if cuts else F.lit(0))


def durbin_watson(resid: DataFrame, order_col: str, resid_col: str, parts: int | None = None) -> float:
    """sum((e_t - e_{t-1})^2) / sum(e_t^2) in the order of a numeric column; rows
    without it, or without a residual, are left out, rows with equal values follow
    their residuals, and no rows give NaN. Rows are
    dealt into ranges between approximate quantiles (`parts` numbers reach the
    driver); `lag` gives the steps within a range, and the last residual of each
    range that has rows meets the first of the next. No window over all rows."""
    parts = parts or resid.sparkSession.sparkContext.defaultParallelism
    r = resid.select(F.col(order_col).alias("k"), F.col(resid_col).cast("double").alias("e")).dropna()
    at = r.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("cuts")).first()["cuts"]
    ranges = r.withColumn("part", _range_of("k", sorted(set(at or []))))
    steps = ranges.withColumn("step", F.col("e") - F.lag("e").over(Window.partitionBy("part").orderBy("k", "e")))
    ends = steps.groupBy("part").agg(
        F.sum(F.col("step") * F.col("step")).alias("inner"), F.sum(F.col("e") * F.col("e")).alias("sq"),
        F.min(F.struct("k", "e"))["e"].alias("first"), F.max(F.struct("k", "e"))["e"].alias("last"))
    rows = sorted(ends.collect(), key=lambda x: x["part"])  # a row per range
    num = sum(x["inner"] or 0.0 for x in rows)
    num += sum((b["first"] - a["last"]) ** 2 for a, b in zip(rows, rows[1:]))
    den = sum(x["sq"] for x in rows)
    return num / den if den else math.nan


# --- tree importances ---------------------------------------------------------------

def train_test_split(df: DataFrame, test: float = 0.25, seed: int = 42, key: str = "id"):
    """(train, test) by a hash of the key and the seed: the same rows land in
    the same part however the data are partitioned."""
    digest = F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), 1, 8)
    in_test = digest < F.lit(f"{min(int(test * 2 ** 32), 2 ** 32 - 1):08x}")
    return df.filter(~in_test), df.filter(in_test)


class _Split(NamedTuple):
    """An inner node: its feature, and the leaves on either side by number."""

    feature: int
    left: list[int]
    right: list[int]


def _read_tree(text: str) -> tuple[list[_Split], list[float]]:
    """Inner nodes and leaf predictions, leaves numbered from the left, of a
    tree's printed form."""
    lines = [x.strip() for x in text.splitlines() if x.strip().startswith(("If ", "Else ", "Predict:"))]
    splits: list[_Split] = []
    leaves: list[float] = []
    at = 0

    def node() -> list[int]:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            leaves.append(float(line.split(":")[1]))
            return [len(leaves) - 1]
        feature = int(line.split("feature ")[1].split(" ")[0])
        left = node()
        at += 1  # Else
        right = node()
        splits.append(_Split(feature, left, right))
        return left + right

    node()
    return splits, leaves


def category_index(df: DataFrame, col: str, target: str, smooth: float) -> DataFrame:
    """(text, index): every text of a column in the order of its mean target,
    drawn towards the whole mean as by `smooth` more rows, then by name."""
    y = F.col(target).cast("double")
    whole = df.agg(F.avg(y)).first()[0] or 0.0
    per = df.groupBy(F.col(col).cast("string").alias("text")).agg(F.sum(y).alias("_s"), F.count(y).alias("_c"))
    mean = (F.col("_s") + F.lit(whole * smooth)) / (F.col("_c") + F.lit(smooth))
    return with_positions(per.select("text", mean.alias("_m")), [F.col("_m").asc(), F.col("text").asc()], "index").select("text", "index")


def _attributed(cells: DataFrame, trees: list[list[_Split]], features: dict[int, str], per_tree: bool):
    """({numeric feature: gain}, DataFrame (column, text, gain)). A split that
    leaves n rows of mean M on a side and N rows of mean m above gains n (M - m)^2
    there; on a text column each text of that side gets a part by its rows' own
    n_t (M_t - m)^2. `cells` are (tree, leaf, column, text, n, s), every row of
    the data once per tree and text column."""
    spark = cells.sparkSession
    one = cells.filter(F.col("column") == min(features.values())) if features else cells
    leaf = {(r["tree"], r["leaf"]): (r["n"], r["s"]) for r in one.groupBy("tree", "leaf").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}  # one row per leaf of the model
    numeric: dict[int, float] = {}
    under, sides = [], []
    for t, splits in enumerate(trees):
        gains = []
        for k, split in enumerate(splits):
            halves = [tuple(map(sum, zip((0, 0.0), *[leaf.get((t, x), (0, 0.0)) for x in half]))) for half in (split.left, split.right)]
            n, s = halves[0][0] + halves[1][0], halves[0][1] + halves[1][1]
            mean = s / n if n else 0.0
            gains.append([(c * (x / c - mean) ** 2 if c else 0.0) for c, x in halves])
            if split.feature in features:
                under += [(t, x, k, side, features[split.feature]) for side, half in enumerate((split.left, split.right)) for x in half]
                sides.append((t, k, mean))
        scale = 1.0 / total if per_tree and (total := sum(map(sum, gains))) else 1.0
        for k, split in enumerate(splits):
            gains[k] = [x * scale for x in gains[k]]
            if split.feature not in features:
                numeric[split.feature] = numeric.get(split.feature, 0.0) + sum(gains[k])
        sides = [(*x, *gains[x[1]]) if x[0] == t and len(x) == 3 else x for x in sides]
    # a row per leaf below a split, and per split: as many as the model has
    below = F.broadcast(spark.createDataFrame(under, "tree int, leaf int, split int, side int, column string"))
    split = F.broadcast(spark.createDataFrame(sides, "tree int, split int, mean double, gain0 double, gain1 double"))
    held = (cells.join(below, ["tree", "leaf", "column"]).groupBy("tree", "split", "side", "column", "text")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(split, ["tree", "split"]))
    held = cut(held.withColumn("pull", F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("mean"), 2))
               .withColumn("gain", F.when(F.col("side") == 0, F.col("gain0")).otherwise(F.col("gain1"))))
    pulls = F.broadcast(held.groupBy("tree", "split", "side").agg(F.sum("pull").alias("all")))  # two per split
    return numeric, held.join(pulls, ["tree", "split", "side"]).filter("pull > 0").groupBy("column", "text").agg(
        F.sum(F.col("gain") * F.col("pull") / F.col("all")).alias("gain"))


def tree_importance(df: DataFrame, kind: str = "rf", target: str = "lowest_price",
                    numeric: list[str] = TREE_NUMERIC, categorical: list[str] = TREE_CATEGORICAL,
                    k: int = 20, seed: int = 42, trees: int = 20, depth: int | None = None,
                    bins: int = 256, smooth: float = 5.0) -> DataFrame:
    """Top-k feature importances of a random forest (kind='rf', depth 6) or
    gradient boosted trees (kind='gbt', depth 4) predicting the target from
    numeric columns and whole-text categories: (feature, importance), a
    category's feature being its column and text.

    A text column is one feature: all its texts, numbered in the order of their
    mean target (`category_index`), so a split takes texts apart wherever the
    order is cut (at `bins` places, dealt by rows). What a split gains goes back
    to the texts on its sides (`_attributed`), from one pass over the leaves that
    all rows reach; so every text, however rare, has an importance. Numeric
    features have the gains of their splits; all sum to 1 before the cut to k.
    Rows with a null in any of the columns are left out."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    spark = df.sparkSession
    rows = df.select(*numeric, *[F.col(c).cast("string").alias(c) for c in categorical], F.col(target).cast("double").alias(target)).dropna()
    data = rows
    for c in categorical:
        index = category_index(rows, c, target, smooth).select(F.col("text").alias(c), F.col("index").alias(f"{c}__index"))
        data = data.join(index, c)
    names = [*numeric, *[f"{c}__index" for c in categorical]]
    data = cut(VectorAssembler(inputCols=names, outputCol="_features").transform(data).select("_features", *categorical, target))
    if data.isEmpty():
        return spark.createDataFrame([], "feature string, importance double")
    options = dict(featuresCol="_features", labelCol=target, seed=seed, maxBins=bins, leafCol="_leaves")
    if kind == "rf":
        model = RandomForestRegressor(numTrees=trees, maxDepth=depth or 6, **options).fit(data)
    else:
        model = GBTRegressor(maxIter=trees, maxDepth=depth or 4, **options).fit(data)
    grown = [_read_tree(t.toDebugString) for t in model.trees]
    # what each tree was grown on: the target, or what the trees before it left
    leaves = F.transform(vector_to_array("_leaves"), lambda x: x.cast("int"))
    reached = model.transform(data).withColumn("_l", leaves).select(*categorical, target, "_l")
    for t in range(len(grown)):  # a column per tree, so that none repeats the sums before it
        reached = reached.withColumn(f"_y{t}", F.col(target) if t == 0 or kind == "rf" else F.col(f"_y{t - 1}") - F.get(
            F.lit([float(p * model.treeWeights[t - 1]) for p in grown[t - 1][1]]), F.get("_l", F.lit(t - 1))))
    per_tree = F.array(*[F.struct(F.lit(t).alias("tree"), F.get("_l", F.lit(t)).alias("leaf"), F.col(f"_y{t}").alias("y"))
                         for t in range(len(grown))])
    texts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in categorical]) if categorical \
        else F.array(F.struct(F.lit("").alias("column"), F.lit("").alias("text")))
    cells = (reached.select(texts.alias("c"), F.explode(per_tree).alias("r")).select(F.explode("c").alias("c"), "r.*")
             .groupBy("tree", "leaf", "c.column", "c.text").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    cells = cut(cells)
    features = {len(numeric) + i: c for i, c in enumerate(categorical)}
    gains, by_text = _attributed(cells, [splits for splits, _ in grown], features, kind == "rf")
    by_text = cut(by_text)
    total = sum(gains.values()) + (by_text.agg(F.sum("gain")).first()[0] or 0.0)
    best = by_text.orderBy(F.desc("gain"), "column", "text").limit(k).collect()
    found = [(numeric[f], x) for f, x in gains.items()] + [(c, 0.0) for i, c in enumerate(numeric) if i not in gains]
    found += [(f"{r['column']}_{r['text']}", r["gain"]) for r in best]
    top = sorted(((f, x / total if total else 0.0) for f, x in found), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(top, "feature string, importance double")
