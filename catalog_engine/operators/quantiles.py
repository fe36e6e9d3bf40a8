"""Exact quantiles at any cardinality by distributed rank selection.

No group's values are gathered or kept as a map. Every group starts with the
bracket from its least to its greatest value; a pass counts the values of each
open bracket in `buckets` equal ranges, with the least and greatest value of
each (partial sums per task), and the range that holds the wanted rank is the
next bracket. A bracket whose least value equals its greatest one is the answer.
As the ends of a bracket have ranges of their own, every pass narrows it; even
passes cut the values evenly, odd ones their logarithms, so neither evenly nor
exponentially spread values need more than a few, and columns with few values
need one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

BUCKETS = 1024


def _bucket(buckets: int, steep: bool) -> Column:
    """Range of x in [lo, hi]: the ends alone, equal steps between them, of the
    values or (steep) of their logarithms on either side of zero. Halved, so that
    no difference of doubles overflows; infinite ends leave one step."""
    def scale(v: Column) -> Column:  # never falls where v rises
        return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 746)) if steep else v / 2

    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    step = F.try_divide(scale(x) - scale(lo), scale(hi) - scale(lo)) * (buckets - 2)
    inner = F.when(step.isNull() | F.isnan(step), 0).otherwise(F.least(F.floor(step), F.lit(buckets - 3)))
    return F.when(x == lo, 0).when(x == hi, buckets - 1).otherwise(inner + 1).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None,
                    buckets: int = BUCKETS) -> DataFrame:
    """(group, n, quantiles): for each group (the whole input without one, and
    then always one row) the number of values and the quantiles by linear
    interpolation between order statistics. Null and NaN values and null groups
    are left out; a group without values has no row, an empty input n = 0 and
    null quantiles."""
    if buckets < 4:
        raise ValueError("a bracket needs four ranges")
    rows = df.select((F.col(group) if group else F.lit(0)).alias("g"), F.col(value).cast("double").alias("x")).filter(
        F.col("g").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))
    spans = cut(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = spans.select("g", "lo", "hi", F.lit(0).cast("long").alias("before"), F.explode(F.array_distinct(
        F.array(*[f(a) for a in at for f in (F.floor, F.ceil)]))).alias("k"))
    known = ranks.filter("lo = hi").select("g", "k", F.col("lo").alias("x"))
    wanted = cut(ranks.filter("lo < hi"))
    turn = 0
    while not wanted.isEmpty():
        brackets = wanted.select("g", "lo", "hi", "before").distinct()
        counted = (rows.join(brackets, "g").filter("x BETWEEN lo AND hi").withColumn("bucket", _bucket(buckets, turn % 2 == 1))
                   .groupBy("g", "before", "bucket").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("a"), F.max("x").alias("b")))
        upto = F.sum("c").over(Window.partitionBy("g", "before").orderBy("bucket"))  # at most `buckets` rows
        ranges = counted.withColumn("start", F.col("before") + upto - F.col("c"))
        found = cut(wanted.select("g", "before", "k").join(ranges, ["g", "before"]).filter("start <= k AND k < start + c")
                    .select("g", "k", F.col("a").alias("lo"), F.col("b").alias("hi"), F.col("start").alias("before")))
        known = known.unionAll(found.filter("lo = hi").select("g", "k", F.col("lo").alias("x")))
        wanted, turn = found.filter("lo < hi"), turn + 1
    # two order statistics per quantile and group
    values = known.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("values"))

    def quantile(a: Column) -> Column:
        low, high = (F.element_at("values", f(a)) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise((F.ceil(a) - a) * low + (a - F.floor(a)) * high)

    out = spans.join(values, "g").select("g", "n", F.array(*map(quantile, at)).alias("quantiles"))
    if group:
        return out.withColumnRenamed("g", group)
    one = df.sparkSession.range(1).select(F.lit(0).alias("g"))
    return one.join(out, "g", "left").select(F.coalesce("n", F.lit(0)).alias("n"), "quantiles")


def exact_median(df: DataFrame, value: str) -> float | None:
    """The median of a column; None without values."""
    found = exact_quantiles(df, value, [0.5]).first()["quantiles"]
    return found[0] if found else None
