"""A store clustered by year and style, so that filters on either skip row groups.

Rows are sorted by the interleaved bits of two numbers: the year, spread over
the range of years, and the least hash of the row's style tokens. Rows that are
close in both lie together, so a row group spans few years and few hashes, and
Parquet's minima and maxima let a reader pass over the others. A row has several
styles; it also holds the least and the greatest hash of its tokens, between
which the hash of every one of them lies. That condition reaches the scan; the
tokens themselves are compared after it.

Defined cases: rows without a year or style are kept, sorted first; a filter
leaves them out. A year or style that a third of all rows share is cut by id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import list_tokens

#: Bits of each of the two numbers.
BITS = 10
LOW, HIGH = "_style_low", "_style_high"


def style_hash(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(1 << BITS))


def interleaved(a: Column, b: Column, bits: int = BITS) -> Column:
    """The bits of two numbers in turn, each of a's above the same of b's."""
    pairs = [F.shiftleft(a.bitwiseAND(F.lit(1 << k)), k + 1).bitwiseOR(F.shiftleft(b.bitwiseAND(F.lit(1 << k)), k))
             for k in range(bits)]
    return reduce(Column.bitwiseOR, pairs)


def write_clustered(df: DataFrame, path: str, partitions: int | None = None, group_bytes: int | None = None) -> None:
    """Writes df (with id, int year and style) to a new path."""
    n = partitions or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lo, hi = df.agg(F.min("year"), F.max("year")).first()
    spread = F.lit(0) if lo is None or lo == hi else F.floor((F.col("year") - lo) * ((1 << BITS) - 1) / (hi - lo))
    hashes = F.transform(list_tokens("style"), style_hash)
    rows = df.withColumns({LOW: F.array_min(hashes), HIGH: F.array_max(hashes)})
    rows = rows.withColumn("_key", interleaved(F.coalesce(spread, F.lit(0)).cast("long"),
                                               F.coalesce(LOW, F.lit(0)).cast("long")))
    out = rows.repartitionByRange(n, "_key", "id").sortWithinPartitions("_key", "id").drop("_key").write
    (out.option("parquet.block.size", group_bytes) if group_bytes else out).parquet(path)


def clustered_rows(spark: SparkSession, path: str, years: tuple[int, int] | None = None,
                   style: str | None = None) -> DataFrame:
    """Rows of a clustered store in a range of years (inclusive) that hold a style."""
    rows = spark.read.parquet(path)
    if years is not None:
        rows = rows.filter(F.col("year").between(*years))
    if style is not None:
        h = style_hash(F.lit(style))
        rows = rows.filter((F.col(LOW) <= h) & (F.col(HIGH) >= h) & F.array_contains(list_tokens("style"), style))
    return rows.drop(LOW, HIGH)
