"""Lenient numeric coercions."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col


def num_or_zero(c, dtype: T.DataType | None = None) -> Column:
    """Number or 0: unparseable text, null and NaN give 0 ('1e3' -> 1000,
    ' 5 ' -> 5). Numeric input keeps its type; text becomes double."""
    c = col(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(c, F.lit(0).cast(dtype))
    v = c if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)) else c.try_cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v)


def release_year(year, released) -> Column:
    """Year as nullable int: null year falls back to the first 4 characters of
    `released` ('' and 'Unknown' are not null, so they do not fall back);
    non-integral values give null."""
    text = F.coalesce(col(year).cast("string"), F.substring(col(released), 1, 4))
    d = text.try_cast("double")
    integral = d.isNotNull() & ~F.isnan(d) & (d == F.floor(d))
    return F.when(integral, d.try_cast("int"))


def parse_int(c) -> Column:
    """Leading integer of a text, 0 when there is none (lenient integer parse)."""
    digits = F.regexp_extract(col(c).cast("string"), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def parse_float(c) -> Column:
    """Leading decimal number of a text, 0 when there is none."""
    num = F.regexp_extract(
        col(c).cast("string"), r"^\s*([+-]?(?:Infinity|\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?))", 1)
    v = F.nullif(num, F.lit("")).try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (v == 0), F.lit(0.0)).otherwise(v)


def as_number(c, dtype: T.DataType) -> Column:
    """A numeric column as is (NaN/null -> 0), a text column through parse_float."""
    if isinstance(dtype, T.StringType):
        return parse_float(c)
    return num_or_zero(c, dtype).cast("double")
