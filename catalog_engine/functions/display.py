"""Display values of the leaderboard drill-down (2-decimal scores etc.)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import INVALID_LINK, NO_LINKS, UNKNOWN
from ._util import col, strip
from .numeric import parse_float
from .text import csv_tokens, youtube_id


def _rounded_hundredths(v: Column) -> Column:
    """Hundredths of v >= 0 by its exact binary value, ties up: 2.675 is stored
    below its tie, so 267. 200 v is the exact sum of v * 128, v * 64 and v * 8;
    their whole parts add up exactly, and the error of adding two of the
    fractions is carried along."""
    n = F.floor(v * 100)
    parts = [v * k for k in (128.0, 64.0, 8.0)]
    whole = sum((F.floor(p) for p in parts[1:]), F.floor(parts[0]))
    a, b, c = (p - F.floor(p) for p in parts)
    s = a + b
    z = s - a
    error = (a - (s - z)) + (b - z)
    above = lambda k: ((s - (2 * k + 1 - whole)) + c) + error >= 0  # noqa: E731  v is at or above (k + 1/2) / 100
    return F.when(above(n), n + 1).when(above(n - 1), n).otherwise(n - 1)


def fixed2(c) -> Column:
    """Two-decimal text of the exact binary value; falsy (null, 0, NaN) -> '0.00'."""
    v = col(c).cast("double")
    n = _rounded_hundredths(F.abs(v)).cast("long")
    text = F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), F.floor(n / 100).cast("string"), F.lit("."),
                    F.lpad((n % 100).cast("string"), 2, "0"))
    return F.when(v.isNull() | F.isnan(v) | (v == 0), F.lit("0.00")).otherwise(text)


def display_tokens(c) -> Column:
    """Comma tokens, trimmed and joined again; 'Unknown' when there is no text."""
    v = or_unknown(c)
    return F.array_join(F.transform(F.split(v, ","), lambda x: strip(x)), ", ")


def rating_display(rating_coeff, rating_count) -> Column:
    """'x.xx (n)' from the rating text/number and its vote count."""
    r = parse_float(F.col(rating_coeff).cast("string") if isinstance(rating_coeff, str) else rating_coeff)
    n = F.coalesce(col(rating_count), F.lit(0))
    return F.concat(fixed2(r), F.lit(" ("), n.cast("string"), F.lit(")"))


def preview(youtube_links_col) -> Column:
    """Video id of the first comma token, or the status 'No links' / 'Invalid link'."""
    first = F.try_element_at(csv_tokens(youtube_links_col), F.lit(1))
    vid = youtube_id(first)
    return (F.when(first.isNull(), F.lit(NO_LINKS))
            .when(vid.isNull(), F.lit(INVALID_LINK))
            .otherwise(vid))


def or_unknown(c) -> Column:
    v = col(c)
    return F.when(v.isNull() | (v == ""), F.lit(UNKNOWN)).otherwise(v)
