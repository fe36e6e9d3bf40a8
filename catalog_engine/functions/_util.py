from pyspark.sql import Column
from pyspark.sql import functions as F


# Unicode white space (the `U` flag), and the four separators that it leaves out.
SPACE_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing white space of any script (Spark's trim removes spaces only)."""
    return F.regexp_replace(col(c), SPACE_ENDS, "")


def _scaled_round(c: Column, digits: int) -> Column:
    m = float(10 ** digits)
    return F.round(c * F.lit(m), 0) / F.lit(m)


def round_to(c, digits: int) -> Column:
    """Round to `digits` decimals in two steps, first to digits + 3 (which
    absorbs last-bit noise from summation order), then to digits. Each step
    is round(x * 10^d) / 10^d with the scaled value rounded half away from
    zero: plain IEEE operations, so any engine computing the same expression
    gets the same double (Spark's round(x, d) rounds the shortest decimal
    text of x instead, which differs at ties)."""
    return _scaled_round(_scaled_round(col(c), digits + 3), digits)
