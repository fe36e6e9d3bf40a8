"""Release scores (Column expressions, no UDF)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RATING_PRIOR_MEAN, RATING_PRIOR_VOTES
from ._util import col


def bayesian_rating(avg, n, C: float = RATING_PRIOR_MEAN, m: int = RATING_PRIOR_VOTES) -> Column:
    """Weighted rating: C when there are no votes, else v/(v+m)*R + m/(v+m)*C."""
    R, v = col(avg), col(n)
    weighted = F.try_divide(v, v + F.lit(m)) * R + F.try_divide(F.lit(m), v + F.lit(m)) * F.lit(C)
    return F.when(v == 0, F.lit(float(C))).otherwise(weighted)


def demand(have, want) -> Column:
    """want/(have+1) with both clamped at 0; 0 when both are 0."""
    h = F.greatest(col(have), F.lit(0))
    w = F.greatest(col(want), F.lit(0))
    return F.when((h + w) == 0, F.lit(0.0)).otherwise(F.try_divide(w, h + F.lit(1)))


def gem_value(rating_coefficient, demand_coefficient) -> Column:
    return col(rating_coefficient) * col(demand_coefficient)
