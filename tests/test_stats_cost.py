"""What a row costs in the moment matrix."""

import numpy as np
from catalog_engine.operators import stats as ST


def test_moments_are_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(ST.F, "covar_pop", None)
    x = np.random.default_rng(5).normal(size=(200, 3)) * [1, 5, 0] + [1e9, -3, 7]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0)], "a double, b double, c double")
    n, mean, S = ST.moments(df, ["a", "b", "c"])
    centred = x - x.mean(axis=0)
    assert n == 200 and np.allclose(mean, x.mean(axis=0))
    assert np.allclose(S, centred.T @ centred, rtol=1e-7, atol=1e-4)
