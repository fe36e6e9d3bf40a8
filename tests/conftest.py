import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from catalog_engine.session import get_spark
    s = get_spark("local[8]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="catalog-test-ckpt-")})
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def one(spark, expr, value, dtype="string"):
    """Evaluate a Column expression on a one-row frame with column x."""
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr.alias("out")).first()["out"]
