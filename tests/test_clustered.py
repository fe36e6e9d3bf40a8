"""The store clustered by year and style."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog_engine.operators import clustered as CL

STYLES = [f"Style {k}" for k in range(40)]


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    r = random.Random(7)
    rows = [(k, r.choice([None, 1900] + 30 * [r.randint(1950, 2025)]),
             r.choice([None, "", "Style 0"] + 7 * [", ".join(r.sample(STYLES, r.randint(1, 2)))]), r.random()) for k in range(40_000)]
    df = spark.createDataFrame(rows, "id long, year int, style string, gem_value double").repartition(8).cache()
    root = str(tmp_path_factory.mktemp("clustered"))
    CL.write_clustered(df, f"{root}/clustered", partitions=40)
    df.repartition(40).write.parquet(f"{root}/dealt")
    return df, root


def groups(path, keep):
    """(row groups that a filter must read, all row groups)."""
    found = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            cols = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            found.append(keep({c.path_in_schema: c.statistics for c in cols}))
    return sum(found), len(found)


def spans(stats, name, lo, hi):
    return stats[name].has_min_max and stats[name].min <= hi and stats[name].max >= lo


def test_row_groups_are_skipped(spark, stores):
    _, root = stores
    by_year = lambda s: spans(s, "year", 1990, 1994)
    read, every = groups(f"{root}/clustered", by_year)
    assert 0 < read <= every / 2
    assert groups(f"{root}/dealt", by_year) == (40, 40)
    h = spark.range(1).select(CL.style_hash(F.lit("Style 3"))).first()[0]
    both = lambda s: by_year(s) and s[CL.LOW].min <= h <= s[CL.HIGH].max
    assert 0 < groups(f"{root}/clustered", both)[0] <= read


@pytest.mark.parametrize("years,style", [((1990, 1994), None), (None, "Style 3"), ((1960, 2000), "Style 0"), ((1900, 1900), "Style 1"),
                                         ((2, 1), None), (None, "none"), (None, ""), (None, None)])
def test_same_rows_as_the_plain_filter(spark, stores, years, style):
    df, root = stores
    want = [tuple(r) for r in df.collect() if (years is None or r.year is not None and years[0] <= r.year <= years[1])
            and (style is None or r.style is not None and style in r.style.split(", "))]
    got = CL.clustered_rows(spark, f"{root}/clustered", years, style)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_filters_reach_the_scan(spark, stores, capsys):
    CL.clustered_rows(spark, f"{stores[1]}/clustered", (1990, 1994), "Style 3").explain("formatted")
    pushed = next(x for x in capsys.readouterr().out.split("\n") if "PushedFilters" in x)
    assert "GreaterThanOrEqual(year,1990)" in pushed and f"LessThanOrEqual({CL.LOW}," in pushed


def test_interleaved_bits(spark):
    got = spark.range(64).selectExpr("id % 8 AS a", "id DIV 8 AS b").withColumn("z", CL.interleaved(F.col("a"), F.col("b"), 3)).collect()
    assert all(r.z == sum((r.a >> k & 1) << 2 * k + 1 | (r.b >> k & 1) << 2 * k for k in range(3)) for r in got)


def test_empty_table_and_one_year(spark, tmp):
    empty = spark.createDataFrame([], "id long, year int, style string")
    CL.write_clustered(empty, f"{tmp}/empty", partitions=3)
    assert CL.clustered_rows(spark, f"{tmp}/empty", (1, 2), "x").collect() == []
    CL.write_clustered(spark.createDataFrame([(1, 1990, "x"), (1, 1990, "x"), (2, None, None)], empty.schema), f"{tmp}/one")
    assert CL.clustered_rows(spark, f"{tmp}/one", (1990, 1990)).count() == 2
