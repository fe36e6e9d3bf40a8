"""The stores that queries start from: a later one is made without writing those before it."""

import shutil

from pyspark.sql import functions as F

from catalog_engine.functions.nested import total_duration_min, youtube_links
from catalog_engine.operators.etl import normalise_payloads
from catalog_engine.operators.prep import preprocess
from catalog_engine.session import path_exists
from catalog_engine.sources import tables as TB

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(str, df.collect()))


def _own_copy(tmp_path):
    """Tables of another folder, so that no other test has built their stores."""
    for name in TB.SOURCE_TABLES:
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_analysis_alone_writes_no_store_before_it(spark, tmp_path):
    sf = _own_copy(tmp_path)
    made = TB.analysis_store(spark, sf)
    folder = TB._store_path(spark, sf)
    assert not path_exists(spark, f"{folder}/payloads") and not path_exists(spark, f"{folder}/releases")
    step_by_step = preprocess(normalise_payloads(TB.payload_store(spark, sf)))
    assert made.columns == step_by_step.columns
    assert _rows(made) == _rows(step_by_step)


def test_releases_alone_equal_those_of_the_saved_payloads(spark, tmp_path):
    sf = _own_copy(tmp_path)
    made = TB.release_store(spark, sf)
    assert not path_exists(spark, f"{TB._store_path(spark, sf)}/payloads")
    payloads = TB.payload_store(spark, sf)
    assert _rows(made) == _rows(normalise_payloads(payloads)) == _rows(TB.releases_from_orders(spark, sf))


def test_hosts_in_capitals_and_odd_durations(spark):
    df = spark.createDataFrame([([("https://WWW.YouTube.com/a",), ("https://youtube.com/b",), ("https://x.example",), (None,)],
                                 '[{"duration":" 1:30 "},{"duration":"none"},{"duration":""},{"title":"t"},{"duration":"-1:+5"}]')],
                               "videos array<struct<uri:string>>, tracklist string")
    got = df.select(youtube_links("videos").alias("y"), F.round(total_duration_min("tracklist") * 60).alias("s")).first()
    assert got["y"] == "https://WWW.YouTube.com/a, https://youtube.com/b"
    assert got["s"] == 90 - 60 + 5


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files_and_no_settings(spark, tmp_path):
    before, conf = _shuffle_files(spark), spark.conf.getAll
    TB.publish(spark, lambda p: spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 9).alias("k")).count()
               .orderBy("k").write.parquet(p), str(tmp_path))
    assert _shuffle_files(spark) <= before
    assert spark.conf.getAll == conf


def test_collected_lines_are_dealt_out_once(spark):
    """Customers and nations meet the orders, not the orders' collected lines."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = TB.order_facts(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (at,) = [i for i, x in enumerate(plan) if "ObjectHashAggregate" in x and "partial_" not in x]
    above = [x for i, x in enumerate(plan[:at]) if "Exchange" in x and all(depth(y) > depth(x) for y in plan[i + 1:at + 1])]
    assert above == []


def test_stores_and_ranked_tables_are_written_small(spark, tmp_path):
    import os
    from catalog_engine.operators.positions import Ranked, write_ranked
    made = TB._materialised(spark, SF_SMALL, f"small-{tmp_path.name}", lambda: spark.range(20))
    write_ranked(spark.range(20), [F.col("id").desc()], str(tmp_path / "ranked"), 2)
    files = made.inputFiles() + [f for _, _, names in os.walk(tmp_path / "ranked" / "rows") for f in names if f.startswith("part-")]
    assert len(files) > 2 and all(f.endswith(".zstd.parquet") for f in files)
    assert [r["id"] for r in Ranked(spark, str(tmp_path / "ranked")).page(2, 5).collect()] == [14, 13, 12, 11, 10]
