"""File sources and sinks."""

import os

from pyspark.sql import functions as F

from catalog_engine.schemas import RAW_COLUMNS, RAW_RELEASE, SEARCH_STATE
from catalog_engine.sources import files as FS
from catalog_engine.sources.tables import release_store
from tests.conftest import SF_SMALL


def test_read_release_ids_csv(spark, tmp):
    p = os.path.join(tmp, "ids.csv")
    with open(p, "w") as fh:
        fh.write("release_id,note\n 12 ,a\nabc,b\n,c\n12,d\n7,e\n")
    assert [r["release_id"] for r in FS.read_release_ids(spark, p).collect()] == ["12", "12", "7"]


def test_export_and_read_back(spark, tmp):
    store = release_store(spark, SF_SMALL)
    FS.export_records(store, f"{tmp}/json", "json")
    FS.export_records(store, f"{tmp}/csv", "csv")
    j = spark.read.json(f"{tmp}/json")
    c = spark.read.option("header", True).csv(f"{tmp}/csv")
    assert j.count() == c.count() == store.count()
    assert dict(j.dtypes)["gem_value"] == "string"
    back = FS.read_releases(spark, f"{tmp}/json", "json")
    a = sorted((r["id"], r["gem_value"], r["labels"]) for r in back.collect())
    b = sorted((r["id"], r["gem_value"], r["labels"]) for r in store.collect())
    assert a == b


def test_rewrite_sorted_and_truncate(spark, tmp):
    store = release_store(spark, SF_SMALL).select(*RAW_COLUMNS)
    FS.rewrite_sorted(store, f"{tmp}/sorted")
    got = spark.read.parquet(f"{tmp}/sorted").select("id", "gem_value").collect()
    assert len(got) == store.count()
    # files keep the global order: part files are ranges of the sort
    keys = [(-r["gem_value"], r["id"]) for r in got]
    assert keys == sorted(keys)
    try:
        FS.rewrite_sorted(store, f"{tmp}/sorted", source_path=f"{tmp}/sorted/")
        raise AssertionError("must refuse to overwrite its input")
    except ValueError:
        pass
    FS.delete_all(spark, f"{tmp}/sorted")
    assert spark.read.schema(RAW_RELEASE).parquet(f"{tmp}/sorted").count() == 0


def test_search_state_roundtrip(spark, tmp):
    path = f"{tmp}/state"
    assert FS.load_search_state(spark, path) is None
    FS.save_search_state(spark, path, dict(last_page_fetched=3, genres=["Rock"], styles=[], formats=["Vinyl"],
                                           year="1990-2000", sort="year", sort_order="asc", per_page=50,
                                           total_items=1234))
    FS.save_search_state(spark, path, dict(last_page_fetched=4, genres=["Rock"], styles=[], formats=["Vinyl"],
                                           year="1990-2000", sort="year", sort_order="asc", per_page=50,
                                           total_items=1234))
    st = FS.load_search_state(spark, path)
    assert st["last_page_fetched"] == 4 and st["genres"] == ["Rock"] and st["total_items"] == 1234
    assert spark.read.schema(SEARCH_STATE).parquet(path).count() == 1


def test_write_csv(spark, tmp):
    df = spark.range(5).select(F.col("id"), (F.col("id") * 2).alias("x"))
    FS.write_csv(df, f"{tmp}/out")
    assert spark.read.option("header", True).csv(f"{tmp}/out").count() == 5


def test_exports_are_compressed_files_of_bounded_size(spark, tmp, monkeypatch):
    import os
    monkeypatch.setattr(FS, "RECORDS_PER_FILE", 100)
    store = release_store(spark, SF_SMALL).select("id", "title", "labels").coalesce(1)
    want = sorted(map(tuple, FS.as_records(store).collect()))
    for fmt in ("json", "csv"):
        FS.export_records(store, f"{tmp}/{fmt}", fmt)
        parts = [f for f in os.listdir(f"{tmp}/{fmt}") if f.startswith("part-")]
        assert len(parts) == -(-len(want) // 100) and all(f.endswith(".gz") for f in parts)
        reader = spark.read.schema("id string, title string, labels string")
        back = reader.json(f"{tmp}/{fmt}") if fmt == "json" else reader.option("header", True).option("escape", '"').csv(f"{tmp}/{fmt}")
        assert sorted(map(tuple, back.collect())) == want
