"""Resumable ingest: two overlapping drops with a restart equal one batch run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog_engine.operators.etl import normalise_payloads
from catalog_engine.schemas import RAW_COLUMNS
from catalog_engine.sources.files import read_payloads
from catalog_engine.streaming.ingest import ingest_stream, read_store


def payload(i, title=None, price=None):
    return {"id": i, "title": title or f"A{i} - T{i}", "year": 1990 + i % 10, "genres": ["Rock"],
            "styles": ["Indie", "Pop"], "formats": [{"name": "Vinyl"}],
            "community": {"rating": {"average": 4.0, "count": i}, "have": i, "want": 2 * i, "num_for_sale": 1},
            "videos": [{"uri": f"https://www.youtube.com/watch?v={i:011d}"}], "country": "UK",
            "labels": [{"name": f"L{i % 3}", "catno": "x"}], "artists_sort": f"A{i}",
            "lowest_price": price if price is not None else {"value": i + 0.5}, "released": "1999-01-01",
            "tracklist": [{"title": "a", "duration": "3:10"}], "extraartists": [], "images": [], "thumb": ""}


def write_drop(folder, name, items):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w") as fh:
        for it in items:
            fh.write(json.dumps(it) + "\n")
    os.rename(tmp, os.path.join(folder, name))


def test_two_drops_with_restart(spark, tmp):
    src, store, ckpt = f"{tmp}/in", f"{tmp}/store", f"{tmp}/ckpt"
    first = [payload(i) for i in range(0, 30)]
    second = [payload(i, title="replayed") for i in range(20, 50)] + [payload(7, title="dup in batch")]
    write_drop(src, "drop1.json", first)
    ingest_stream(spark, src, store, ckpt)
    assert read_store(spark, store).count() == 30
    ingest_stream(spark, src, store, ckpt)              # restart, nothing new: nothing read twice
    assert read_store(spark, store).count() == 30
    write_drop(src, "drop2.json", second)
    ingest_stream(spark, src, store, ckpt)
    out = read_store(spark, store)
    assert out.count() == 50
    titles = {r["id"]: r["title"] for r in out.collect()}
    assert titles[7] == "A7 - T7" and titles[25] == "A25 - T25" and titles[45] == "replayed"
    batch = normalise_payloads(read_payloads(spark, f"{src}/drop1.json")).unionByName(
        normalise_payloads(read_payloads(spark, f"{src}/drop2.json").filter(F.col("id") >= 30)))
    key = lambda r: tuple(r[c] for c in RAW_COLUMNS)
    assert sorted(map(key, out.collect())) == sorted(map(key, batch.collect()))


def test_payload_json_price_forms(spark, tmp):
    path = f"{tmp}/p"
    write_drop(path, "a.json", [payload(1, price=12.5), payload(2, price={"value": 3}), payload(3, price="7")])
    recs = {r["id"]: r for r in normalise_payloads(read_payloads(spark, path)).collect()}
    assert [recs[i]["lowest_price"] for i in (1, 2, 3)] == [12.5, 3.0, 7.0]
    assert json.loads(recs[1]["labels"]) == [{"name": "L1", "catno": "x"}]
    assert recs[1]["youtube_links"] == "https://www.youtube.com/watch?v=00000000001"
    assert recs[1]["year"] == "1991"
    assert recs[1]["rating_coefficient"] == pytest.approx(1 / 11 * 4.0 + 10 / 11 * 3.0)


def test_whole_members_and_nulls_are_kept(spark, tmp):
    odd = payload(1)
    odd["labels"] = [{"name": None, "catno": "c1"}, {"name": "L", "catno": None, "id": 7}]
    odd["tracklist"] = [{"position": "A1", "type_": "track", "title": "t", "duration": "1:00"}]
    odd["images"] = [{"type": "primary", "uri": "u", "width": 600}]
    odd["extraartists"] = [{"name": "n", "role": "Mix", "id": 3}]
    write_drop(f"{tmp}/q", "a.json", [odd])
    r = normalise_payloads(read_payloads(spark, f"{tmp}/q")).first()
    for c in ("labels", "tracklist", "images", "extraartists"):
        assert json.loads(r[c]) == odd[c]
    assert r["label"] == ", L"
    from catalog_engine.operators.aggregates import label_stats
    stats = label_stats(normalise_payloads(read_payloads(spark, f"{tmp}/q"))).collect()
    assert [x["label_name"] for x in stats] == ["L"]                          # a null name is dropped, not 'Unknown'


def test_malformed_lines_and_missing_dates(spark, tmp):
    src, store, ckpt = f"{tmp}/in", f"{tmp}/store", f"{tmp}/ckpt"
    undated = dict(payload(2), released=None)
    for k, items in enumerate(([payload(1), undated], [payload(3), undated])):
        write_drop(f"{src}/part{k}", "drop.json", items)
        with open(f"{src}/part{k}/drop.json", "a") as fh:
            fh.write('{"id": 9, "title": "cut o\\n{"title": "no id"}\n')
        ingest_stream(spark, src, store, ckpt, rejects=f"{tmp}/rejects")
    out = read_store(spark, store).collect()
    assert sorted(r["id"] for r in out) == [1, 2, 3] and {r["released"] for r in out if r["id"] == 2} == {""}
    assert sum(r["n_rejected"] for r in spark.read.parquet(f"{tmp}/rejects").collect()) >= 2


def test_replayed_batch_is_idempotent(spark, tmp):
    """A crash after the batch wrote its folder but before the commit: on
    restart Spark replays the batch, which rewrites only its own folder."""
    src, store, ckpt = f"{tmp}/in", f"{tmp}/store", f"{tmp}/ckpt"
    write_drop(src, "drop1.json", [payload(i) for i in range(12)])
    ingest_stream(spark, src, store, ckpt)
    before = sorted(r["id"] for r in read_store(spark, store).collect())
    commits = os.path.join(ckpt, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):             # the commit never happened
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    ingest_stream(spark, src, store, ckpt)                 # restart replays the batch
    after = sorted(r["id"] for r in read_store(spark, store).collect())
    assert after == before == list(range(12))


def test_drops_are_small_compressed_files(spark, tmp, monkeypatch):
    from catalog_engine.sources.tables import payload_store
    from catalog_engine.streaming import ingest
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(ingest, "RECORDS_PER_FILE", 500, raising=False)
    ingest.deliver_drops(spark, sf, f"{tmp}/in", "second")
    files = [f for f in os.listdir(f"{tmp}/in/second") if f.startswith("part-")]
    assert len(files) > 1 and all(f.endswith(".json.gz") for f in files)
    whole = payload_store(spark, sf).filter("released IS NULL OR released >= '1997-07-01'")
    rows = lambda df: sorted(map(repr, normalise_payloads(df).collect()))
    assert rows(read_payloads(spark, f"{tmp}/in/second")) == rows(whole)


def test_a_batch_is_parsed_into_files_that_go(spark, tmp, monkeypatch):
    from catalog_engine.streaming import ingest
    write_drop(f"{tmp}/in", "drop1.json", [payload(i) for i in range(12)] + [payload(3, title="again")])
    seen, append = [], ingest.append_to_buckets

    def watched(rows, *args):
        seen.append((rows.storageLevel.useMemory, all(f"{tmp}/ckpt/" in f for f in rows.inputFiles()), rows.count()))
        append(rows, *args)
    monkeypatch.setattr(ingest, "append_to_buckets", watched)
    ingest.ingest_stream(spark, f"{tmp}/in", f"{tmp}/store", f"{tmp}/ckpt")
    assert seen == [(False, True, 13)]
    assert os.listdir(f"{tmp}/ckpt/parsed") == []
    assert sorted(r["id"] for r in read_store(spark, f"{tmp}/store").collect()) == list(range(12))


def test_a_drop_goes_when_it_is_ingested(spark, tmp, monkeypatch):
    from catalog_engine.operators.partials import read_partials
    from catalog_engine.sources.tables import payload_store
    from catalog_engine.streaming import ingest
    there, deliver = [], ingest.deliver_drops

    def watched(spark, sf_dir, src, which):
        there.append(os.listdir(src) if os.path.exists(src) else [])
        deliver(spark, sf_dir, src, which)
    monkeypatch.setattr(ingest, "deliver_drops", watched)
    sf = "/root/testdata/sf0.001"
    ingest.ingest_drops_to_partials(spark, sf, f"{tmp}/parts")
    assert there == [[], []]
    n = read_partials(spark, f"{tmp}/parts").filter("family = 'lead_artist'").agg(F.sum("n")).first()[0]
    assert n == payload_store(spark, sf).count()
