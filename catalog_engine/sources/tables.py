"""Release-shaped data derived from the star-schema test tables.

One release per order with at least one line:
orders ⋈ lineitem ⋈ part ⋈ supplier ⋈ customer ⋈ nation, grouped by order.

  id / release_id   o_orderkey / its text
  title             c_name || ' - Order ' || o_orderkey;  artists_sort = c_name
  year / released   year of o_orderdate as text / its ISO date
  genre, style      distinct p_type / p_brand, sorted, joined ', '
  format            distinct l_returnflag, sorted, joined
  label / labels    s_name joined / JSON list of {"catno", "name"}, distinct, sorted
  country           nation of the customer
  rating_count      number of lines
  average_rating    sum(round(l_discount*100)) / lines / 2.0   (0..5)
  have / want       sum(l_quantity) / floor(sum(round(l_extendedprice*100)) / 1e6)
  num_for_sale      lines with l_linestatus = 'O'
  lowest_price      min(l_extendedprice)
  tracklist         JSON list of {"duration": "<l_linenumber>:<quantity, 2 digits>",
                    "title"} of all lines but number 2
  youtube_links     video URL with the order key padded to 11 characters

Odd payloads occur by order key, so that the stores hold what real payloads do:
a null first label name (every 97th), no country (53rd), no year (41st), a
price object (7th), two videos (5th), a video elsewhere (11th); lines number 3
have a malformed duration and lines number 4 none.

The tables are first turned into release payloads (the shape the catalogue
service delivers); the release store is those payloads run through the ingest
normalisation (operators.etl), so the store is built by the same expressions that
ingest real payloads. Payloads, releases and analysis frame are each written when
a query reads them; a query that reads a later one alone has it made in one job.

Joins are declared plainly: the planner broadcasts a dimension only when its
measured size is under the broadcast threshold and shuffles otherwise, and
AQE re-plans with runtime sizes. Lines are dealt by order before the per-order
aggregate, which collects them in one list, bounded by the lines of one order.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ARTIST_TITLE_SEPARATOR, VIDEO_URL_PREFIX
from ..session import checkpoint_root, path_fingerprint, writing

STORE_VERSION = "v5"
SOURCE_TABLES = ["orders", "lineitem", "part", "supplier", "customer", "nation"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order aggregate of the lines, joined to order, customer and nation."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_returnflag", "l_linestatus")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand")
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    lines = (li.join(part, li.l_partkey == part.p_partkey)
               .join(supp, li.l_suppkey == supp.s_suppkey))
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("qty"),
                    "p_type", "p_brand", "l_returnflag", "s_name")
    # lines are dealt by order as they are: buffers of collected values would be several times as long
    per_order = lines.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("discount_pct"),
        F.sum("l_quantity").cast("long").alias("have"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("price_cents"),
        F.count_if(F.col("l_linestatus") == "O").alias("num_for_sale"),
        F.min("l_extendedprice").alias("lowest_price"),
    )

    def names(c: str):
        """The distinct non-null values of the order's lines, sorted."""
        return F.sort_array(F.array_except(F.col("items")[c], F.array(F.lit(None).cast("string"))))

    per_order = per_order.withColumns({
        "genres": names("p_type"), "styles": names("p_brand"), "format_names": names("l_returnflag"),
        "label_names": names("s_name"), "tracks": F.filter("items", lambda x: x["line"] != 2)}).drop("items")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # narrow rows meet customer and nation first: the orders' collected lists are dealt out once only, by order
    who = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                 .join(nation, cust.c_nationkey == nation.n_nationkey).select("o_orderkey", "o_orderdate", "c_name", "n_name"))
    return (per_order.join(who, per_order.id == who.o_orderkey)
                     .withColumn("average_rating", F.col("discount_pct") / F.col("n_lines") / 2.0)
                     .withColumn("want", F.floor(F.col("price_cents") / 1000000.0).cast("long"))
                     .withColumn("title", F.concat(F.col("c_name"), F.lit(ARTIST_TITLE_SEPARATOR + "Order "),
                                                   F.col("id").cast("string")))
                     .withColumn("track_json", F.concat(F.lit("["), F.array_join(F.transform("tracks", _track_json), ","), F.lit("]")))
                     .withColumn("video_url", F.concat(F.lit(VIDEO_URL_PREFIX),
                                                       F.lpad(F.col("id").cast("string"), 11, "0"))))


def _every(n: int):
    return F.col("id") % n == 0


def _label_json(name, first):
    """One label object as text; names are plain, so quoting is enough."""
    quoted = F.when(_every(97) & (name == first), F.lit("null")).otherwise(F.concat(F.lit('"'), name, F.lit('"')))
    return F.concat(F.lit('{"name":'), quoted, F.lit(',"catno":"C'), F.col("id").cast("string"), F.lit('"}'))


def _track_json(t):
    """One track object as text; line 3 has a malformed duration, line 4 none."""
    duration = F.when(t["line"] == 3, F.lit("none")).when(t["line"] != 4, F.concat(
        t["line"].cast("string"), F.lit(":"), F.lpad(t["qty"].cast("string"), 2, "0")))
    return F.concat(F.coalesce(F.concat(F.lit('{"duration":"'), duration, F.lit('",')), F.lit("{")),
                    F.lit('"title":"T'), t["line"].cast("string"), F.lit('"}'))


def releases_from_orders(spark: SparkSession, sf_dir: str, payloads: DataFrame | None = None) -> DataFrame:
    """The raw release table (27 columns): the payloads run through the id-list
    ingest normalisation; the saved ones if there are any, otherwise as they are
    made from the tables, without a copy on the way."""
    from ..operators.etl import normalise_payloads
    if payloads is None:
        payloads = _stored(spark, sf_dir, "payloads")
    return normalise_payloads(payloads if payloads is not None else payloads_from_tables(spark, sf_dir))


def payloads_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release payloads (RELEASE_PAYLOAD shape) as the catalogue service would
    deliver them; label objects carry every supplier of the order."""
    f = order_facts(spark, sf_dir)
    return f.select(
        F.col("id"), F.col("title"),
        F.when(~_every(41), F.year("o_orderdate").cast("string")).alias("year"),
        F.col("genres"), F.col("styles"),
        F.transform("format_names", lambda n: F.struct(n.alias("name"))).alias("formats"),
        F.struct(
            F.struct(F.col("average_rating").alias("average"), F.col("n_lines").alias("count")).alias("rating"),
            F.col("have"), F.col("want"), F.col("num_for_sale"),
        ).alias("community"),
        F.when(_every(11), F.array(F.struct(F.concat(F.lit("https://videos.example/"), F.col("id").cast("string")).alias("uri"))))
         .when(_every(5), F.array(F.struct(F.col("video_url").alias("uri")),
                                  F.struct(F.concat(F.col("video_url"), F.lit("&t=1")).alias("uri"))))
         .otherwise(F.array(F.struct(F.col("video_url").alias("uri")))).alias("videos"),
        F.when(~_every(53), F.col("n_name")).alias("country"),
        F.parse_json(F.concat(F.lit("["), F.array_join(F.transform(
            "label_names", lambda n: _label_json(n, F.col("label_names")[0])), ","), F.lit("]"))).alias("labels"),
        F.col("c_name").alias("artists_sort"),
        F.parse_json(F.when(_every(7), F.concat(F.lit('{"value":'), F.col("lowest_price").cast("string"), F.lit("}")))
                     .otherwise(F.col("lowest_price").cast("string"))).alias("lowest_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("released"),
        F.parse_json("track_json").alias("tracklist"),
        F.parse_json(F.lit("[]")).alias("extraartists"),
        F.parse_json(F.lit("[]")).alias("images"),
        F.lit("").alias("thumb"),
    )


def search_hits(spark: SparkSession, sf_dir: str, payloads: DataFrame | None = None,
                rebuild: bool = False) -> DataFrame:
    """Saved search results: one hit per order (orders without lines
    included, with empty token lists): id, title, year, genre[], style[],
    format[]. Written once, like the payloads."""
    if payloads is None:
        return _materialised(spark, sf_dir, "search_hits",
                             lambda: _search_hits(spark, sf_dir, payload_store(spark, sf_dir)), rebuild)
    return _search_hits(spark, sf_dir, payloads)


def _search_hits(spark: SparkSession, sf_dir: str, payloads: DataFrame) -> DataFrame:
    f = payloads.select("id", "genres", "styles", F.transform("formats", lambda x: x["name"]).alias("format_names"))
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    o = orders.join(cust, orders.o_custkey == cust.c_custkey)
    empty = F.array().cast("array<string>")
    return o.join(f, o.o_orderkey == f.id, "left").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.col("c_name"), F.lit(ARTIST_TITLE_SEPARATOR + "Order "),
                 F.col("o_orderkey").cast("string")).alias("title"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.coalesce("genres", empty).alias("genre"),
        F.coalesce("styles", empty).alias("style"),
        F.coalesce("format_names", empty).alias("format"),
    )


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id list (column release_id, text) of every order: the input of the
    id-list ingest job."""
    return read_table(spark, sf_dir, "orders", "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("release_id"))


def interacted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids the user has opened: distinct event users stand in for them."""
    return read_table(spark, sf_dir, "events", "user_id").select(F.col("user_id").alias("id")).distinct()


_CODE_FILES = ["sources/tables.py", "operators/positions.py", "operators/clustered.py", "operators/prep.py", "operators/etl.py", "functions/scores.py",
               "functions/numeric.py", "functions/nested.py", "functions/text.py", "schemas.py"]


def _code_hash() -> str:
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for f in _CODE_FILES:
        with open(os.path.join(root, f), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


def _store_path(spark: SparkSession, sf_dir: str) -> str:
    prints = "|".join(path_fingerprint(spark, table_path(sf_dir, t)) for t in SOURCE_TABLES)
    key = hashlib.sha1(f"{STORE_VERSION}|{_code_hash()}|{prints}".encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/catalog_store/{key}"


_BUILD_LOCK = threading.RLock()


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that the pointer of `path` names, if there is one."""
    from ..session import hadoop_path
    fs, pointer = hadoop_path(spark, f"{path}/CURRENT")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{path}/{name}" if name else None


def publish(spark: SparkSession, write, path: str, replace: bool = False) -> str:
    """Run `write(folder)` into a new version folder under `path`, then point
    `path`/CURRENT to it; returns the folder that holds. The pointer is made by
    exclusive creation, so of two first writers one wins and the other's
    version goes; with `replace` it is overwritten, and the versions before
    stay for those who still read them."""
    import uuid
    from ..session import hadoop_path
    name = f"v-{uuid.uuid4().hex}"
    with writing(spark):
        write(f"{path}/{name}")
    fs, pointer = hadoop_path(spark, f"{path}/CURRENT")
    try:
        out = fs.create(pointer, replace)
    except Exception:  # Py4JJavaError: the file is there already
        winner = current_version(spark, path)
        if winner is None:
            raise
        own_fs, own = hadoop_path(spark, f"{path}/{name}")
        own_fs.delete(own, True)
        return winner
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    return f"{path}/{name}"


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """A table that was written before, if it was."""
    found = current_version(spark, f"{_store_path(spark, sf_dir)}/{name}")
    return None if found is None else spark.read.parquet(found)


def _materialised(spark: SparkSession, sf_dir: str, name: str, build, rebuild: bool = False) -> DataFrame:
    """Write `build()` once under the shared checkpoint folder and read it back
    (callers in several threads of one driver build it once; a failed or
    concurrent build never leaves a partial table behind)."""
    path = f"{_store_path(spark, sf_dir)}/{name}"
    with _BUILD_LOCK:
        found = None if rebuild else current_version(spark, path)
        if found is None:
            found = publish(spark, lambda p: build().write.option("compression", "zstd").parquet(p), path, replace=rebuild)
    return spark.read.parquet(found)


def id_list_csv(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Path of an id-list CSV (header release_id) holding every order key:
    the input file of the id-list ingest job, written once."""
    path = f"{_store_path(spark, sf_dir)}/id_list_csv"
    with _BUILD_LOCK:
        found = None if rebuild else current_version(spark, path)
        if found is None:
            found = publish(spark, lambda p: order_ids(spark, sf_dir).write.option("header", True).csv(p), path,
                            replace=rebuild)
    return found


def release_store(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The release table, written once to the shared checkpoint folder and
    read back, so every query starts from a short lineage. A rebuild is
    triggered by any change of the source tables (size, mtime), of the code
    that builds it, or of STORE_VERSION."""
    return _materialised(spark, sf_dir, "releases", lambda: releases_from_orders(spark, sf_dir), rebuild)


def payload_store(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """Saved release payloads (the input of the ingest jobs)."""
    return _materialised(spark, sf_dir, "payloads", lambda: payloads_from_tables(spark, sf_dir), rebuild)


def analysis_store(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The prepared analysis frame (preprocess of the release store), with
    num_tracks and total_duration_min computed once. Where the release store was
    not written yet, its rows go into the frame without being written first."""
    from ..operators.prep import preprocess

    def build() -> DataFrame:
        stored = _stored(spark, sf_dir, "releases")
        return preprocess(stored if stored is not None else releases_from_orders(spark, sf_dir))
    return _materialised(spark, sf_dir, "analysis", build, rebuild)


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder that `write(folder)` filled, once per state of the test tables
    and of the code that builds them."""
    path = f"{_store_path(spark, sf_dir)}/{name}"
    with _BUILD_LOCK:
        return current_version(spark, path) or publish(spark, write, path)
