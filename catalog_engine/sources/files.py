"""File sources and sinks: release tables, id lists, payload drops, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ID_LIST, RAW_RELEASE, RELEASE_PAYLOAD, SEARCH_STATE
from ..session import checkpoint_root


def read_releases(spark: SparkSession, path: str, fmt: str = "parquet", schema=RAW_RELEASE) -> DataFrame:
    """All rows of a release table (parquet, json or csv) with an explicit
    schema; later projections prune the columns at the scan. Text formats
    are read as text and converted with try_cast, so string-valued exports
    (every value written as text) read back typed."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    r = spark.read.schema(text)
    df = r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)
    return df.select(*[(F.col(f.name) if isinstance(f.dataType, T.StringType)
                        else F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_release_ids(spark: SparkSession, path: str) -> DataFrame:
    """Id list CSV (header, column release_id, all text); see etl.clean_id_list."""
    from ..operators.etl import clean_id_list
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if "release_id" not in df.columns:
        df = spark.createDataFrame([], ID_LIST)
    return clean_id_list(df)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Release payloads stored as JSON lines; malformed lines and lines without id are left out."""
    return spark.read.schema(RELEASE_PAYLOAD).json(path).filter("id IS NOT NULL")


def number_text(c) -> Column:
    """Text of a double: the shortest digits that read back, plain from 1e-4 up
    to below 1e16, otherwise with an exponent of two digits or more."""
    v = F.col(c) if isinstance(c, str) else c
    text = F.abs(v).cast("string")  # 1.2345678E7, 5.0E-4, 12.5
    whole = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    digits = F.regexp_replace(whole, r"\.", "")
    power = F.when(text.contains("E"), F.substring_index(text, "E", -1).cast("int")).otherwise(F.lit(0))
    # only texts with an E are rebuilt; there the point follows the first digit
    n = F.length(digits)
    plain = F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)).when(
        n > power + 1, F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, n))
    ).otherwise(F.concat(digits, F.repeat(F.lit("0"), power + 1 - n), F.lit(".0")))
    scientific = F.concat(whole, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0"))
    body = F.when(~text.contains("E"), text).when((power >= -4) & (power < 16), plain).otherwise(scientific)
    sign = F.when(v.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))  # -0.0 too
    return (F.when(v.isNull(), F.lit(None).cast("string")).when(F.isnan(v), F.lit("nan"))
            .when(F.abs(v) == float("inf"), F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), F.lit("inf")))
            .otherwise(F.concat(sign, body)))


def as_records(df: DataFrame) -> DataFrame:
    """Every column as text, doubles as number_text writes them."""
    return df.select(*[(number_text(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                        else F.col(f.name).cast("string")).alias(f.name) for f in df.schema.fields])


#: Records in an exported file; a compressed file is read whole by one task.
RECORDS_PER_FILE = 200_000


def export_records(df: DataFrame, path: str, fmt: str = "json", compression: str = "gzip") -> None:
    """Export all releases as string-valued records (JSON lines, or CSV with a
    header and quotes doubled inside values), compressed unless `compression` is
    'none'."""
    w = as_records(df).write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", RECORDS_PER_FILE)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def gem_order() -> list[Column]:
    """Gem value (unparseable -> 0) descending, then id."""
    return [F.coalesce(F.col("gem_value").cast("string").try_cast("double"), F.lit(0.0)).desc(), F.col("id").asc()]


def sorted_positions(df: DataFrame) -> DataFrame:
    """The rows with their position (from 0) in that order: they are range
    partitioned and sorted, and each adds the sizes of the ranges before its
    own (one number per range reaches the driver)."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = (df.repartitionByRange(n, *gem_order()).sortWithinPartitions(*gem_order())
              .withColumns({"_part": F.spark_partition_id(),
                            "_nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    # the ranges are fixed by a checkpoint, so both reads see the same ones
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    ranked = ranked.checkpoint()
    sizes = {r["_part"]: r["count"] for r in ranked.groupBy("_part").count().collect()}
    before, starts = 0, []
    for part in range(n):
        starts.append(before)
        before += sizes.get(part, 0)
    offset = F.element_at(F.lit(starts).cast("array<bigint>"), F.col("_part") + 1)
    return ranked.withColumn("position", offset + F.col("_nth")).drop("_part", "_nth")


def rewrite_sorted(df: DataFrame, path: str, source_path: str | None = None) -> None:
    """Rewrite the table ordered by gem value (unparseable -> 0) descending,
    then id. Writes to a new path: a plan never overwrites what it reads."""
    if source_path is not None and source_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("rewrite_sorted must write to a new path, not the one it reads")
    df.orderBy(*gem_order()).write.mode("overwrite").parquet(path)


def delete_all(spark: SparkSession, path: str, schema=RAW_RELEASE) -> None:
    """Truncate a release table for a new search (an empty overwrite)."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def save_search_state(spark: SparkSession, path: str, state: dict) -> None:
    """Replace the one-row search state (key id=1)."""
    import json
    row = (1, int(state.get("last_page_fetched") or 0), json.dumps(state.get("genres") or []),
           json.dumps(state.get("styles") or []), json.dumps(state.get("formats") or []),
           state.get("year"), state.get("sort"), state.get("sort_order", "desc"),
           int(state.get("per_page") or 50), int(state.get("total_items") or 0))
    spark.createDataFrame([row], SEARCH_STATE).coalesce(1).write.mode("overwrite").parquet(path)


def load_search_state(spark: SparkSession, path: str) -> dict | None:
    import json
    from ..session import path_exists
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(SEARCH_STATE).parquet(path).filter("id = 1").take(1)
    if not rows:
        return None
    r = rows[0].asDict()
    for k in ("genres", "styles", "formats"):
        r[k] = json.loads(r[k]) if r[k] else []
    r["total_items"] = r["total_items"] or 0
    return r
