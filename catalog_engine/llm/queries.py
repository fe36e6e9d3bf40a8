"""The registered queries of this package: each applies one operator with
production parameters to its whole table; digests come from the operators' real
outputs. ORACLES holds DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, hadoop_path
from .centroids import DIMS, K, ROUNDS, SCALE, SEED, centroid_clustering
from .chat import format_chats
from .common import INT64_MAX, cut, read_table
from .fingerprints import edited_fingerprints
from .licences import find_licences
from .line_dedup import line_dedup
from .mixing import mix
from .near_dedup import near_dedup
from .periodic import periodic_runs, with_repeated_tails
from .piece_bpe import encode_texts
from .repetition import MAX_COVERED, MAX_LONGEST, MIN_REPEAT, MIN_WORDS, repetition_rules
from .secrets import STRONG, find_secrets
from .secrets_sql import SECRETS_SQL
from .substring_dedup import substring_dedup
from .warc import read_archives, write_archives

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives lie in the shared folder until they have been read."""
    path = f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(read_table(spark, sf_dir, "pages"), path)
    try:
        return cut(read_archives(spark, path).filter("problem is null").select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    finally:
        fs, folder = hadoop_path(spark, path)
        fs.delete(folder, True)


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(documents(spark, sf_dir), PIECE_MODEL)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(documents(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).select("doc_id", "class_id", F.col("first").alias("kept"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir), every_repeat=True).select(
        "doc_id", "n_lines", "n_dropped", "dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(documents(spark, sf_dir)).drop("repeats", "longest_repeat")


def op10_edited_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clustering(read_table(spark, sf_dir, "embeddings"))
    of = lambda kind, values: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    return found.rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance",
        of("long", [min(x, INT64_MAX) for x in found.inertia]).alias("cluster_inertia"),
        F.lit(min(sum(found.inertia), INT64_MAX)).cast("long").alias("inertia"), of("string", digests).alias("centroid_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_repeated_tails(documents(spark, sf_dir)))
    best = F.expr("""get(array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
        WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1
        WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END), 0)""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["kind"].isin(STRONG))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, STRONG),
                       F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_chat": op2_chat,
    "op3_warc": op3_warc,
    "op4_piece_bpe": op4_piece_bpe,
    "op5_mix": op5_mix,
    "op6_licences": op6_licences,
    "op7_near_dedup": op7_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_repetition_rules": op9_repetition_rules,
    "op10_edited_fingerprints": op10_edited_fingerprints,
    "op11_centroids": op11_centroids,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_secrets": op13_secrets,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _windows(n: int) -> str:
    return f"""SELECT r, i, array_to_string(w[i:i + {n - 1}], ' ') AS k FROM d, unnest(range(1, len(w) - {n - 2})) t(i)"""


def _covered(name: str, n: int) -> str:
    """Words per document in windows of n words that occur twice or more in it."""
    return f"""{name}_w AS ({_windows(n)}),
{name} AS (
  SELECT r, count(DISTINCT i + j) AS n FROM {name}_w JOIN (SELECT r, k FROM {name}_w GROUP BY r, k HAVING count(*) > 1)
  USING (r, k), unnest(range({n})) t(j) GROUP BY r)"""


def _clustering_sql(dims: int = DIMS, k: int = K, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE) -> str:
    """Every round as two tables: a<i> assigns, c<i + 1> moves the centroids."""
    tables = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
              f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('{seed}:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        tables.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, c, far FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY far, c) AS n FROM (
      SELECT v.r, v.vec_id, v.v, k.c, CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.v[i] - k.v[i]) * (v.v[i] - k.v[i])))
        AS BIGINT) AS far FROM v, c{i} k)) WHERE n = 1)""")
        if i < rounds:
            tables.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, unnest(range(1, {dims + 1})) t(i) GROUP BY c, i) GROUP BY c
  UNION ALL SELECT c, v FROM c{i} WHERE c NOT IN (SELECT c FROM a{i}))""")
    last = rounds
    return f"""WITH {", ".join(tables)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, far AS distance, CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(far) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (c)"""


ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT x.r, d.doc_id, x.i, x.k FROM ({_windows(13)}) x JOIN d ON d.r = x.r),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (
  SELECT r, list(p) AS ps, count(*) AS n
  FROM (SELECT DISTINCT r, i + j AS p FROM win JOIN low USING (k), unnest(range(13)) t(j) WHERE m < doc_id) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)""",
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS top, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS bits FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(
    list_transform(range(5), lambda b: CAST(substr(bits, i * 5 + b + 1, 1) AS INTEGER) * (16 >> b))) AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM q""",
    "op9_repetition_rules": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
{_covered("three", 3)},
{_covered("spanned", MIN_REPEAT)},
{_covered("much", MAX_LONGEST + 1)},
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    CAST(coalesce(three.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(spanned.n, 0) AS BIGINT) AS covered_words,
    coalesce(much.n, 0) AS too_long
  FROM d LEFT JOIN three USING (r) LEFT JOIN spanned USING (r) LEFT JOIN much USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  n_repeat_words, covered_words, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND covered_words <= {MAX_COVERED} * n_words
    AND too_long = 0 AS kept
FROM base""",
    "op11_centroids": _clustering_sql(),
    "op13_secrets": SECRETS_SQL,
}
