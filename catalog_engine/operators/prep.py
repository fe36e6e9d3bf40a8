"""Projections and filters: analysis preparation, the clean job, leaderboard
filters, top-N restriction and the drill-down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ARTIST_TITLE_SEPARATOR, UNKNOWN
from ..functions import (
    artist_from_title, clean_title, display_tokens, first_link, fixed2, label_key, num_or_zero,
    num_tracks, or_unknown, parse_int, preview, rating_display, release_year, strip,
    total_duration_min,
)
from ..schemas import CLEAN_COLUMNS
from .positions import Ranked, grams, matching_rows

NUMERIC_FIELDS = ["average_rating", "rating_count", "have", "want", "rating_coefficient",
                  "demand_coefficient", "gem_value", "num_for_sale", "lowest_price"]
CATEGORY_FIELDS = ["genre", "style", "country", "format"]
JSON_FIELDS = ["tracklist", "extraartists", "labels"]


def preprocess(df: DataFrame, with_duration: bool = True) -> DataFrame:
    """Analysis frame: numeric fields coerced (null/NaN/unparseable -> 0),
    year as nullable int (null falls back to `released`), rows with year 0 or
    null dropped, null categories -> 'Unknown', JSON fields kept as text,
    num_tracks and total_duration_min added. Absent columns get 0 /
    'Unknown' / '[]'."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    for c in NUMERIC_FIELDS:
        cols[c] = num_or_zero(c, types[c]) if c in types else F.lit(0)
    if "year" in types:
        released = F.col("released") if "released" in types else F.lit(None).cast("string")
        cols["year"] = release_year("year", released)
    for c in CATEGORY_FIELDS:
        cols[c] = F.coalesce(F.col(c), F.lit(UNKNOWN)) if c in types else F.lit(UNKNOWN)
    for c in JSON_FIELDS:
        if c not in types:
            cols[c] = F.lit("[]")
    out = df.withColumns(cols)
    if "year" in types:
        out = out.filter(F.col("year") != 0)
    out = out.withColumn("num_tracks", num_tracks("tracklist"))
    if with_duration:
        out = out.withColumn("total_duration_min", total_duration_min("tracklist"))
    return out


def clean_releases(df: DataFrame, keep=()) -> DataFrame:
    """The clean job: first video link, 'artist - title' titles, two renamed
    score columns, 18 columns (plus any `keep` columns, e.g. a batch order)."""
    return df.select(*keep,
        "id",
        clean_title("title", "artists_sort").alias("title"),
        "year", "genre", "style", "label", "country", "average_rating",
        "rating_count", "have", "want",
        F.col("rating_coefficient").alias("rating_coeff"),
        "link",
        first_link("youtube_links").alias("youtube_links"),
        F.col("demand_coefficient").alias("demand_coeff"),
        "gem_value", "lowest_price", "format",
    ).select(*CLEAN_COLUMNS, *keep)


def _js_int(v) -> int | None:
    """Lenient integer of a form value (leading digits), None when absent/0."""
    import re
    if v is None:
        return None
    m = re.match(r"\s*([+-]?\d+)", str(v))
    return int(m.group(1)) or None if m else None


def entity_key(entity: str):
    if entity == "artist":
        return artist_from_title("title")
    if entity == "label":
        return label_key("label")
    raise ValueError(f"entity must be 'artist' or 'label', not {entity!r}")


def filter_releases(df: DataFrame, entity: str = "artist", query: str = "", genre: str = "",
                    style: str = "", year_min=None, year_max=None) -> DataFrame:
    """Leaderboard filter over clean releases: inclusive year bounds (an
    unparseable row year counts as 0; a bound of 0/blank is open), exact genre
    and style tokens, and a case-insensitive substring over the title or the
    entity (artist parsed from the title, or the label text)."""
    cond = F.lit(True)
    lo, hi = _js_int(year_min), _js_int(year_max)
    row_year = parse_int("year")
    if lo is not None:
        cond = cond & (row_year >= lo)
    if hi is not None:
        cond = cond & (row_year <= hi)
    for colname, token in (("genre", genre), ("style", style)):
        if token:
            toks = F.transform(F.split(F.coalesce(F.col(colname), F.lit("")), ","), lambda x: strip(x))
            cond = cond & F.when(F.col(colname).isNull() | (F.col(colname) == ""), F.lit(False)).otherwise(
                F.array_contains(toks, token))
    q = (query or "").lower().strip()
    if q:
        title_hit = F.lower(F.coalesce(F.col("title"), F.lit(""))).contains(q)
        ent = F.lower(artist_from_title("title")) if entity == "artist" else F.lower(F.coalesce(F.col("label"), F.lit("")))
        cond = cond & (ent.contains(q) | title_hit)
    return df.filter(cond)


def text_fields(entity: str = "artist") -> dict:
    """The trigrams of what the text query of filter_releases searches, for postings.
    Those of an entity that the title holds are the title's."""
    own = F.lower(artist_from_title("title") if entity == "artist" else F.coalesce(F.col("label"), F.lit("")))
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    return {"text": F.when(title.contains(own), grams(title)).otherwise(F.concat(grams(title), grams(own)))}


def text_candidates(spark, path: str, query: str) -> DataFrame:
    """Rows of an index over `text_fields` that may hold the text query: those
    with all its trigrams. Queries of fewer than three characters have no
    trigram: all rows. filter_releases verifies."""
    q = (query or "").lower().strip()
    terms = [("text", [q[i:i + 3]]) for i in range(len(q) - 2)]
    terms = list({t[1][0]: t for t in terms}.values())
    return matching_rows(spark, path, terms) if terms else Ranked(spark, f"{path}/ranked").rows()


def restrict_to_top(df: DataFrame, col: str, top: DataFrame) -> DataFrame:
    """Rows whose `col` is in a computed top-N table. The top table is the
    output of a limit, so its size is bounded and it is broadcast."""
    return df.join(F.broadcast(top.select(col).distinct()), col, "left_semi")


def genre_contains_any(df: DataFrame, genres: list[str], col: str = "genre") -> DataFrame:
    """Rows whose raw genre text contains any of the given tokens (regex
    alternation, unescaped: substrings count; an empty token matches all)."""
    return df.filter(F.coalesce(F.col(col).rlike("|".join(genres)), F.lit(False)))


def entity_releases(df: DataFrame, entity: str, value: str, interacted: DataFrame | None = None,
                    display: bool = False) -> DataFrame:
    """Drill-down: every clean release of one artist/label with its video id
    (or 'No links' / 'Invalid link') and whether the user already opened it."""
    rows = df.filter(entity_key(entity) == F.lit(value))
    rows = rows.withColumn("preview", preview("youtube_links"))
    if interacted is not None:
        seen = interacted.select(F.col("id").alias("_seen_id")).distinct()
        rows = (rows.join(seen, rows.id == seen._seen_id, "left")
                    .withColumn("is_interacted", F.col("_seen_id").isNotNull()).drop("_seen_id"))
    else:
        rows = rows.withColumn("is_interacted", F.lit(False))
    if display:
        rows = rows.select(
            "id", "title", or_unknown("label").alias("label"),
            F.coalesce("year", F.lit("")).alias("year"),
            display_tokens("genre").alias("genre"), display_tokens("style").alias("style"),
            rating_display("rating_coeff", "rating_count").alias("rating"),
            fixed2("demand_coeff").alias("demand"), fixed2("gem_value").alias("gem"),
            F.coalesce("have", F.lit(0)).alias("have"), F.coalesce("want", F.lit(0)).alias("want"),
            "preview", "is_interacted")
    return rows


__all__ = ["preprocess", "clean_releases", "filter_releases", "restrict_to_top",
           "genre_contains_any", "entity_releases", "entity_key", "ARTIST_TITLE_SEPARATOR"]
