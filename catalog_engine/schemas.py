"""Schemas of the records the engine reads and writes."""

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Stored release, as written by both ingest jobs (27 columns).
RAW_RELEASE = _struct(
    ("id", L), ("release_id", S), ("title", S), ("year", S), ("genre", S),
    ("style", S), ("format", S), ("label", S), ("country", S),
    ("average_rating", D), ("rating_count", L), ("have", L), ("want", L),
    ("rating_coefficient", D), ("link", S), ("youtube_links", S),
    ("demand_coefficient", D), ("gem_value", D), ("artists_sort", S),
    ("labels", S), ("num_for_sale", L), ("lowest_price", D), ("released", S),
    ("tracklist", S), ("extraartists", S), ("images", S), ("thumb", S),
)
RAW_COLUMNS = [f.name for f in RAW_RELEASE.fields]

# Cleaned release (18 columns): short score names, first video link only.
CLEAN_RELEASE = _struct(
    ("id", L), ("title", S), ("year", S), ("genre", S), ("style", S),
    ("label", S), ("country", S), ("average_rating", D), ("rating_count", L),
    ("have", L), ("want", L), ("rating_coeff", D), ("link", S),
    ("youtube_links", S), ("demand_coeff", D), ("gem_value", D),
    ("lowest_price", D), ("format", S),
)
CLEAN_COLUMNS = [f.name for f in CLEAN_RELEASE.fields]

# Release payload as delivered by the catalogue service. lowest_price may be a
# number or an object {"value": n}; it is read as VARIANT and branched on type.
# The four lists that are stored whole are VARIANT too: every member of their
# objects is kept, and a JSON null stays one.
RELEASE_PAYLOAD = T.StructType([
    T.StructField("id", L), T.StructField("title", S), T.StructField("year", S),
    T.StructField("genres", T.ArrayType(S)), T.StructField("styles", T.ArrayType(S)),
    T.StructField("formats", T.ArrayType(_struct(("name", S)))),
    T.StructField("community", T.StructType([
        T.StructField("rating", _struct(("average", D), ("count", L))),
        T.StructField("have", L), T.StructField("want", L),
        T.StructField("num_for_sale", L),
    ])),
    T.StructField("videos", T.ArrayType(_struct(("uri", S)))),
    T.StructField("country", S),
    T.StructField("labels", T.VariantType()),
    T.StructField("artists_sort", S),
    T.StructField("lowest_price", T.VariantType()),
    T.StructField("released", S),
    T.StructField("tracklist", T.VariantType()),
    T.StructField("extraartists", T.VariantType()),
    T.StructField("images", T.VariantType()),
    T.StructField("thumb", S),
])

# One search hit (the search job takes these fields from the hit, the rest
# from the payload).
SEARCH_RESULT = T.StructType([
    T.StructField("id", L), T.StructField("title", S), T.StructField("year", S),
    T.StructField("genre", T.ArrayType(S)), T.StructField("style", T.ArrayType(S)),
    T.StructField("format", T.ArrayType(S)),
])

# Progress of a paged search, one row keyed by id=1.
SEARCH_STATE = _struct(
    ("id", I), ("last_page_fetched", I), ("genres", S), ("styles", S),
    ("formats", S), ("year", S), ("sort", S), ("sort_order", S),
    ("per_page", I), ("total_items", I),
)

ID_LIST = _struct(("release_id", S))
INTERACTED_IDS = _struct(("id", L))
