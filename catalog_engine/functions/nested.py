"""Arrays, JSON text and payload fields.

JSON text columns (tracklist, labels, ...) are parsed into VARIANT, so one
malformed member only affects that member, and a JSON null can be told from a
missing key.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_LINK_BASE, LIST_SEPARATOR, UNKNOWN, VIDEO_HOST
from ._util import col

DURATION_RE = r"^\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*$"
_NUMBER_SCHEMA_RE = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def json_list(c) -> Column:
    """JSON text -> array<variant>; bad text, null or a non-array -> []."""
    arr = F.try_variant_get(F.try_parse_json(col(c)), "$", "array<variant>")
    return F.coalesce(arr, F.array().cast("array<variant>"))


def num_tracks(c) -> Column:
    """Number of members of a JSON array text; anything else -> 0."""
    return F.size(json_list(c))


def _seconds(duration: Column) -> Column:
    """Seconds of 'mm:ss'; null of any other text, which no cast meets."""
    mins = F.regexp_extract(duration, DURATION_RE, 1).try_cast("double")
    secs = F.regexp_extract(duration, DURATION_RE, 2).try_cast("double")
    return F.when(duration.rlike(DURATION_RE), mins * 60 + secs)


def total_duration_min(c) -> Column:
    """Sum of 'mm:ss' track durations in minutes; a duration that is not two
    integers separated by ':' is skipped; a missing one counts as 0:00."""
    tracks = F.try_variant_get(F.try_parse_json(col(c)), "$", "array<struct<duration:string>>")
    secs = F.aggregate(F.coalesce(tracks["duration"], F.array().cast("array<string>")), F.lit(0.0),
                       lambda acc, d: acc + F.coalesce(_seconds(d), F.lit(0.0)))
    return secs / 60.0


def label_name(e: Column) -> Column:
    """Name of one exploded label member: missing member, non-object or missing
    key -> 'Unknown'; an explicit JSON null name -> null (the row is dropped
    by grouping)."""
    name = F.try_variant_get(e, "$.name", "variant")
    return (F.when(e.isNull() | name.isNull(), F.lit(UNKNOWN))
            .when(F.is_variant_null(name), F.lit(None).cast("string"))
            .otherwise(F.try_variant_get(e, "$.name", "string")))


# --- payload fields (record building) ---------------------------------------

def join_list(c) -> Column:
    """Array of strings -> 'a, b'; not a list -> ''."""
    return F.coalesce(F.array_join(col(c), LIST_SEPARATOR), F.lit(""))


def format_names(c) -> Column:
    """Format objects -> their non-empty names joined."""
    names = F.filter(F.transform(col(c), lambda x: x["name"]),
                     lambda n: n.isNotNull() & (n != ""))
    return join_list(names)


def label_names(c) -> Column:
    """Label objects (VARIANT list) -> names joined; a missing or null name is kept as ''."""
    members = F.try_variant_get(col(c), "$", "array<struct<name:string>>")
    return join_list(F.transform(members["name"], lambda n: F.coalesce(n, F.lit(""))))


def youtube_links(c) -> Column:
    """Video objects -> URIs whose lower case contains the video host, joined."""
    uris = F.transform(col(c), lambda v: F.coalesce(v["uri"], F.lit("")))
    # a URI that has the host as it is, is not lowered
    return join_list(F.filter(uris, lambda u: u.contains(VIDEO_HOST) | F.lower(u).contains(VIDEO_HOST)))


def lowest_price(c, strict: bool = False) -> Column:
    """Price from a VARIANT that is an object {"value": n}, a number or null.

    strict=False (id-list job): object -> value or 0, anything else parsed as
    a number, unparseable/null -> 0. strict=True (search job): only objects and
    numbers count, every other type -> 0."""
    v = col(c)
    kind = F.schema_of_variant(v)
    obj = F.coalesce(F.try_variant_get(v, "$.value", "double"), F.lit(0.0))
    scalar = F.coalesce(F.try_variant_get(v, "$", "double"), F.lit(0.0))
    out = F.when(v.isNull(), F.lit(0.0)).when(kind.startswith("OBJECT"), obj)
    if strict:
        return out.when(kind.rlike(_NUMBER_SCHEMA_RE), scalar).otherwise(F.lit(0.0))
    return out.otherwise(scalar)


def as_json(c, empty: str = "[]") -> Column:
    """A VARIANT as JSON text with every member and null it has; missing or JSON null -> '[]'."""
    v = col(c)
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(empty)).otherwise(F.to_json(v))


def release_link(release_id, base: str = DEFAULT_LINK_BASE) -> Column:
    return F.concat(F.lit(base), col(release_id).cast("string"))
