"""String functions over release text fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    ARTIST_TITLE_SEPARATOR, LINK_DELIMITERS, UNKNOWN, UNKNOWN_ARTIST,
    UNKNOWN_LABEL, VIDEO_ID_PATTERN,
)
from ._util import col, strip


def first_link(c) -> Column:
    """First link of a link list: the first delimiter (in fixed priority) that
    occurs splits the text; part 0 is stripped. Null or '' gives null."""
    c = col(c)
    out = F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
    for d in LINK_DELIMITERS:
        out = out.when(c.contains(d), strip(F.substring_index(c, d, 1)))
    return out.otherwise(strip(c))


def clean_title(title, artist) -> Column:
    """'artist - title' unless the artist already appears in the title
    (case-insensitive). An empty artist leaves the title untouched."""
    t0, a0 = col(title), col(artist)
    t, a = strip(t0), strip(a0)
    return (F.when(a0.isNull() | (a0 == ""), t0)
            .when(F.lower(t).contains(F.lower(a)), t)
            .otherwise(F.concat(a, F.lit(ARTIST_TITLE_SEPARATOR), t)))


def artist_from_title(c) -> Column:
    """Trimmed text before the first ' - '; 'Unknown Artist' without one."""
    c = col(c)
    has_sep = c.isNotNull() & c.contains(ARTIST_TITLE_SEPARATOR)
    return F.when(has_sep, strip(F.substring_index(c, ARTIST_TITLE_SEPARATOR, 1))).otherwise(
        F.lit(UNKNOWN_ARTIST))


def youtube_id(c) -> Column:
    """11-character video id of a video URL, null when there is none."""
    return F.nullif(F.regexp_extract(col(c), VIDEO_ID_PATTERN, 1), F.lit(""))


def label_key(c) -> Column:
    """Leaderboard key of a label text: the whole string; null/'' -> 'Unknown Label'."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(UNKNOWN_LABEL))


def artist_key(c) -> Column:
    """Stripped artist name; '' -> 'Unknown'; null stays null."""
    s = strip(c)
    return F.when(s == "", F.lit(UNKNOWN)).otherwise(s)


def csv_tokens(c) -> Column:
    """Comma tokens, stripped, empties dropped; null -> []."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), ","), lambda x: strip(x))
    return F.filter(parts, lambda x: x != "")


def list_tokens(c, sep: str = ", ") -> Column:
    """Tokens of a multi-valued text joined by ', ' ('' stays one empty token)."""
    return F.split(col(c), sep)
