"""Column expressions used by the jobs; every one is a built-in Spark expression."""

from ._util import round_to, strip
from .display import display_tokens, fixed2, or_unknown, preview, rating_display
from .nested import (
    as_json, format_names, join_list, json_list, label_name, label_names,
    lowest_price, num_tracks, release_link, total_duration_min, youtube_links,
)
from .numeric import as_number, num_or_zero, parse_float, parse_int, release_year
from .scores import bayesian_rating, demand, gem_value
from .text import (
    artist_from_title, artist_key, clean_title, csv_tokens, first_link,
    label_key, list_tokens, youtube_id,
)

__all__ = [
    "artist_from_title", "artist_key", "as_json", "as_number", "bayesian_rating",
    "clean_title", "csv_tokens", "demand", "display_tokens", "first_link", "fixed2", "format_names",
    "gem_value", "join_list", "json_list", "label_key", "label_name",
    "label_names", "list_tokens", "lowest_price", "num_or_zero", "num_tracks",
    "or_unknown", "parse_float", "parse_int", "preview", "rating_display",
    "release_link", "release_year", "round_to", "strip", "total_duration_min", "youtube_id",
    "youtube_links",
]
