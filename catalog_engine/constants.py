"""Fixed values.

These must equal the catalogue tool's own values for results to agree, so
they are stated once, here, in their natural order.
"""

# Release scoring.
RATING_PRIOR_MEAN = 3.0          # C of the per-release Bayesian rating
RATING_PRIOR_VOTES = 10          # m of the per-release Bayesian rating
LEADERBOARD_PRIOR_WEIGHT = 5     # m of the artist / label leaderboard
LEADERBOARD_PAGE_SIZE = 10
SEARCH_PAGE_SIZE = 50

# Placeholder texts.
UNKNOWN = "Unknown"
UNKNOWN_ARTIST = "Unknown Artist"
UNKNOWN_LABEL = "Unknown Label"
NOT_AVAILABLE_TITLE = "N/A"
NO_LINKS = "No links"
INVALID_LINK = "Invalid link"
DEFAULT_DURATION = "0:00"

# Separators and patterns.
LIST_SEPARATOR = ", "                      # multi-valued text columns
ARTIST_TITLE_SEPARATOR = " - "
LINK_DELIMITERS = [",", " ", ";"]          # first one present splits the link list
VIDEO_HOST = "youtube.com"
VIDEO_ID_PATTERN = (
    r"""(?:youtube\.com/(?:[^/]+/.+/|(?:v|e(?:mbed)?)/|.*[?&]v=)|youtu\.be/)([^"&?/\s]{11})"""
)
EXCLUDED_STYLE = "Techno"
WORD_PATTERN = r"(?U)\w[\w']+"                 # letters and digits of any script

# The report's texts.
REPORT_TITLE = "=== Release Catalogue Analysis Summary ==="
REPORT_SUMMARY = {
    "total_releases": "Total Releases: {:.0f}",
    "average_rating": "Average Rating: {:.2f}",
    "median_rating": "Median Rating: {:.2f}",
    "average_rating_count": "Average Rating Count: {:.2f}",
    "average_demand_coefficient": "Average Demand Coefficient: {:.2f}",
    "average_gem_value": "Average Gem Value: {:.2f}",
    "average_lowest_price": "Average Lowest Price: ${:.2f}",
    "average_num_tracks": "Average Number of Tracks: {:.2f}",
    "average_total_duration": "Average Total Duration: {:.2f} minutes",
}
REPORT_SECTIONS = {
    "summary": "Summary",
    "genres": "Top 10 Genres",
    "styles": "Top 10 Styles (Excluding '{excluded}')",
    "labels_by_popularity": "Top 100 Labels by Popularity (Average Want + Average Rating Coefficient)",
    "labels_by_rating": "Top 100 Best Rated Labels (Average Rating Coefficient per Release)",
    "artists_by_popularity": "Top 100 Artists by Popularity (Average Want Count per Release)",
    "artists_by_rating": "Top 100 Best Rated Artists (Average Rating Coefficient per Release)",
    "countries": "Top 20 Countries by Number of Releases",
    "formats": "Top 10 Formats",
    "correlations": "Key Correlations",
}

# Base of the canonical release link. The catalogue site's own base URL is
# configuration, not code: pass it to release_link(...) / normalise_payloads.
DEFAULT_LINK_BASE = "https://catalogue.example/release/"
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
