"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each string runs on the raw test tables (views region, nation, customer,
supplier, part, orders, lineitem, events, ...) and repeats the release
mapping as CTEs, so it checks the Spark plan end to end. Column names equal
the Spark output; doubles are rounded alike.
"""

from __future__ import annotations

from ..constants import DEFAULT_LINK_BASE, VIDEO_ID_PATTERN, VIDEO_URL_PREFIX
from ..schemas import RAW_COLUMNS
from . import queries as Q

STRIP = "regexp_replace({0}, '^[\\s\\p{{Z}}\\x1c-\\x1f\\x85]+|[\\s\\p{{Z}}\\x1c-\\x1f\\x85]+$', '', 'g')"
DURATION_RE = r"^\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*$"


def strip(e: str) -> str:
    return STRIP.format(e)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


BASE = f"""
li AS (
  SELECT l.l_orderkey AS id, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount,
         l.l_returnflag, l.l_linestatus, p.p_type, p.p_brand, s.s_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN supplier s ON l.l_suppkey = s.s_suppkey),
agg AS (
  SELECT id,
    list_sort(list_distinct(list(p_type))) AS genres,
    list_sort(list_distinct(list(p_brand))) AS styles,
    list_sort(list_distinct(list(l_returnflag))) AS format_names,
    list_sort(list_distinct(list(s_name))) AS label_names,
    count(*) AS n_lines,
    sum(CAST(round(l_discount * 100) AS BIGINT)) AS discount_pct,
    CAST(sum(l_quantity) AS BIGINT) AS have,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price_cents,
    count(*) FILTER (WHERE l_linestatus = 'O') AS num_for_sale,
    min(l_extendedprice) AS lowest_price,
    coalesce('[' || string_agg('{{' || CASE l_linenumber WHEN 3 THEN '"duration":"none",' WHEN 4 THEN ''
           ELSE '"duration":"' || CAST(l_linenumber AS VARCHAR) || ':' ||
                lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 2, '0') || '",' END ||
           '"title":"T' || CAST(l_linenumber AS VARCHAR) || '"}}', ','
           ORDER BY l_linenumber, CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linenumber <> 2) || ']', '[]') AS tracklist
  FROM li GROUP BY id),
facts AS (
  SELECT a.*, o.o_orderdate, c.c_name, n.n_name,
         CAST(a.discount_pct AS DOUBLE) / a.n_lines / 2.0 AS average_rating,
         CAST(floor(CAST(a.price_cents AS DOUBLE) / 1000000.0) AS BIGINT) AS want,
         c.c_name || ' - Order ' || CAST(a.id AS VARCHAR) AS title,
         CASE WHEN a.id % 41 = 0 THEN 'Unknown' ELSE CAST(year(o.o_orderdate) AS VARCHAR) END AS year_text,
         strftime(o.o_orderdate, '%Y-%m-%d') AS released,
         CASE WHEN a.id % 11 = 0 THEN ''
              WHEN a.id % 5 = 0 THEN '{VIDEO_URL_PREFIX}' || lpad(CAST(a.id AS VARCHAR), 11, '0') || ', ' ||
                                     '{VIDEO_URL_PREFIX}' || lpad(CAST(a.id AS VARCHAR), 11, '0') || '&t=1'
              ELSE '{VIDEO_URL_PREFIX}' || lpad(CAST(a.id AS VARCHAR), 11, '0') END AS video_url,
         '[' || array_to_string(list_transform(label_names, lambda x: '{{"catno":"C' || CAST(a.id AS VARCHAR) || '","name":' ||
           CASE WHEN a.id % 97 = 0 AND x = label_names[1] THEN 'null' ELSE '"' || x || '"' END || '}}'), ',') || ']'
           AS labels_json,
         array_to_string(list_transform(label_names, lambda x:
           CASE WHEN a.id % 97 = 0 AND x = label_names[1] THEN '' ELSE x END), ', ') AS label_text,
         CASE WHEN a.id % 53 = 0 THEN '' ELSE n.n_name END AS country_text
  FROM agg a JOIN orders o ON a.id = o.o_orderkey
             JOIN customer c ON o.o_custkey = c.c_custkey
             JOIN nation n ON c.c_nationkey = n.n_nationkey),
scored AS (
  SELECT *,
    CASE WHEN n_lines = 0 THEN 3.0
         ELSE (n_lines / (n_lines + 10)) * average_rating + (10 / (n_lines + 10)) * 3.0 END AS rc,
    CASE WHEN greatest(have, 0) + greatest(want, 0) = 0 THEN 0.0
         ELSE greatest(want, 0) / (greatest(have, 0) + 1) END AS dc
  FROM facts),
raw AS (
  SELECT id, CAST(id AS VARCHAR) AS release_id, title, year_text AS year,
    array_to_string(genres, ', ') AS genre, array_to_string(styles, ', ') AS style,
    array_to_string(format_names, ', ') AS format, label_text AS label, country_text AS country,
    average_rating, n_lines AS rating_count, have, want, rc AS rating_coefficient,
    '{DEFAULT_LINK_BASE}' || CAST(id AS VARCHAR) AS link, video_url AS youtube_links,
    dc AS demand_coefficient, rc * dc AS gem_value, c_name AS artists_sort, labels_json AS labels,
    num_for_sale, lowest_price, released, tracklist, '[]' AS extraartists, '[]' AS images, '' AS thumb
  FROM scored),
prep AS (
  SELECT * REPLACE (CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) AS year),
    CAST(coalesce(json_array_length(tracklist), 0) AS INTEGER) AS num_tracks,
    coalesce(list_sum(list_transform(json_extract_string(tracklist, '$[*].duration'),
      lambda d: CASE WHEN regexp_matches(coalesce(d, '0:00'), '{DURATION_RE}')
        THEN CAST(regexp_extract(coalesce(d, '0:00'), '{DURATION_RE}', 1) AS DOUBLE) * 60
           + CAST(regexp_extract(coalesce(d, '0:00'), '{DURATION_RE}', 2) AS DOUBLE)
        ELSE 0.0 END)), 0.0) / 60.0 AS total_duration_min
  FROM raw WHERE TRY_CAST(year AS DOUBLE) <> 0),
clean AS (
  SELECT id,
    CASE WHEN artists_sort IS NULL OR artists_sort = '' THEN title
         WHEN contains(lower({strip('title')}), lower({strip('artists_sort')})) THEN {strip('title')}
         ELSE {strip('artists_sort')} || ' - ' || {strip('title')} END AS title,
    year, genre, style, label, country, average_rating, rating_count, have, want,
    rating_coefficient AS rating_coeff, link,
    CASE WHEN youtube_links IS NULL OR youtube_links = '' THEN NULL
         WHEN contains(youtube_links, ',') THEN {strip("split_part(youtube_links, ',', 1)")}
         WHEN contains(youtube_links, ' ') THEN {strip("split_part(youtube_links, ' ', 1)")}
         WHEN contains(youtube_links, ';') THEN {strip("split_part(youtube_links, ';', 1)")}
         ELSE {strip('youtube_links')} END AS youtube_links,
    demand_coefficient AS demand_coeff, gem_value, lowest_price, format
  FROM raw)"""

RAW_COLS = ("id, release_id, title, year, genre, style, format, label, country, round(average_rating, 6) AS average_rating, "
            "rating_count, have, want, round(rating_coefficient, 6) AS rating_coefficient, link, youtube_links, "
            "round(demand_coefficient, 6) AS demand_coefficient, round(gem_value, 6) AS gem_value, artists_sort, "
            "labels, num_for_sale, round(lowest_price, 6) AS lowest_price, released, tracklist, extraartists, "
            "images, thumb")
CLEAN_COLS = ("id, title, year, genre, style, label, country, round(average_rating, 6) AS average_rating, "
              "rating_count, have, want, round(rating_coeff, 6) AS rating_coeff, link, youtube_links, "
              "round(demand_coeff, 6) AS demand_coeff, round(gem_value, 6) AS gem_value, "
              "round(lowest_price, 6) AS lowest_price, format")

ARTIST = (f"CASE WHEN title IS NOT NULL AND contains(title, ' - ') THEN {strip("split_part(title, ' - ', 1)")} "
          "ELSE 'Unknown Artist' END")
LABEL_KEY = "coalesce(nullif(label, ''), 'Unknown Label')"

ORACLES: dict[str, str] = {}


def with_base(*ctes: str, select: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH {BASE}{extra}\n{select}"


# --- sources, record building, store ---------------------------------------------

ORACLES["q_releases"] = with_base(select=f"SELECT {RAW_COLS} FROM raw")

PAYLOAD_RAW = "payload_raw AS (SELECT * FROM raw)"
ORACLES["q_normalise_payloads"] = with_base(PAYLOAD_RAW, select=f"SELECT {RAW_COLS} FROM payload_raw")
ORACLES["q_stream_ingest"] = ORACLES["q_normalise_payloads"]

SEARCH_ROWS = f"""hits AS (
  SELECT o.o_orderkey AS id, c.c_name || ' - Order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
         CAST(year(o.o_orderdate) AS VARCHAR) AS year
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
search_rows AS (
  SELECT h.id, CAST(h.id AS VARCHAR) AS release_id, h.title, h.year,
    coalesce(p.genre, '') AS genre, coalesce(p.style, '') AS style, coalesce(p.format, '') AS format,
    coalesce(p.label, '') AS label, coalesce(p.country, '') AS country,
    coalesce(p.average_rating, 0.0) AS average_rating, coalesce(p.rating_count, 0) AS rating_count,
    coalesce(p.have, 0) AS have, coalesce(p.want, 0) AS want,
    coalesce(p.rating_coefficient, 3.0) AS rating_coefficient,
    '{DEFAULT_LINK_BASE}' || CAST(h.id AS VARCHAR) AS link, coalesce(p.youtube_links, '') AS youtube_links,
    coalesce(p.demand_coefficient, 0.0) AS demand_coefficient, coalesce(p.gem_value, 0.0) AS gem_value,
    coalesce(p.artists_sort, '') AS artists_sort, coalesce(p.labels, '[]') AS labels,
    coalesce(p.num_for_sale, 0) AS num_for_sale, coalesce(p.lowest_price, 0.0) AS lowest_price,
    coalesce(p.released, '') AS released, coalesce(p.tracklist, '[]') AS tracklist,
    '[]' AS extraartists, '[]' AS images, '' AS thumb
  FROM hits h LEFT JOIN payload_raw p ON h.id = p.id)"""
ORACLES["q_normalise_search"] = with_base(PAYLOAD_RAW, SEARCH_ROWS, select=f"SELECT {RAW_COLS} FROM search_rows")

ORACLES["q_clean_releases"] = with_base(select=f"SELECT {CLEAN_COLS} FROM clean")

ORACLES["q_missing_ids"] = with_base(select="""
SELECT release_id FROM (
  SELECT regexp_replace(CAST(o_orderkey AS VARCHAR), '^\\s+|\\s+$', '', 'g') AS release_id FROM orders)
WHERE regexp_matches(release_id, '^[0-9]+$')
  AND release_id NOT IN (SELECT release_id FROM raw)""")

ORACLES["q_insert_or_ignore"] = with_base(PAYLOAD_RAW, SEARCH_ROWS, select=f"""
SELECT {RAW_COLS} FROM (
  SELECT * FROM raw
  UNION ALL
  SELECT * FROM search_rows WHERE release_id NOT IN (SELECT release_id FROM raw))""")

ORACLES["q_bucketed_insert"] = ORACLES["q_insert_or_ignore"]

CLEAN_SEARCH = f"""clean_search AS (
  SELECT id,
    CASE WHEN artists_sort IS NULL OR artists_sort = '' THEN title
         WHEN contains(lower({strip('title')}), lower({strip('artists_sort')})) THEN {strip('title')}
         ELSE {strip('artists_sort')} || ' - ' || {strip('title')} END AS title,
    year, genre, style, label, country, average_rating, rating_count, have, want,
    rating_coefficient AS rating_coeff, link,
    CASE WHEN youtube_links IS NULL OR youtube_links = '' THEN NULL
         WHEN contains(youtube_links, ',') THEN {strip("split_part(youtube_links, ',', 1)")}
         WHEN contains(youtube_links, ' ') THEN {strip("split_part(youtube_links, ' ', 1)")}
         WHEN contains(youtube_links, ';') THEN {strip("split_part(youtube_links, ';', 1)")}
         ELSE {strip('youtube_links')} END AS youtube_links,
    demand_coefficient AS demand_coeff, gem_value, lowest_price, format
  FROM search_rows)"""
ORACLES["q_clean_insert"] = with_base(PAYLOAD_RAW, SEARCH_ROWS, CLEAN_SEARCH, select=f"""
SELECT {CLEAN_COLS} FROM (
  SELECT * FROM clean
  UNION ALL
  SELECT * FROM clean_search WHERE id NOT IN (SELECT id FROM clean))""")


def _search_where() -> str:
    s = Q.SEARCH
    conds = []
    for col, key in (("genre", "genres"), ("style", "styles"), ("format", "formats")):
        for w in s.get(key, ()) or ():
            conds.append(f"list_contains(string_split(coalesce({col}, ''), ', '), {q(w)})")
    lo, hi = s["year"].split("-")
    conds.append(f"TRY_CAST(year AS INTEGER) BETWEEN {int(lo)} AND {int(hi)}")
    return " AND ".join(conds)


ORACLES["q_search"] = with_base(select=f"""
SELECT {RAW_COLS} FROM raw WHERE {_search_where()}
ORDER BY average_rating DESC NULLS LAST, id ASC
LIMIT {Q.SEARCH['per_page']} OFFSET {(Q.SEARCH_PAGE - 1) * Q.SEARCH['per_page']}""")

ORACLES["q_search_state"] = with_base(select=f"""
SELECT count(*) AS total_items, {Q.SEARCH['per_page']} AS per_page,
       CAST(ceil(count(*) / {Q.SEARCH['per_page']}) AS BIGINT) AS total_pages
FROM raw WHERE {_search_where()}""")

ORACLES["q_search_postings"] = ORACLES["q_search"]
ORACLES["q_search_state_postings"] = ORACLES["q_search_state"]
ORACLES["q_search_deep_page"] = with_base(select=f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY average_rating DESC NULLS LAST, id ASC) AS rank, {RAW_COLS} FROM raw)
WHERE rank > {(Q.DEEP_PAGE - 1) * Q.SEARCH['per_page']} AND rank <= {Q.DEEP_PAGE * Q.SEARCH['per_page']}""")

ORACLES["q_sorted_by_gem"] = with_base(select=f"""
SELECT {RAW_COLS}, row_number() OVER (ORDER BY round(gem_value, 9) DESC, id ASC) - 1 AS position FROM raw""")
ORACLES["q_idlist_ingest"] = with_base(select=f"SELECT {RAW_COLS} FROM raw WHERE released >= '1998-01-01'")
ORACLES["q_truncated"] = with_base(select="""
SELECT count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, CAST(0 AS BIGINT) AS left_after_delete FROM raw WHERE year = '1996'""")
ORACLES["q_export_records"] = with_base(select="SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_COLUMNS) + " FROM raw")
ORACLES["q_existing_ids"] = with_base(select="SELECT DISTINCT CAST(release_id AS VARCHAR) AS release_id FROM raw")
ORACLES["q_export_written"] = with_base(select=" UNION ALL ".join(
    f"SELECT {q(fmt)} AS format, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in (
        "id", "title", "labels", "year", "average_rating", "gem_value")) + " FROM raw" for fmt in ("json", "csv")))
ORACLES["q_sorted_written"] = with_base(select="""
SELECT id, round(round(gem_value, 9), 6) AS gem_value, row_number() OVER (ORDER BY round(gem_value, 9) DESC, id ASC) - 1 AS position
FROM raw""")

ORACLES["q_saved_search_state"] = with_base(select=f"""
SELECT 3 AS resume_page, CAST(count(*) AS INTEGER) AS total_items, {Q.SEARCH['per_page']} AS per_page,
       {q(Q.SEARCH['sort'])} AS sort, {q(','.join(Q.SEARCH['genres']))} AS genres, {q(Q.SEARCH['year'])} AS year
FROM raw WHERE {_search_where()}""")

# --- aggregations --------------------------------------------------------------------


def _top_tokens(col: str, n: int, exclude=()) -> str:
    ex = f" WHERE {col} NOT IN ({', '.join(q(e) for e in exclude)})" if exclude else ""
    return with_base(select=f"""
SELECT {col}, count(*) AS release_count
FROM (SELECT unnest(string_split({col}, ', ')) AS {col} FROM prep){ex}
GROUP BY {col} ORDER BY release_count DESC, {col} ASC LIMIT {n}""")


ORACLES["q_top_genres"] = _top_tokens("genre", 10)
ORACLES["q_top_styles"] = _top_tokens("style", 10, [Q.EXCLUDED_STYLE])
ORACLES["q_top_formats"] = _top_tokens("format", 10)
ORACLES["q_top_countries"] = with_base(select="""
SELECT country, count(*) AS release_count FROM prep WHERE country IS NOT NULL
GROUP BY country ORDER BY release_count DESC, country ASC LIMIT 20""")

LABELS = """lab AS (
  SELECT id, want, rating_coefficient, year,
         unnest(CASE WHEN coalesce(json_array_length(labels), 0) = 0 THEN ['Unknown']
                     ELSE json_extract_string(labels, '$[*].name') END) AS label_name
  FROM prep),
label_stats AS (
  SELECT label_name, avg(want) AS average_want, avg(rating_coefficient) AS average_rating_coeff,
         count(id) AS release_count, avg(want) + avg(rating_coefficient) AS popularity_score
  FROM lab WHERE label_name IS NOT NULL GROUP BY label_name)"""
LABEL_COLS = ("label_name, round(average_want, 6) AS average_want, round(average_rating_coeff, 6) AS average_rating_coeff, "
              "release_count, round(popularity_score, 6) AS popularity_score")
ORACLES["q_top_labels_popularity"] = with_base(LABELS, select=f"""
SELECT {LABEL_COLS} FROM label_stats ORDER BY round(popularity_score, 9) DESC, label_name ASC LIMIT 100""")
ORACLES["q_top_labels_rating"] = with_base(LABELS, select=f"""
SELECT {LABEL_COLS} FROM label_stats ORDER BY round(average_rating_coeff, 9) DESC, label_name ASC LIMIT 100""")


def _artist_stats(measure: str, alias: str) -> str:
    return with_base(f"""art AS (
  SELECT CASE WHEN {strip('artists_sort')} = '' THEN 'Unknown' ELSE {strip('artists_sort')} END AS artist, {measure}
  FROM prep)""", select=f"""
SELECT artist, round(avg({measure}), 6) AS {alias}, count(artist) AS release_count
FROM art WHERE artist IS NOT NULL GROUP BY artist
ORDER BY round(avg({measure}), 9) DESC, artist ASC LIMIT 100""")


ORACLES["q_top_artists_want"] = _artist_stats("want", "average_want")
ORACLES["q_top_artists_rating"] = _artist_stats("rating_coefficient", "average_rating_coeff")

ORACLES["q_summary"] = with_base(select="""
SELECT count(*) AS total_releases, round(avg(average_rating), 6) AS average_rating,
       round(quantile_cont(average_rating, 0.5), 6) AS median_rating,
       round(avg(rating_count), 6) AS average_rating_count,
       round(avg(demand_coefficient), 6) AS average_demand_coefficient,
       round(avg(gem_value), 6) AS average_gem_value, round(avg(lowest_price), 6) AS average_lowest_price,
       round(avg(num_tracks), 6) AS average_num_tracks,
       round(avg(total_duration_min), 6) AS average_total_duration
FROM prep""")


def _facets(col: str) -> str:
    return with_base(select=f"""
SELECT DISTINCT {col} FROM (
  SELECT unnest(list_filter(list_transform(string_split(coalesce({col}, ''), ','),
                                           lambda x: {strip('x')}), lambda x: x <> '')) AS {col}
  FROM clean) ORDER BY {col}""")


ORACLES["q_facets_genre"] = _facets("genre")
ORACLES["q_facets_style"] = _facets("style")


def _terms(col: str, exclude=()) -> str:
    ex = f" WHERE tok NOT IN ({', '.join(q(e) for e in exclude)})" if exclude else ""
    return with_base(select=f"""
SELECT lower(w) AS term, count(*) AS frequency FROM (
  SELECT unnest(regexp_extract_all(tok, '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}][\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}'']+')) AS w FROM (
    SELECT unnest(string_split({col}, ', ')) AS tok FROM prep){ex})
GROUP BY lower(w)""")


ORACLES["q_terms_genre"] = _terms("genre")
ORACLES["q_terms_style"] = _terms("style", [Q.EXCLUDED_STYLE])

# --- rankings -------------------------------------------------------------------------


def _leaderboard_cte(entity: str, where: str = "TRUE") -> str:
    key = ARTIST if entity == "artist" else LABEL_KEY
    return f"""keyed AS (
  SELECT {key} AS {entity}, coalesce(CASE WHEN isnan(rating_coeff) THEN 0.0 ELSE rating_coeff END, 0.0) AS r
  FROM clean WHERE {where}),
g AS (SELECT coalesce(avg(r), 0.0) AS g FROM keyed),
lb AS (
  SELECT {entity}, count(*) AS release_count, sum(r) / count(*) AS average_rating_coeff,
         (5.0 * (SELECT g FROM g) + sum(r)) / (5.0 + count(*)) AS bayesian_score
  FROM keyed GROUP BY {entity})"""


LB_COLS = "release_count, round(average_rating_coeff, 6) AS average_rating_coeff, round(bayesian_score, 6) AS bayesian_score"
ORACLES["q_artist_leaderboard"] = with_base(_leaderboard_cte("artist"), select=f"SELECT artist, {LB_COLS} FROM lb")
ORACLES["q_label_leaderboard"] = with_base(_leaderboard_cte("label"), select=f"SELECT label, {LB_COLS} FROM lb")


def _page(entity: str, page: int, size: int = 10) -> str:
    return with_base(_leaderboard_cte(entity), select=f"""
SELECT CAST(rank AS INTEGER) AS rank, {entity}, {LB_COLS} FROM (
  SELECT *, row_number() OVER (ORDER BY round(bayesian_score, 9) DESC, {entity} ASC) AS rank FROM lb)
WHERE rank > {(page - 1) * size} AND rank <= {page * size}""")


ORACLES["q_artist_leaderboard_page"] = _page("artist", 1)
ORACLES["q_label_leaderboard_page"] = _page("label", 2)


def _filter_where() -> str:
    f = Q.LEADERBOARD_FILTER
    row_year = "coalesce(TRY_CAST(nullif(regexp_extract(year, '^\\s*([+-]?\\d+)', 1), '') AS BIGINT), 0)"
    conds = [f"{row_year} >= {int(f['year_min'])}", f"{row_year} <= {int(f['year_max'])}"]
    conds.append(f"coalesce(genre, '') <> '' AND list_contains(list_transform(string_split(genre, ','), "
                 f"lambda x: {strip('x')}), {q(f['genre'])})")
    qq = f["query"].lower().strip()
    conds.append(f"(contains(lower({ARTIST}), {q(qq)}) OR contains(lower(coalesce(title, '')), {q(qq)}))")
    return " AND ".join(conds)


ORACLES["q_artist_leaderboard_filtered"] = with_base(_leaderboard_cte("artist", _filter_where()),
                                                     select=f"SELECT artist, {LB_COLS} FROM lb")
ORACLES["q_leaderboard_by_text"] = ORACLES["q_artist_leaderboard_filtered"]
ORACLES["q_artist_pages"] = with_base(_leaderboard_cte("artist"), select="""
SELECT count(*) AS entity_count, CAST(ceil(count(*) / 10) AS BIGINT) AS page_count FROM lb""")
ORACLES["q_label_pages"] = with_base(_leaderboard_cte("label"), select="""
SELECT count(*) AS entity_count, CAST(ceil(count(*) / 10) AS BIGINT) AS page_count FROM lb""")

ORACLES["q_artist_releases"] = with_base(_leaderboard_cte("artist"), """top1 AS (
  SELECT artist FROM lb ORDER BY round(bayesian_score, 9) DESC, artist ASC LIMIT 1)""", f"""seen AS (
  SELECT DISTINCT user_id AS id FROM events)""", select=f"""
SELECT {CLEAN_COLS},
  CASE WHEN tok IS NULL THEN 'No links'
       WHEN nullif(regexp_extract(tok, {q(VIDEO_ID_PATTERN)}, 1), '') IS NULL THEN 'Invalid link'
       ELSE regexp_extract(tok, {q(VIDEO_ID_PATTERN)}, 1) END AS preview,
  (id IN (SELECT id FROM seen)) AS is_interacted
FROM (
  SELECT *, list_filter(list_transform(string_split(coalesce(youtube_links, ''), ','), lambda x: {strip('x')}),
                        lambda x: x <> '')[1] AS tok
  FROM clean WHERE {ARTIST} = (SELECT artist FROM top1))""")

def _fixed2(v: str) -> str:
    # printf works on the exact value; it takes exact ties to the even digit, the display takes them up
    tie = f"{v} * 8 = floor({v} * 8)"
    return (f"CASE WHEN {v} IS NULL OR isnan({v}) OR {v} = 0 THEN '0.00' "
            f"ELSE printf('%.2f', CASE WHEN {tie} THEN {v} + 1e-9 ELSE {v} END) END")


def _shown_tokens(c: str) -> str:
    v = f"coalesce(nullif({c}, ''), 'Unknown')"
    return f"array_to_string(list_transform(string_split({v}, ','), lambda x: {strip('x')}), ', ') AS {c}"


ORACLES["q_artist_releases_display"] = with_base(_leaderboard_cte("artist"), """top1 AS (
  SELECT artist FROM lb ORDER BY round(bayesian_score, 9) DESC, artist ASC LIMIT 1)""", """seen AS (
  SELECT DISTINCT user_id AS id FROM events)""", select=f"""
SELECT id, title, coalesce(nullif(label, ''), 'Unknown') AS label, coalesce(year, '') AS year,
  {_shown_tokens('genre')}, {_shown_tokens('style')},
  {_fixed2('rating_coeff')} || ' (' || CAST(coalesce(rating_count, 0) AS VARCHAR) || ')' AS rating,
  {_fixed2('demand_coeff')} AS demand, {_fixed2('gem_value')} AS gem,
  coalesce(have, 0) AS have, coalesce(want, 0) AS want,
  CASE WHEN tok IS NULL THEN 'No links'
       WHEN nullif(regexp_extract(tok, {q(VIDEO_ID_PATTERN)}, 1), '') IS NULL THEN 'Invalid link'
       ELSE regexp_extract(tok, {q(VIDEO_ID_PATTERN)}, 1) END AS preview,
  (id IN (SELECT id FROM seen)) AS is_interacted
FROM (
  SELECT *, list_filter(list_transform(string_split(coalesce(youtube_links, ''), ','), lambda x: {strip('x')}),
                        lambda x: x <> '')[1] AS tok
  FROM clean WHERE {ARTIST} = (SELECT artist FROM top1))""")

ORACLES["q_best_styles"] = with_base("""st AS (
  SELECT style_list, sum(rating_coefficient) AS s, count(*) AS n
  FROM (SELECT unnest(string_split(style, ', ')) AS style_list, rating_coefficient FROM prep)
  GROUP BY style_list)""", """pri AS (
  SELECT quantile_cont(CAST(n AS DOUBLE), 0.5) AS m, avg(s / n) AS c FROM st)""", select="""
SELECT style_list, round(s, 6) AS sum_rating_coeff, n AS release_count,
       round((s + (SELECT m * c FROM pri)) / (n + (SELECT m FROM pri)), 6) AS bayesian_avg
FROM st ORDER BY round((s + (SELECT m * c FROM pri)) / (n + (SELECT m FROM pri)), 9) DESC, style_list ASC
LIMIT 100""")

# --- trends ----------------------------------------------------------------------------

ORACLES["q_releases_per_year"] = with_base(select="""
SELECT year, count(*) AS release_count FROM prep WHERE year IS NOT NULL GROUP BY year ORDER BY year""")
ORACLES["q_gem_per_year"] = with_base(select="""
SELECT year, round(avg(gem_value), 6) AS average_gem_value FROM prep
WHERE year IS NOT NULL AND gem_value IS NOT NULL GROUP BY year ORDER BY year""")
ORACLES["q_gem_per_year_clustered"] = with_base(select=f"""
SELECT year, round(avg(gem_value), 6) AS average_gem_value FROM prep
WHERE year BETWEEN {Q.CLUSTERED_YEARS[0]} AND {Q.CLUSTERED_YEARS[1]} AND gem_value IS NOT NULL
  AND list_contains(string_split(style, ', '), '{Q.EXCLUDED_STYLE}') GROUP BY year ORDER BY year""")
ORACLES["q_label_trend"] = with_base(LABELS, """top AS (
  SELECT label_name FROM label_stats ORDER BY round(popularity_score, 9) DESC, label_name ASC LIMIT 10)""",
                                     select="""
SELECT year, label_name, count(*) AS release_count FROM lab
WHERE label_name IN (SELECT label_name FROM top) AND year IS NOT NULL GROUP BY year, label_name""")

STYLE_TOP = f"""topst AS (
  SELECT style FROM (SELECT unnest(string_split(style, ', ')) AS style FROM prep)
  WHERE style <> {q(Q.EXCLUDED_STYLE)}
  GROUP BY style ORDER BY count(*) DESC, style ASC LIMIT 10),
sty AS (
  SELECT id, title, artists_sort, year, {strip('s')} AS style
  FROM (SELECT id, title, artists_sort, year, unnest(string_split(style, ', ')) AS s FROM prep)),
st_long AS (
  SELECT year, style, count(*) AS release_count FROM sty
  WHERE style IN (SELECT style FROM topst) GROUP BY year, style)"""
ORACLES["q_style_trend"] = with_base(STYLE_TOP, select="SELECT year, style, release_count FROM st_long")


def _positional(key: str, long: str, ranked: str) -> str:
    cols = ", ".join(f"CAST(coalesce(max(CASE WHEN rk = {k} THEN release_count END), 0) AS BIGINT) AS c{k:02d}"
                     for k in range(1, 11))
    return f"SELECT year, {cols} FROM {long} JOIN {ranked} USING ({key}) GROUP BY year"


ORACLES["q_style_trend_wide"] = with_base(STYLE_TOP, f"""rk AS (
  SELECT style, row_number() OVER (ORDER BY count(*) DESC, style ASC) AS rk
  FROM (SELECT unnest(string_split(style, ', ')) AS style FROM prep) WHERE style <> {q(Q.EXCLUDED_STYLE)} GROUP BY style)""",
                                          select=_positional("style", "st_long", "rk"))
ORACLES["q_style_defining"] = with_base(STYLE_TOP, """firsts AS (
  SELECT style, min(year) AS fy FROM sty WHERE style IN (SELECT style FROM topst) AND year IS NOT NULL
  GROUP BY style)""", select="""
SELECT s.id, s.title, s.artists_sort, s.year, s.style FROM sty s JOIN firsts f
  ON s.style = f.style AND s.year = f.fy""")

COUNTRY_TOP = """topc AS (
  SELECT country FROM prep WHERE country IS NOT NULL GROUP BY country
  ORDER BY count(*) DESC, country ASC LIMIT 10),
c_long AS (
  SELECT year, country, count(*) AS release_count FROM prep
  WHERE country IN (SELECT country FROM topc) GROUP BY year, country)"""
ORACLES["q_country_trend"] = with_base(COUNTRY_TOP, select="SELECT year, country, release_count FROM c_long")
ORACLES["q_country_trend_wide"] = with_base(COUNTRY_TOP, """rk AS (
  SELECT country, row_number() OVER (ORDER BY count(*) DESC, country ASC) AS rk
  FROM prep WHERE country IS NOT NULL GROUP BY country)""", select=_positional("country", "c_long", "rk"))

# --- distributions ----------------------------------------------------------------------


def _edge(j: str, k: int, lo: str = "lo", hi: str = "hi") -> str:
    return f"(CASE WHEN {j} = {k} THEN {hi} ELSE CAST({j} AS DOUBLE) * (({hi} - {lo}) / {k}) + {lo} END)"


def _bin(x: str, k: int, lo: str = "lo", hi: str = "hi") -> str:
    """Bin of x among k equal bins over [lo, hi], corrected against the edges."""
    i0 = f"CAST(least(floor(({x} - {lo}) * ({k} / ({hi} - {lo}))), {k - 1}) AS INTEGER)"
    return (f"(CASE WHEN {x} < {_edge(i0, k, lo, hi)} THEN {i0} - 1 "
            f"WHEN {x} >= {_edge(i0 + ' + 1', k, lo, hi)} AND {i0} <> {k - 1} THEN {i0} + 1 ELSE {i0} END)")


def _range_cte(name: str, col: str, lo: str = "lo", hi: str = "hi") -> str:
    return f"""{name} AS (
  SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS {lo},
         CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS {hi}
  FROM (SELECT CAST({col} AS DOUBLE) AS v FROM prep WHERE {col} IS NOT NULL))"""


def _hist(col: str, k: int) -> str:
    return with_base(_range_cte("rng", col), f"""cnt AS (
  SELECT {_bin('v', k)} AS bin, count(*) AS c
  FROM (SELECT CAST({col} AS DOUBLE) AS v FROM prep WHERE {col} IS NOT NULL), rng GROUP BY bin)""", select=f"""
SELECT CAST(b.range AS INTEGER) AS bin, round({_edge('b.range', k)}, 6) AS bin_start,
       round({_edge('b.range + 1', k)}, 6) AS bin_end, CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
FROM range({k}) b CROSS JOIN rng LEFT JOIN cnt ON cnt.bin = b.range""")


for _n, (_c, _k) in Q.HISTOGRAMS.items():
    ORACLES[_n] = _hist(_c, _k)

ORACLES["q_hist_num_tracks"] = with_base(select="""
SELECT g.range AS num_tracks, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(0, (SELECT max(num_tracks) FROM prep) + 1) g
LEFT JOIN (SELECT CAST(num_tracks AS BIGINT) AS v, count(*) AS n FROM prep GROUP BY v) c ON c.v = g.range""")


def _kde_parts(col: str, tag: str = "", grid: int = Q.KDE_GRID, label: bool = False):
    kd, ks, kc = f"kd{tag}", f"ks{tag}", f"kc{tag}"
    ctes = [f"""{kd} AS (SELECT CAST({col} AS DOUBLE) AS v FROM prep WHERE {col} IS NOT NULL)""", f"""{ks} AS (
  SELECT min(v) AS lo, max(v) AS hi, count(v) AS n, stddev_samp(v) AS sd FROM {kd})""", f"""{kc} AS (
  SELECT floor((v - lo) * 20.0 / (sd * pow(n, -1.0 / 5.0))) AS b, count(*) AS w, avg(v) AS c
  FROM {kd}, {ks} GROUP BY b)"""]
    g = f"(CAST(j.range AS DOUBLE) * ((hi - lo) / {grid - 1}) + lo)"
    h = "(sd * pow(n, -1.0 / 5.0))"
    first = f"{q(col)} AS \"column\", " if label else ""
    select = f"""
SELECT {first}CAST(j.range AS INTEGER) AS grid_index, round({g}, 9) AS x,
       round(sum(w * exp(-0.5 * (({g} - c) / {h}) * (({g} - c) / {h}))) * (1.0 / (n * {h} * sqrt(2 * pi()))), 9)
         AS density
FROM {kc} CROSS JOIN range({grid}) j CROSS JOIN {ks}
GROUP BY j.range, hi, lo, n, sd"""
    return ctes, select


def _kde(col: str) -> str:
    ctes, select = _kde_parts(col)
    return with_base(*ctes, select=select)


for _n, _c in Q.KDES.items():
    ORACLES[_n] = _kde(_c)


def _box(value: str) -> str:
    return with_base(f"""tok AS (
  SELECT g, count(*) AS n FROM (SELECT unnest(string_split(genre, ', ')) AS g FROM prep)
  GROUP BY g ORDER BY n DESC, g ASC LIMIT 5)""", """pat AS (SELECT string_agg(g, '|' ORDER BY n DESC, g ASC) AS p FROM tok)""",
                     f"""rows AS (
  SELECT genre AS _g, CAST({value} AS DOUBLE) AS v FROM prep
  WHERE genre IS NOT NULL AND {value} IS NOT NULL AND regexp_matches(genre, (SELECT p FROM pat)))""", """qs AS (
  SELECT _g, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
         quantile_cont(v, 0.75) AS q3 FROM rows GROUP BY _g)""", """wh AS (
  SELECT r._g, coalesce(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), any_value(q1)) AS wl,
         coalesce(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS wh
  FROM rows r JOIN qs ON r._g = qs._g GROUP BY r._g)""", select="""
SELECT qs._g AS genre, qs.n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(wl, 6) AS whisker_low, round(wh, 6) AS whisker_high,
       (SELECT count(*) FROM rows r WHERE r._g = qs._g AND (r.v < wh.wl OR r.v > wh.wh)) AS n_outliers
FROM qs JOIN wh ON qs._g = wh._g""")


ORACLES["q_xy_sample"] = with_base(select=f"""
SELECT id, round(average_rating, 6) AS average_rating, round(lowest_price, 6) AS lowest_price FROM prep
WHERE id IS NOT NULL AND average_rating IS NOT NULL AND lowest_price IS NOT NULL
ORDER BY md5('42:' || id), id LIMIT {Q.SAMPLE_POINTS}""")
ORACLES["q_box_tracks"] = _box("num_tracks")
ORACLES["q_box_duration"] = _box("total_duration_min")


def _xy(x: str, y: str, colour: str | None, k: int = Q.SCATTER_BINS) -> str:
    rx, ry = _range_cte("rx", x, "xlo", "xhi"), _range_cte("ry", y, "ylo", "yhi")
    extra = f", round(avg({colour}), 6) AS mean_{colour}" if colour else ""
    return with_base(rx, ry, select=f"""
SELECT {_bin(f'CAST({x} AS DOUBLE)', k, 'xlo', 'xhi')} AS x_bin,
       {_bin(f'CAST({y} AS DOUBLE)', k, 'ylo', 'yhi')} AS y_bin, count(*) AS count{extra}
FROM prep, rx, ry WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY x_bin, y_bin""")


for _n, (_x, _y, _c) in Q.SCATTERS.items():
    ORACLES[_n] = _xy(_x, _y, _c)


def _pairwise(cols: list[str], k: int = Q.PAIRWISE_BINS) -> str:
    ranges = ",\n".join(
        f"min(CAST({c} AS DOUBLE)) AS mn_{c}, max(CAST({c} AS DOUBLE)) AS mx_{c}" for c in cols)
    lohi = ",\n".join(
        f"CASE WHEN mn_{c} = mx_{c} THEN mn_{c} - 0.5 ELSE mn_{c} END AS lo_{c}, "
        f"CASE WHEN mn_{c} = mx_{c} THEN mx_{c} + 0.5 ELSE mx_{c} END AS hi_{c}" for c in cols)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    binned = ",\n".join(f"{_bin(f'CAST({c} AS DOUBLE)', k, f'lo_{c}', f'hi_{c}')} AS b_{c}" for c in cols)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT {q(a)} AS x_col, {q(b)} AS y_col, b_{a} AS x_bin, b_{b} AS y_bin, count(*) AS count "
                         f"FROM pb GROUP BY b_{a}, b_{b}")
    return with_base(f"pr0 AS (SELECT {ranges} FROM prep WHERE {notnull})",
                     f"pr AS (SELECT {lohi} FROM pr0)",
                     f"pb AS (SELECT {binned} FROM prep, pr WHERE {notnull})",
                     select="\nUNION ALL\n".join(parts))


ORACLES["q_pairwise"] = _pairwise(Q.PAIRWISE_COLUMNS)


def _diagonal(cols: list[str]) -> str:
    ctes, selects = [], []
    for i, c in enumerate(cols):
        cc, sel = _kde_parts(c, tag=str(i), label=True)
        ctes += cc
        selects.append(sel)
    return with_base(*ctes, select="\nUNION ALL\n".join(selects))


ORACLES["q_pairwise_diagonal"] = _diagonal(Q.PAIRWISE_COLUMNS)

# --- statistics ---------------------------------------------------------------------------


def _corr(a: str, b: str) -> str:
    return (f"CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) = 0 OR stddev_pop(CAST({b} AS DOUBLE)) = 0 THEN NULL "
            f"ELSE round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) END")


def _corr_matrix(cols: list[str]) -> str:
    parts = [f"SELECT {q(a)} AS col_a, {q(b)} AS col_b, {_corr(a, b)} AS r FROM prep" for a in cols for b in cols]
    return with_base(select="\nUNION ALL\n".join(parts))


from ..operators import stats as _ST  # noqa: E402

ORACLES["q_corr_matrix"] = _corr_matrix(_ST.CORR_COLUMNS)
ORACLES["q_corr_report"] = _corr_matrix(_ST.CORR_COLUMNS + ["total_duration_min"])
_nn = " AND ".join(f"{c} IS NOT NULL" for c in _ST.PRICE_FEATURES + ["lowest_price"])
ORACLES["q_corr_price"] = with_base(f"cp AS (SELECT * FROM prep WHERE {_nn})", select="\nUNION ALL\n".join(
    f"SELECT {q(c)} AS feature, {_corr(c, 'lowest_price')} AS r FROM cp" for c in _ST.PRICE_FEATURES))
ORACLES["q_ols_simple"] = with_base(select="""
SELECT round(regr_slope(lowest_price, gem_value), 6) AS slope,
       round(regr_intercept(lowest_price, gem_value), 6) AS intercept,
       round(regr_r2(lowest_price, gem_value), 6) AS r_squared
FROM prep WHERE lowest_price IS NOT NULL AND gem_value IS NOT NULL""")


ORACLES["q_split_counts"] = with_base(select="""
SELECT part, count(*) AS n FROM (
  SELECT CASE WHEN substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8) < '40000000' THEN 'test' ELSE 'train' END AS part FROM prep)
GROUP BY part""")
ORACLES["q_csv_written"] = ORACLES["q_best_styles"]


def _report_oracle() -> str:
    def ranked(section: str, source: str, key: str, metrics: list[str], order: str, limit: int, digits: bool = True) -> str:
        score = f"round({order}, 9)" if digits else order
        top = (f"(SELECT *, row_number() OVER (ORDER BY {score} DESC, {key} ASC) AS rk FROM {source})")
        return "\nUNION ALL\n".join(
            f"SELECT {q(section)} AS section, CAST(rk AS INTEGER) AS rank, {key} AS key, {q(m)} AS metric, "
            f"round(CAST({m} AS DOUBLE), 6) AS value FROM {top} WHERE rk <= {limit}" for m in metrics)

    def tokens(col: str, exclude: str = "") -> str:
        return (f"(SELECT {col}, count(*) AS release_count FROM (SELECT unnest(string_split({col}, ', ')) AS {col} FROM prep)"
                f"{exclude} GROUP BY {col})")

    def artists(measure: str, alias: str) -> str:
        return f"(SELECT artist, avg({measure}) AS {alias}, count(artist) AS release_count FROM art GROUP BY artist)"
    summary = {"total_releases": "count(*)", "average_rating": "avg(average_rating)",
               "median_rating": "quantile_cont(average_rating, 0.5)", "average_rating_count": "avg(rating_count)",
               "average_demand_coefficient": "avg(demand_coefficient)", "average_gem_value": "avg(gem_value)",
               "average_lowest_price": "avg(lowest_price)", "average_num_tracks": "avg(num_tracks)",
               "average_total_duration": "avg(total_duration_min)"}
    cols = _ST.CORR_COLUMNS + ["total_duration_min"]
    parts = [f"SELECT 'summary' AS section, 0 AS rank, '' AS key, {q(k)} AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM prep"
             for k, e in summary.items()]
    parts += [
        ranked("genres", tokens("genre"), "genre", ["release_count"], "release_count", 10, False),
        ranked("styles", tokens("style", f" WHERE style <> {q(Q.EXCLUDED_STYLE)}"), "style", ["release_count"],
               "release_count", 10, False),
        ranked("labels_by_popularity", "label_stats", "label_name",
               ["average_want", "average_rating_coeff", "release_count", "popularity_score"], "popularity_score", 100),
        ranked("labels_by_rating", "label_stats", "label_name", ["average_rating_coeff", "release_count"],
               "average_rating_coeff", 100),
        ranked("artists_by_popularity", artists("want", "average_want"), "artist", ["average_want", "release_count"],
               "average_want", 100),
        ranked("artists_by_rating", artists("rating_coefficient", "average_rating_coeff"), "artist",
               ["average_rating_coeff", "release_count"], "average_rating_coeff", 100),
        ranked("countries", "(SELECT country, count(*) AS release_count FROM prep WHERE country IS NOT NULL GROUP BY country)",
               "country", ["release_count"], "release_count", 20, False),
        ranked("formats", tokens("format"), "format", ["release_count"], "release_count", 10, False)]
    parts += [f"SELECT 'correlations' AS section, 0 AS rank, {q(a)} AS key, {q(b)} AS metric, {_corr(a, b)} AS value FROM prep"
              for a in cols for b in cols]
    art = f"""art AS (
  SELECT CASE WHEN {strip('artists_sort')} = '' THEN 'Unknown' ELSE {strip('artists_sort')} END AS artist, want, rating_coefficient
  FROM prep WHERE artists_sort IS NOT NULL)"""
    return with_base(LABELS, art, select="\nUNION ALL\n".join(parts))


ORACLES["q_report"] = _report_oracle()
for _live, _batch in (("q_live_artist_leaderboard", "q_artist_leaderboard"), ("q_live_label_leaderboard", "q_label_leaderboard"),
                      ("q_live_top_styles", "q_top_styles"), ("q_live_labels_popularity", "q_top_labels_popularity"),
                      ("q_live_label_trend", "q_label_trend"), ("q_live_style_trend", "q_style_trend"),
                      ("q_live_gem_per_year", "q_gem_per_year")):
    ORACLES[_live] = ORACLES[_batch]




def _moments(cols: list[str]) -> list[str]:
    """CTEs mom0 (n, means m_i) and mom (centred cross products s_i_j) of the rows without nulls."""
    rows = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(cols))
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    p = range(len(cols))
    return [f"obs AS (SELECT id, {rows} FROM prep WHERE {nn})",
            "mom0 AS (SELECT count(*) AS n, " + ", ".join(f"avg(x{i}) AS m{i}" for i in p) + " FROM obs)",
            "mom AS (SELECT any_value(n) AS n, " + ", ".join(f"any_value(m{i}) AS m{i}" for i in p) + ", " + ", ".join(
                f"sum((x{i} - m{i}) * (x{j} - m{j})) AS s_{i}_{j}" for i in p for j in p if i <= j) + " FROM obs, mom0)"]


def _inverse(first: str, entry, p: int, extra: int = 0) -> list[str]:
    """CTEs g0..gp: Gauss-Jordan over the p x p matrix `entry(i, j)` of the one
    row of `first`, on unit scales (u_i), with an identity beside it. After the
    last pivot the inverse on unit scales is a_i_{p + j}."""
    cells = [(i, j) for i in range(p) for j in range(2 * p)]

    def start(i: int, j: int) -> str:
        if j >= p:
            return "1.0" if j - p == i else "0.0"
        return f"({entry(i, j)}) / (sqrt({entry(i, i)}) * sqrt({entry(j, j)}))"
    out = [f"g0 AS (SELECT {first}.*, " + ", ".join(f"{start(i, j)} AS a_{i}_{j}" for i, j in cells) + f" FROM {first})"]
    for k in range(p):
        step = ", ".join(
            (f"a_{k}_{j} / a_{k}_{k}" if i == k else f"a_{i}_{j} - a_{i}_{k} * a_{k}_{j} / a_{k}_{k}") + f" AS a_{i}_{j}"
            for i, j in cells)
        out.append(f"g{k + 1} AS (SELECT g{k}.* EXCLUDE ({', '.join(f'a_{i}_{j}' for i, j in cells)}), {step} FROM g{k})")
    return out


def _s(i: int, j: int) -> str:
    return f"s_{min(i, j)}_{max(i, j)}"


def _ols_ctes() -> list[str]:
    xs = _ST.OLS_FEATURES
    p = len(xs)
    cols = ["lowest_price", *xs]
    beta = ", ".join("(" + " + ".join(f"a_{i}_{p + j} * {_s(0, j + 1)} / sqrt({_s(j + 1, j + 1)})" for j in range(p))
                     + f") / sqrt({_s(i + 1, i + 1)}) AS b{i + 1}" for i in range(p))
    ssr = "s_0_0 - (" + " + ".join(f"b{i + 1} * {_s(0, i + 1)}" for i in range(p)) + ")"
    b0 = "m0 - (" + " + ".join(f"b{i + 1} * m{i + 1}" for i in range(p)) + ")"
    v0 = "1.0 / n + " + " + ".join(
        f"m{i + 1} / sqrt({_s(i + 1, i + 1)}) * a_{i}_{p + j} * m{j + 1} / sqrt({_s(j + 1, j + 1)})"
        for i in range(p) for j in range(p))
    se = ", ".join(f"sqrt(v * a_{i}_{p + i} / {_s(i + 1, i + 1)}) AS e{i + 1}" for i in range(p))
    return [*_moments(cols), *_inverse("mom", lambda i, j: _s(i + 1, j + 1), p),
            f"bet AS (SELECT *, {beta} FROM g{p})", f"fit0 AS (SELECT *, {b0} AS b0, {ssr} AS ssr, s_0_0 AS sst FROM bet)",
            f"fit1 AS (SELECT *, ssr / (n - {p + 1}) AS v FROM fit0)",
            f"fit AS (SELECT *, sqrt(v * ({v0})) AS e0, {se}, 1 - ssr / sst AS r2 FROM fit1)"]


_OLS = _ols_ctes()
_K = len(_ST.OLS_FEATURES) + 1
ORACLES["q_ols_coef"] = with_base(*_OLS, select="\nUNION ALL\n".join(
    f"SELECT {q(t)} AS term, round(b{i}, 6) AS coef, round(e{i}, 6) AS std_err, round(b{i} / e{i}, 6) AS t FROM fit"
    for i, t in enumerate(["const", *_ST.OLS_FEATURES])))
ORACLES["q_ols_fit"] = with_base(*_OLS, """ll AS (
  SELECT *, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS llf FROM fit)""", select=f"""
SELECT n AS n_obs, n - {_K} AS df_resid, CAST({_K - 1} AS BIGINT) AS df_model, round(r2, 6) AS r_squared,
  round(1 - (1 - r2) * (n - 1) / (n - {_K}), 6) AS adj_r_squared,
  round((r2 / {_K - 1}) / ((1 - r2) / (n - {_K})), 6) AS f_statistic, round(llf, 6) AS log_likelihood,
  round(-2 * llf + 2 * {_K}, 6) AS aic, round(-2 * llf + {_K} * ln(n), 6) AS bic FROM ll""")
ORACLES["q_ols_diagnostics"] = with_base(*_OLS, "res AS (SELECT id, x0 - (b0 + " + " + ".join(
    f"b{i} * x{i}" for i in range(1, _K)) + ") AS e FROM obs, fit)", """mm AS (SELECT avg(e) AS mu FROM res)""", """cen AS (
  SELECT count(*) AS n, avg(pow(e - mu, 2)) AS m2, avg(pow(e - mu, 3)) AS m3, avg(pow(e - mu, 4)) AS m4 FROM res, mm)""",
                                         """dw AS (
  SELECT sum(pow(e - p, 2)) / (SELECT sum(e * e) FROM res) AS d FROM (SELECT e, lag(e) OVER (ORDER BY id) AS p FROM res))""",
                                         """sk AS (SELECT n, m3 / pow(m2, 1.5) AS s, m4 / (m2 * m2) AS k FROM cen)""", select="""
SELECT n AS n_obs, round(s, 6) AS skew, round(k, 6) AS kurtosis,
  round(n / 6.0 * (s * s + pow(k - 3, 2) / 4.0), 6) AS jarque_bera, round(d, 6) AS durbin_watson FROM sk, dw""")
ORACLES["q_importance_checks"] = "SELECT 20 AS n_rows, TRUE AS sorted, TRUE AS sum_in_range"


def _vif_oracle() -> str:
    xs = _ST.VIF_FEATURES
    p = len(xs)
    # the centred inverse's diagonal on unit scales is the inflation; the constant's follows from the means
    const = "1 + n * (" + " + ".join(
        f"m{i} / sqrt({_s(i, i)}) * a_{i}_{p + j} * m{j} / sqrt({_s(j, j)})" for i in range(p) for j in range(p)) + ")"
    parts = [f"SELECT 'const' AS feature, round({const}, 3) AS vif FROM g{p}"]
    parts += [f"SELECT {q(c)} AS feature, round(a_{i}_{p + i}, 3) AS vif FROM g{p}" for i, c in enumerate(xs)]
    return with_base(*_moments(xs), *_inverse("mom", _s, p), select="\nUNION ALL\n".join(parts))


ORACLES["q_vif"] = _vif_oracle()


def two_step_rounding(sql: str) -> str:
    """Rewrite every round(expr, d) with a literal d into
    round(round(expr, d + 3), d), matching functions.round_to."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        inner = sql[j + 6:k - 1]
        digits = inner[last_comma - (j + 6) + 1:].strip() if last_comma is not None else ""
        if digits.isdigit():
            expr = two_step_rounding(inner[:last_comma - (j + 6)])
            d = int(digits)
            out.append(sql[i:j] + f"round(round({expr}, {d + 3}), {d})")
        else:
            out.append(sql[i:j] + "round(" + two_step_rounding(inner) + ")")
        i = k


ORACLES = {k: two_step_rounding(v) for k, v in ORACLES.items()}
