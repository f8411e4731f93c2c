"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: the derived tables are restated as
CTEs over the pre-registered test views, and the jobs in their most direct
form (brute-force ``contains`` joins, ``row_number`` for "first"/"last").
"""

from __future__ import annotations

TRACK = "p_name || CASE WHEN p_partkey % 4 = 0 THEN ', pt. ' ELSE ' ' END || CAST(p_partkey // 4 AS VARCHAR)"
ARTIST = "p_brand || CASE WHEN p_partkey % 5 = 0 THEN ', Jr.' ELSE '' END"

CHART = f"""
chart AS (
  SELECT CAST(row_number() OVER (PARTITION BY date, region ORDER BY streams DESC, track, artist) AS INTEGER) AS position,
         track, artist, streams,
         'https://charts.invalid/' || region || '/' || date || '?t=' || track || ',' || artist AS url,
         date, region
  FROM (SELECT {TRACK} AS track, {ARTIST} AS artist, strftime(o_orderdate, '%Y-%m-01') AS date, n_name AS region,
               CAST(sum(l_quantity) AS BIGINT) AS streams
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2, 3, 4) daily
)"""

EXT = f"""
ext AS (
  SELECT p_partkey * 10 AS ord, {ARTIST} AS artist, {TRACK} || CASE WHEN p_partkey % 3 = 0 THEN ' (live)' ELSE '' END AS song,
         CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 7 = 0 THEN '' ELSE n_name END AS country,
         CASE WHEN p_size % 11 = 0 OR p_size % 5 = 0 THEN NULL ELSE r_name END AS starting_place
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT o_orderkey * 10 + 1, 'Brand#' || CAST(o_orderkey % 60 AS VARCHAR) || ' and friends',
         'small red ring ' || CAST(o_orderkey AS VARCHAR), 'ORDER', o_orderpriority FROM orders
)"""

# Brute force: every (needle, extension row) pair tested, last eligible match kept.
BEST_MATCH = """
needles AS (SELECT DISTINCT lower(artist) AS la, lower(track) AS lt FROM chart),
matches AS (
  SELECT la, lt, e.country, coalesce(e.starting_place, 'NONE') AS begin_area,
         row_number() OVER (PARTITION BY la, lt ORDER BY e.ord DESC) AS rn
  FROM needles JOIN ext e ON contains(lower(e.artist), la) AND contains(lower(e.song), lt)
  WHERE e.country IS NOT NULL
),
best AS (SELECT la, lt, country, begin_area FROM matches WHERE rn = 1)"""

HOT_NEEDLES = """SELECT DISTINCT 'brand#' || (p_partkey // 7) % 66 AS la,
  'small red ring ' || substr(CAST(p_partkey AS VARCHAR), 1, CAST(p_partkey % 3 AS INTEGER)) AS lt FROM part"""

ENRICHED = """
enriched AS (
  SELECT c.position, replace(c.track, ',', '') AS track, replace(c.artist, ',', '') AS artist, c.streams,
         replace(c.url, ',', '') AS url, replace(c.date, ',', '') AS date, replace(c.region, ',', '') AS region,
         coalesce(b.country, 'NONE') AS country, coalesce(b.begin_area, 'NONE') AS begin_area
  FROM chart c LEFT JOIN best b ON lower(c.artist) = b.la AND lower(c.track) = b.lt
)"""

LINES = """
lines AS (
  SELECT replace(value, ', ', ',  ') || repeat(' ', CAST(length(value) % 3 AS INTEGER)) AS value
  FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
)"""

SUP = """
sup AS (
  SELECT s_suppkey, s_name,
         s_name || ' & ' || repeat('x', CAST(s_suppkey % 4 AS INTEGER)) AS nm,
         CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE n_name END AS country,
         CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE r_name END AS begin_area,
         substr(s_name, 1, 17) AS prefix, CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS arid,
         CASE WHEN s_suppkey % 20 < 10 THEN substr(s_name, 1, 17) ELSE lower(substr(s_name, 1, 17)) END AS req_artist
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

REQUESTS = """
requests AS (
  SELECT DISTINCT artist, song FROM (
    SELECT s.req_artist AS artist, split_part(p_name, ' ', 2) AS song
      FROM sup s JOIN lineitem ON l_suppkey = s.s_suppkey JOIN part ON l_partkey = p_partkey
    UNION ALL SELECT req_artist, 'zzz' FROM sup
    UNION ALL SELECT lower(nm), 'ring' FROM sup
    UNION ALL SELECT lower(nm), 'zzz' FROM sup
    UNION ALL SELECT 'Nobody & ' || r_name, 'ring' FROM region
  ) r
)"""

AHITS = """
ahits AS (
  SELECT lower(prefix) AS query, s_suppkey AS ord, rtrim(nm) AS name, country, arid, begin_area
  FROM sup
  UNION ALL
  SELECT 'supplier#' || lpad(CAST(s_suppkey // 10 + 1 AS VARCHAR), 8, '0'), s_suppkey, rtrim(nm), country, arid, begin_area
  FROM sup
  UNION ALL
  SELECT replace(replace(lower(nm), '&', ''), '  ', ' '), s_suppkey, rtrim(nm), country, arid, begin_area
  FROM sup
)"""

WHITS = """
works AS (
  SELECT DISTINCT split_part(p_name, ' ', 2) AS query, l_suppkey AS ord, p_name AS title
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query, ord // 100 ORDER BY ord, title) - 1 AS INTEGER) AS pos FROM works
),
whits AS (
  SELECT query, ord, pos, 0 AS item, CAST(ord AS VARCHAR) AS arid, 'Artist ' || CAST(ord AS VARCHAR) AS name, title FROM numbered
  UNION ALL SELECT query, ord, pos, 1, '', 'Anon', title FROM numbered WHERE ord % 7 = 0
)"""

# Every candidate x work pair of a request, filtered and scored as stated.
BACKED = """
rq AS (SELECT artist, song, replace(replace(lower(artist), '&', ''), '  ', ' ') AS a, lower(song) AS s FROM requests),
backed AS (
  SELECT r.artist, r.song, h.arid, h.name, h.country, h.begin_area,
         abs(length(lower(h.name)) - length(r.a)) + abs(length(lower(w.title)) - length(r.s)) AS score,
         h.ord AS a_ord, w.ord AS w_ord, w.title AS w_title
  FROM rq r
  JOIN ahits h ON h.query = r.a
  JOIN whits w ON w.query = r.s AND w.arid = h.arid
  WHERE contains(lower(h.name), r.a) AND contains(lower(w.title), r.s)
),
just_artist AS (
  SELECT r.artist, r.song, h.arid, h.name, h.country, h.begin_area,
         abs(length(lower(h.name)) - length(r.artist)) AS score, h.ord AS a_ord
  FROM rq r JOIN ahits h ON h.query = r.a
  WHERE contains(lower(h.name), r.a) OR contains(lower(h.name), r.artist)
)"""


RESOLVED = """
resolved AS (
  SELECT q.artist, q.song, coalesce(x.name, '') AS result_artist, coalesce(x.country, '') AS country,
         coalesce(x.begin_area, '') AS starting_place
  FROM requests q LEFT JOIN (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY artist, song ORDER BY tier, score, a_ord, w_ord, w_title) AS rn
      FROM (SELECT artist, song, name, country, begin_area, 0 AS tier, score, a_ord, w_ord, w_title FROM backed
            UNION ALL
            SELECT artist, song, name, country, begin_area, 1, score, a_ord, NULL, NULL FROM just_artist) u
    ) r WHERE rn = 1
  ) x ON q.artist = x.artist AND q.song = x.song
)"""

# End-to-end: the chart's own pairs resolved against candidates derived for
# them, and the resolved pairs (in (artist, song) order) used as origins.
CHAIN_INPUTS = f"""
requests AS (SELECT DISTINCT artist, track AS song FROM chart),
ahits AS (
  SELECT lower('Brand#' || CAST(s_suppkey % 25 + 1 AS VARCHAR) || suffix) AS query, s_suppkey AS ord,
         'Brand#' || CAST(s_suppkey % 25 + 1 AS VARCHAR) || suffix || ' & ' || s_name AS name, country, arid, begin_area
  FROM sup, (VALUES (''), (', Jr.')) AS v(suffix)
),
whits AS (
  SELECT DISTINCT lower({TRACK}) AS query, l_suppkey AS ord, CAST(l_suppkey AS VARCHAR) AS arid,
         'Artist ' || CAST(l_suppkey AS VARCHAR) AS name, {TRACK} AS title
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

CHAIN_EXT = f"""
ext AS (
  SELECT row_number() OVER (ORDER BY artist, song) AS ord, artist, song, country, starting_place FROM resolved
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


def _chart_report(where: str, key: str, value: str, top: bool = False) -> str:
    limit = f"\nORDER BY {value.split(' AS ')[-1]} DESC, {key.split(' AS ')[-1]} LIMIT 10" if top else ""
    return _with(CHART) + f"SELECT {value}, {key} FROM chart WHERE {where} GROUP BY 2{limit}"


_Q1 = ("position = 1 AND contains(date, '1997')", "track || '#' || artist AS label",
       "CAST(count(*) AS BIGINT) AS n")
_Q4 = ("region = 'NATION_7'", "artist", "CAST(sum(streams) AS BIGINT) AS streams")

ORACLES: dict[str, str] = {
    "top_position_counts": _chart_report(*_Q1),
    "top_position_counts_top10": _chart_report(*_Q1, top=True),
    "top_songs_on_date": _chart_report("date = '1997-12-01'", "track || '#' || artist AS label",
                                       "CAST(sum(streams) AS BIGINT) AS streams"),
    "top_songs_region_date": _chart_report("date = '1997-09-01' AND region = 'NATION_7'",
                                           "track || '#' || artist AS label",
                                           "CAST(sum(streams) AS BIGINT) AS streams"),
    "top_artists_region": _chart_report(*_Q4),
    "top_artists_region_top10": _chart_report(*_Q4, top=True),
    "series_mean": (
        "SELECT event_type || '#' || CAST(user_id AS VARCHAR) AS label, round(avg(value), 6) AS mean_rating\n"
        "FROM events WHERE event_type = 'purchase' AND props <> '{\"k\": 69}'\n"
        "GROUP BY event_type, user_id"
    ),
    "word_count": _with(LINES) + (
        "SELECT word, CAST(count(*) AS BIGINT) AS n\n"
        "FROM (SELECT unnest(string_split(value, ' ')) AS word FROM lines) w GROUP BY word"
    ),
    "word_count_trimmed": _with(LINES) + (
        "SELECT word, CAST(count(*) AS BIGINT) AS n FROM (\n"
        "  SELECT unnest(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]\n"
        "                     ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM lines) w\n"
        "GROUP BY word"
    ),
    "distinct_pairs": _with(CHART) + "SELECT DISTINCT artist, track AS song FROM chart",
    "flatten_artists": _with(SUP, AHITS) + (
        "SELECT query, ord // 100 AS page,\n"
        "       CAST(row_number() OVER (PARTITION BY query, ord // 100 ORDER BY ord) - 1 AS INTEGER) AS pos,\n"
        "       name, country, arid, begin_area FROM ahits"
    ),
    "flatten_works": _with(WHITS) + (
        "SELECT query, ord // 100 AS page, pos, CAST(item AS INTEGER) AS item, arid, name, title FROM whits"
    ),
    "related_works": _with(SUP, REQUESTS, AHITS, WHITS, BACKED) + (
        "SELECT artist, song, arid, CAST(score AS INTEGER) AS score, name AS result_artist, country,\n"
        "       begin_area AS starting_place\n"
        "FROM (SELECT *, row_number() OVER (PARTITION BY artist, song, arid ORDER BY score, a_ord, w_ord, w_title) AS rn\n"
        "      FROM backed) b WHERE rn = 1"
    ),
    "resolve_pairs": _with(SUP, REQUESTS, AHITS, WHITS, BACKED, RESOLVED) + "SELECT * FROM resolved",
    "containment_match": _with(CHART, EXT, BEST_MATCH) + "SELECT la, lt, country, begin_area FROM best",
    "hot_key_match": _with(EXT, BEST_MATCH.replace("SELECT DISTINCT lower(artist) AS la, lower(track) AS lt FROM chart", HOT_NEEDLES))
    + "SELECT la, lt, country, begin_area FROM best",
    "enrich_ranking": _with(CHART, EXT, BEST_MATCH, ENRICHED) + "SELECT * FROM enriched",
    "enrich_artist_totals": _with(CHART, EXT, BEST_MATCH, ENRICHED) + (
        "SELECT CAST(sum(streams) AS BIGINT) AS streams, artist FROM enriched WHERE region = 'NATION_7' GROUP BY artist"
    ),
    "enrich_origin_totals": _with(CHART, EXT, BEST_MATCH, ENRICHED) + (
        "SELECT country, begin_area, CAST(sum(streams) AS BIGINT) AS streams, CAST(count(*) AS BIGINT) AS n\n"
        "FROM enriched WHERE region = 'NATION_7' GROUP BY country, begin_area"
    ),
    "enrich_from_resolved": _with(CHART, SUP, CHAIN_INPUTS, BACKED, RESOLVED, CHAIN_EXT, BEST_MATCH, ENRICHED)
    + "SELECT * FROM enriched",
    "strip_commas": _with(CHART) + (
        "SELECT position, replace(track, ',', '') AS track, replace(artist, ',', '') AS artist, streams,\n"
        "       replace(url, ',', '') AS url, replace(date, ',', '') AS date, replace(region, ',', '') AS region\n"
        "FROM chart"
    ),
}

# Written, then read back.
ORACLES["report_headerless_parts"] = ORACLES["top_position_counts"]
ORACLES["report_tuples_read_back"] = (
    "SELECT '(' || CAST(streams AS VARCHAR) || ',' || artist || ')' AS value FROM (" + ORACLES["top_artists_region"] + ") r")
ORACLES["mean_tuples_read_back"] = "SELECT '(' || word || ',' || CAST(n AS VARCHAR) || ')' AS value FROM (" + ORACLES["word_count"] + ") r"
ORACLES["resolved_parts_read_back"] = _with(SUP, REQUESTS, AHITS, WHITS, BACKED, RESOLVED) + (
    "SELECT " + ", ".join(f"replace({c}, ',', '') AS {c}" for c in ("artist", "song", "result_artist", "country", "starting_place"))
    + " FROM resolved")
ODD_ROWS = """
  SELECT CAST(p_partkey AS VARCHAR) AS position, ' "' || p_name || '",  ' AS track,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand || '  ' END AS artist, CAST(p_size AS VARCHAR) AS streams,
         CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ' ' END AS url, 'a""b' AS date, '"' AS region,
         p_type AS country, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' x' END AS begin_area
  FROM part"""
ORACLES["odd_rows_read_back"] = ODD_ROWS
ORACLES["ragged_lines"] = """
SELECT CASE p_partkey % 5 WHEN 2 THEN p_name || ', "x"' WHEN 3 THEN p_name || '" mix' ELSE p_name END AS a,
       CASE p_partkey % 5 WHEN 0 THEN p_brand WHEN 2 THEN p_brand WHEN 3 THEN '' END AS b,
       CAST(CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 2 END AS INTEGER) AS width
FROM part WHERE p_partkey % 5 <> 4"""

# The file-fed variants compute the same results; text files carry position
# and streams as text.
ORACLES["top_position_counts_from_csv"] = ORACLES["top_position_counts"]
ORACLES["series_mean_from_tsv"] = ORACLES["series_mean"]
ORACLES["word_count_from_text"] = ORACLES["word_count"]
ORACLES["enrich_ranking_from_files"] = _with(CHART, EXT, BEST_MATCH, ENRICHED) + (
    "SELECT CAST(position AS VARCHAR) AS position, track, artist, CAST(streams AS VARCHAR) AS streams,\n"
    "       url, date, region, country, begin_area FROM enriched"
)

ORACLES["flatten_works_from_dump"] = ORACLES["flatten_works"]
# A line break of any kind is read as one "\n".
ORACLES["texts_with_line_breaks"] = (
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS text FROM documents")
ORACLES["extension_skipping_two"] = _with(EXT) + (
    "SELECT artist, song, coalesce(country, '') AS country, coalesce(starting_place, '') AS starting_place FROM ext")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
