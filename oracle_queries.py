"""DuckDB SQL that gives the same rows as the registered queries, from the given tables.

Written from the definitions of the analysis, independently of the Spark code: plain
windows, joins and a bit-mask enumeration stand in for the distributed algorithms.
"""

from __future__ import annotations

# name, lat_min, lat_max, lon_min, lon_max in degrees (fixed values)
REGIONS = [
    ("Colosseo", 41.889, 41.891, 12.491, 12.494),
    ("Vaticano", 41.9, 41.906, 12.45, 12.46),
    ("Pantheon", 41.897, 41.899, 12.475, 12.478),
    ("FontanaTrevi", 41.9, 41.902, 12.482, 12.484),
    ("Trastevere", 41.886, 41.892, 12.465, 12.472),
    ("StazioneTermini", 41.9, 41.903, 12.498, 12.504),
    ("PiazzaNavona", 41.898, 41.9, 12.472, 12.474),
    ("PiazzaSpagna", 41.905, 41.907, 12.481, 12.484),
    ("VillaBorghese", 41.91, 41.918, 12.475, 12.495),
]
CITY_BOX = (41.6, 42.2, 12.2, 12.8)


def _micro(bounds) -> list[int]:
    return [round(b * 1_000_000) for b in bounds]


# The test photos lie on whole micro-degrees.
ROIS = [(name, *_micro(bounds)) for name, *bounds in REGIONS]
CITY = tuple(_micro(CITY_BOX))

_boxes = [r[1:] for r in ROIS] + [CITY, CITY]


def _list(values) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]"


def _coordinate(lo: int, hi: int, factor: int, outside: int) -> str:
    lows = _list(b[lo] for b in _boxes)
    spans = _list(b[hi] - b[lo] for b in _boxes)
    return f"""(CASE WHEN s = 11 THEN CASE event_id % 3 WHEN 0 THEN 0 WHEN 2 THEN {outside} END
        ELSE {lows}[s + 1] + ({spans}[s + 1] * ((event_id * {factor}) % 1001)) // 1000 END) / 1000000.0::DOUBLE"""


_RAW = f"""
slots AS (
    SELECT *, (event_id * 7 + user_id) % 12 AS s,
        CASE WHEN user_id % 3 = 0 THEN ts - to_days((event_id % 5800)::INTEGER) ELSE ts END AS t
    FROM events
),
raw AS (
    SELECT event_id, event_id::VARCHAR AS photo_id,
        CASE WHEN event_id % 97 = 0 THEN NULL
             WHEN user_id % 3 = 1 THEN 'u' || user_id || '-' || ((day(ts) - 1) // 7)
             ELSE 'u' || user_id END AS user_id,
        event_type || ' ' || event_id AS title,
        event_type,
        CASE WHEN event_id % 89 = 0 THEN 'not a date'
             WHEN event_id % 83 = 0 AND user_id % 10 = 0 THEN '0001-01-03 00:00:00'
             WHEN event_id % 2 = 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
             ELSE strftime(t, '%b %-d, %Y %-I:%M:%S %p') END AS taken,
        {_coordinate(0, 1, 7919, 45460000)} AS latitude,
        {_coordinate(2, 3, 104729, 9190000)} AS longitude
    FROM slots
),
flat AS (
    SELECT *, coalesce(try_strptime(taken, '%Y-%m-%d %H:%M:%S'),
                       try_strptime(taken, '%b %-d, %Y %-I:%M:%S %p')) AS ts
    FROM raw
)"""

_BOX = "latitude BETWEEN 41.6::DOUBLE AND 42.2::DOUBLE AND longitude BETWEEN 12.2::DOUBLE AND 12.8::DOUBLE"

_CLEAN = f"""
clean AS (
    SELECT * FROM flat
    WHERE user_id IS NOT NULL AND ts IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
      AND latitude <> 0 AND longitude <> 0 AND {_BOX}
)"""


def _deg(micro: int) -> str:
    return f"{micro / 1e6!r}::DOUBLE"


_DIM = "rois(priority, roi, lat_min, lat_max, lon_min, lon_max) AS (VALUES " + ", ".join(
    f"({i}, '{r[0]}', {_deg(r[1])}, {_deg(r[2])}, {_deg(r[3])}, {_deg(r[4])})" for i, r in enumerate(ROIS)
) + ")"

_ENRICHED = f"""
{_DIM},
enriched AS (
    SELECT c.*, coalesce(arg_min(r.roi, r.priority), 'Unknown') AS roi
    FROM clean c LEFT JOIN rois r
      ON c.latitude BETWEEN r.lat_min AND r.lat_max AND c.longitude BETWEEN r.lon_min AND r.lon_max
    GROUP BY ALL
),
known AS (SELECT * FROM enriched WHERE roi <> 'Unknown')"""

_TIMED = """
timed AS (
    SELECT *, hour(ts)::INTEGER AS hour, month(ts)::INTEGER AS month, (dayofweek(ts) + 1)::INTEGER AS day_of_week,
        dayname(ts) AS day_name, strftime(ts, '%Y') AS year, isodow(ts)::INTEGER AS day_idx
    FROM enriched
)"""

_PROFILES = """
stats AS (
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(photo_id) AS total_photos,
        count(DISTINCT roi) AS unique_rois, coalesce(stddev_samp(hour(ts)), 0) AS hour_stddev,
        date_diff('day', min(ts), max(ts))::INTEGER AS days_active
    FROM enriched GROUP BY user_id
),
profiles AS (
    SELECT *, total_photos / (days_active + 1) AS photos_per_day,
        CASE WHEN days_active > 30 OR unique_rois > 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
        CASE WHEN days_active > 30 THEN 'Resident' WHEN days_active <= 7 THEN 'Tourist'
             ELSE 'Recurring Visitor' END AS user_type
    FROM stats
)"""

_HEATMAP = """
heatmap AS (
    SELECT k.roi, hour(k.ts)::INTEGER AS hour, p.user_type, count(*) AS count
    FROM known k LEFT JOIN profiles p USING (user_id) GROUP BY ALL
)"""

_GEMS = """
sides AS (
    SELECT k.roi, count(*) FILTER (p.user_type = 'Tourist') AS Tourist,
        count(*) FILTER (p.user_type = 'Resident') AS Resident
    FROM known k LEFT JOIN profiles p USING (user_id) GROUP BY k.roi
),
gems AS (
    SELECT roi, Tourist, Resident, Tourist + Resident AS total,
        (Resident + 1) / (Tourist + Resident + 1) AS localness FROM sides
)"""

# Transactions as bit masks in name order; every non-empty subset of the regions is counted.
_ITEMSETS = """
named AS (SELECT roi, row_number() OVER (ORDER BY roi) - 1 AS bit FROM rois),
tx AS (
    SELECT user_id, sum(DISTINCT (1 << bit::INTEGER))::BIGINT AS mask
    FROM known JOIN named USING (roi) WHERE ts >= TIMESTAMP '2000-01-01' GROUP BY user_id
),
tx_count AS (SELECT count(*) AS n FROM tx),
tx_masks AS (SELECT mask, count(*) AS users FROM tx GROUP BY mask),
sets AS (
    SELECT s.mask, sum(t.users)::BIGINT AS freq
    FROM range(1, 512) AS s(mask) JOIN tx_masks t ON (t.mask & s.mask) = s.mask
    GROUP BY s.mask HAVING sum(t.users) >= (SELECT ceil(0.01::DOUBLE * n) FROM tx_count)
),
set_names AS (
    SELECT s.mask, s.freq, string_agg(n.roi, '|' ORDER BY n.roi) AS items, min(n.roi) AS first_item
    FROM sets s JOIN named n ON (s.mask >> n.bit::INTEGER) & 1 = 1 GROUP BY s.mask, s.freq
)"""

_RULES = """
rules AS (
    SELECT a.items AS antecedent, a.first_item, a.mask AS a_mask, n.roi AS consequent,
        w.freq / a.freq AS confidence,
        (w.freq / a.freq) / (o.freq / (SELECT n FROM tx_count)) AS lift,
        w.freq / (SELECT n FROM tx_count) AS support
    FROM set_names w
    JOIN named n ON (w.mask >> n.bit::INTEGER) & 1 = 1
    JOIN set_names a ON a.mask = w.mask - (1 << n.bit::INTEGER)
    JOIN set_names o ON o.mask = (1 << n.bit::INTEGER)
    WHERE w.freq / a.freq >= 0.05::DOUBLE
)"""

_LINKS = """
links AS (
    SELECT first_item AS source, consequent AS target, max(confidence) AS confidence, avg(lift) AS lift,
        sum(support) AS support
    FROM rules WHERE confidence >= 0.2::DOUBLE GROUP BY ALL
    ORDER BY round(max(confidence), 9) DESC, source, target LIMIT 20
),
nodes AS (
    SELECT node, (row_number() OVER (ORDER BY node) - 1)::INTEGER AS idx
    FROM (SELECT source AS node FROM links UNION SELECT target FROM links)
)"""

_NEXT = """
pairs AS (
    SELECT n.roi AS source, r.consequent AS target, r.confidence AS prob, r.lift
    FROM rules r JOIN named n ON (r.a_mask >> n.bit::INTEGER) & 1 = 1
    WHERE n.roi <> r.consequent
),
best AS (
    SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY prob DESC, lift DESC) AS pick FROM pairs
),
recs AS (
    SELECT source, target, prob, lift, row_number() OVER (
        PARTITION BY source ORDER BY round(prob, 9) DESC, round(lift, 9) DESC, target)::INTEGER AS rank
    FROM best WHERE pick = 1 QUALIFY rank <= 3
)"""

_TAGS = """
doc_words AS (SELECT doc_id, list_distinct(string_split(text, ' ')) AS words FROM documents),
tagged AS (
    SELECT p.*, CASE WHEN p.event_id % 17 = 0 THEN NULL WHEN p.event_id % 13 = 0 THEN []::VARCHAR[]
        ELSE coalesce(d.words, []) || ['Rome', upper(p.event_type)] END AS tags
    FROM {base} p LEFT JOIN doc_words d ON d.doc_id = p.event_id % (SELECT count(*) FROM documents)
)"""

_WORDS = """
word_counts AS (
    SELECT roi, word, count(*) AS count
    FROM (SELECT roi, lower(unnest(tags)) AS word FROM tagged)
    WHERE regexp_full_match(word, '[a-z]+')
      AND word NOT IN ('rome', 'roma', 'italy', 'italia', 'lazio', 'photo', 'flickr')
    GROUP BY ALL
)"""

_TILED = """
tiled AS (
    SELECT *, (floor((latitude - 41.6::DOUBLE) / 0.1::DOUBLE) * 7
             + floor((longitude - 12.2::DOUBLE) / 0.1::DOUBLE))::INTEGER AS cluster
    FROM enriched
)"""

_LABELS = """
tile_centres AS (
    SELECT cluster, avg(latitude) AS lat, avg(longitude) AS lon, count(*) AS photos FROM tiled GROUP BY cluster
),
tile_distances AS (
    SELECT c.*, r.roi, sqrt((c.lat - (r.lat_min + r.lat_max) / 2) * (c.lat - (r.lat_min + r.lat_max) / 2)
        + (c.lon - (r.lon_min + r.lon_max) / 2) * (c.lon - (r.lon_min + r.lon_max) / 2)) AS distance,
        r.priority
    FROM tile_centres c, rois r
),
labels_ AS (
    SELECT cluster, lat, lon, photos, CASE WHEN distance > 0.015::DOUBLE THEN 'Outer zone' ELSE roi END
        || ' (Cl. ' || cluster || ')' AS label
    FROM tile_distances
    QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY distance, priority) = 1
)"""

_PHOTO_COLUMNS = """photo_id, user_id, title, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, latitude, longitude,
    len(tags)::INTEGER AS n_tags, md5(list_sort(tags).array_to_string('|')) AS tags_md5"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_clean = _with(_RAW, _CLEAN)
_enriched = _with(_RAW, _CLEAN, _ENRICHED)
_timed = _with(_RAW, _CLEAN, _ENRICHED, _TIMED)
_profiles = _with(_RAW, _CLEAN, _ENRICHED, _PROFILES)
_rules = _with(_RAW, _CLEAN, _ENRICHED, _ITEMSETS, _RULES)
_tiled = _with(_RAW, _CLEAN, _ENRICHED, _TILED)
_words = _with(_RAW, _CLEAN, _ENRICHED, _TAGS.format(base="known"), _WORDS)

_CLEAN_PHOTOS = _with(_RAW, _CLEAN, _TAGS.format(base="clean")) + f" SELECT {_PHOTO_COLUMNS} FROM tagged"

_HEX = """
steps AS (
    SELECT (1.7320508075688772::DOUBLE / 3 * x - y / 3) / 20 AS q, (2.0::DOUBLE / 3 * y) / 20 AS r
    FROM (SELECT (longitude - 12.49::DOUBLE) * 82870.0::DOUBLE AS x,
                 (latitude - 41.89::DOUBLE) * 111320.0::DOUBLE AS y FROM known)
),
cubes AS (
    SELECT q, r, -q - r AS s, floor(q + 0.5::DOUBLE) AS rq, floor(r + 0.5::DOUBLE) AS rr,
        floor(-q - r + 0.5::DOUBLE) AS rs FROM steps
),
errors AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM cubes)"""

_SHOWN = """
shown AS (
    SELECT t.* FROM timed t JOIN profiles USING (user_id)
    WHERE year IN ('2023', '2024') AND month IN (1, 6, 12) AND user_type IN ('Resident', 'Tourist')
      AND roi IN ('Colosseo', 'Pantheon', 'Vaticano')
)"""
_shown = _with(_RAW, _CLEAN, _ENRICHED, _TIMED, _PROFILES, _SHOWN)
_PICKED = """
picked AS (
    SELECT * FROM timed WHERE year IN ('2023', '2024') AND roi IN ('Colosseo', 'Pantheon', 'Vaticano')
)"""
_picked = _with(_RAW, _CLEAN, _ENRICHED, _TIMED, _PICKED)

def _uniform(seed: str, column: str) -> str:
    return f"""CAST('0x' || substr(md5('{seed}|' || {column}), 1, 12) AS BIGINT) / 281474976710656::DOUBLE"""


_held_out = _profiles + f""", held_out AS (SELECT user_id, label, total_photos, {_uniform('0', 'user_id')} < 0.8::DOUBLE AS train FROM profiles)"""

_MANY = _with(_RAW, _CLEAN) + """, corners AS (
    SELECT o_orderkey AS k, 50::BIGINT << (o_orderkey % 13)::INTEGER AS side, 41600000 + o_orderkey * 7919 % 600000 AS south,
        12200000 + o_orderkey * 104729 % 600000 AS west FROM orders),
boxes AS (
    SELECT k, south / 1000000.0::DOUBLE AS lat_min, (south + side) / 1000000.0::DOUBLE AS lat_max,
        west / 1000000.0::DOUBLE AS lon_min, (west + side * (k % 3 + 1)) / 1000000.0::DOUBLE AS lon_max FROM corners),
first AS (
    SELECT photo_id, min(k) AS k FROM clean JOIN boxes ON latitude BETWEEN lat_min AND lat_max AND longitude BETWEEN lon_min AND lon_max
    GROUP BY photo_id)
SELECT photo_id, coalesce('o' || k, 'Unknown') AS roi FROM clean LEFT JOIN first USING (photo_id)"""

ORACLES: dict[str, str] = {
    "json_layout": """SELECT layout, count(*) AS records FROM events, (VALUES ('json_lines'), ('json_array')) AS l(layout)
        GROUP BY layout""",
    "schema_report": """SELECT * FROM (VALUES ('dateTaken', 'string'), ('geoData.latitude', 'double'),
        ('geoData.longitude', 'double'), ('id', 'string'), ('owner.id', 'string'), ('tags[].value', 'string'),
        ('title', 'string')) AS t(path, type)""",
    "json_clean_photos": _CLEAN_PHOTOS,
    "json_array_photos": _CLEAN_PHOTOS,
    "json_clean_aliases": _CLEAN_PHOTOS,
    "json_clean_text_coordinates": _CLEAN_PHOTOS,
    "alias_resolve": """SELECT 'other' AS "case", count(*) AS records, count(*) AS dated FROM events
        UNION ALL SELECT 'missing', count(*), 0 FROM events""",
    "clean_photos": _CLEAN_PHOTOS,
    "clean_report": _with(_RAW, f"""
reasons AS (
    SELECT CASE WHEN user_id IS NULL THEN 'no_user' WHEN ts IS NULL THEN 'bad_date'
        WHEN latitude IS NULL OR longitude IS NULL THEN 'no_position'
        WHEN latitude = 0 OR longitude = 0 THEN 'zero_position'
        WHEN NOT ({_BOX}) THEN 'outside_city' END AS reason FROM flat
)""") + """ SELECT count(*) AS raw, count(*) - count(reason) AS clean, count(reason) AS dropped,
        count(*) FILTER (reason = 'no_user') AS no_user, count(*) FILTER (reason = 'bad_date') AS bad_date,
        count(*) FILTER (reason = 'no_position') AS no_position,
        count(*) FILTER (reason = 'zero_position') AS zero_position,
        count(*) FILTER (reason = 'outside_city') AS outside_city,
        round(count(reason) * 100.0::DOUBLE / count(*), 6) AS drop_pct FROM reasons""",
    "clean_report_observed": _with(_RAW, f"""
reasons AS (
    SELECT CASE WHEN user_id IS NULL THEN 'no_user' WHEN ts IS NULL THEN 'bad_date'
        WHEN latitude IS NULL OR longitude IS NULL THEN 'no_position'
        WHEN latitude = 0 OR longitude = 0 THEN 'zero_position'
        WHEN NOT ({_BOX}) THEN 'outside_city' END AS reason FROM flat
)""") + """ SELECT count(*) AS raw, count(*) - count(reason) AS clean, count(reason) AS dropped,
        count(*) FILTER (reason = 'no_user') AS no_user, count(*) FILTER (reason = 'bad_date') AS bad_date,
        count(*) FILTER (reason = 'no_position') AS no_position,
        count(*) FILTER (reason = 'zero_position') AS zero_position,
        count(*) FILTER (reason = 'outside_city') AS outside_city,
        round(count(reason) * 100.0::DOUBLE / count(*), 6) AS drop_pct FROM reasons""",
    "geofence_filter": _with(_RAW) + f" SELECT photo_id, latitude, longitude FROM flat WHERE {_BOX}",
    "timestamp_parse": _with(_RAW) + " SELECT photo_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM flat",
    "enrich_many_boxes": _MANY,
    "enrich_many_boxes_shuffled": _MANY,
    "stream_hourly_roi": _enriched + """ SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, roi,
        count(*) AS count FROM known WHERE year(ts) > 1999 GROUP BY ALL""",
    "overview_sketch": _enriched + """, real AS (SELECT * FROM enriched WHERE year(ts) > 1999)
        SELECT roi, count(*) AS photos, count(DISTINCT user_id) AS users, true AS within FROM real GROUP BY roi
        UNION ALL SELECT 'all', count(*), count(DISTINCT user_id), true FROM real""",
    "table_round_trip": _enriched + """, counted AS (
        SELECT count(*) AS photos, count(DISTINCT roi) AS rois, count(DISTINCT year(ts)) AS years,
            count(*) FILTER (roi <> 'Unknown') AS known_photos, count(DISTINCT roi) FILTER (roi <> 'Unknown') AS known_rois,
            count(DISTINCT year(ts)) FILTER (roi <> 'Unknown') AS known_years FROM enriched)
        SELECT 'plain' AS "table", photos, rois, years FROM counted UNION ALL SELECT 'partitioned', photos, rois, years FROM counted
        UNION ALL SELECT 'replaced', known_photos, known_rois, known_years FROM counted UNION ALL SELECT 'missing', 0, 0, 0""",
    "rf_routes": _held_out + " SELECT user_id, label, true AS as_model FROM held_out WHERE NOT train",
    "rf_facts": _held_out + """ SELECT count(*) AS users, count(*) FILTER (label = 1) AS relevant, true AS better
        FROM held_out WHERE NOT train""",
    "split_counts": _held_out + """ SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, count(*) AS users,
        sum(total_photos)::BIGINT AS photos FROM held_out GROUP BY ALL""",
    "photo_sample": _enriched + f""" SELECT photo_id, roi FROM enriched WHERE {_uniform('1', 'photo_id')} < 0.2::DOUBLE""",
    "kmeans_facts": _enriched + " SELECT 10 AS clusters, count(*) AS photos, 0 AS strays, true AS centred FROM enriched",
    "silhouette_facts": "SELECT true AS as_evaluator, true AS in_range",
    "roi_enrich": _enriched + " SELECT photo_id, roi FROM enriched",
    "roi_enrich_grid": _enriched + " SELECT photo_id, roi FROM enriched",
    "roi_capture_stats": _enriched + """ SELECT count(*) AS total, count(*) FILTER (roi <> 'Unknown') AS mapped,
        round(count(*) FILTER (roi <> 'Unknown') / count(*), 6) AS mapped_share FROM enriched""",
    "roi_centroids": _enriched + """ SELECT r.roi, r.priority, round((lat_min + lat_max) / 2, 6) AS centre_lat,
        round((lon_min + lon_max) / 2, 6) AS centre_lon, count(k.photo_id) AS count
        FROM rois r LEFT JOIN known k USING (roi) GROUP BY ALL""",
    "top_rois": _enriched + " SELECT roi, count(*) AS count FROM known GROUP BY roi",
    "yearly_trend": _clean + """ SELECT year(ts)::INTEGER AS year, count(*) AS count FROM clean
        WHERE year(ts) > 1999 GROUP BY ALL""",
    "top_users": _clean + """ SELECT user_id, count(*) AS count FROM clean GROUP BY user_id
        ORDER BY count(*) DESC, user_id LIMIT 5""",
    "time_features": _timed + " SELECT photo_id, hour, month, day_of_week, day_name, year FROM timed",
    "user_profiles": _profiles + """ SELECT user_id, strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS first_seen,
        strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_seen, total_photos, unique_rois,
        round(hour_stddev, 6) AS hour_stddev, days_active, round(photos_per_day, 6) AS photos_per_day,
        label, user_type FROM profiles""",
    "overview_kpis": _enriched + """ SELECT count(*) AS photos, count(DISTINCT user_id) AS users,
        count(DISTINCT roi) FILTER (roi <> 'Unknown') AS rois,
        (min(year(ts)) FILTER (year(ts) >= 1500))::INTEGER AS first_year,
        (max(year(ts)) FILTER (year(ts) >= 1500))::INTEGER AS last_year FROM enriched""",
    "user_segments": _profiles + """ SELECT user_type, count(*) AS users,
        round(count(*) / (SELECT count(*) FROM profiles), 6) AS share FROM profiles GROUP BY user_type""",
    "days_active_hist": _profiles + """ SELECT (days_active // 13 * 13)::INTEGER AS bin_start, count(*) AS users
        FROM profiles WHERE days_active < 365 GROUP BY ALL""",
    "top_contributors": _profiles + """ SELECT user_id, user_type, total_photos, unique_rois, days_active
        FROM profiles ORDER BY total_photos DESC, user_id LIMIT 10""",
    "user_scatter_sample": _profiles + """ SELECT user_id, days_active, unique_rois, user_type, total_photos
        FROM profiles ORDER BY md5(user_id) LIMIT 5000""",
    "hourly_heatmap": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, _HEATMAP) + " SELECT * FROM heatmap",
    "od_matrix": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, """
moves AS (
    SELECT user_id, roi AS source, lead(roi) OVER (PARTITION BY user_id ORDER BY ts, roi) AS target FROM known
)""") + """ SELECT source, target, user_type, count(*) AS weight FROM moves LEFT JOIN profiles USING (user_id)
        WHERE target IS NOT NULL AND source <> target GROUP BY ALL""",
    "od_matrix_gap": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, """
moves AS (
    SELECT user_id, roi AS source, ts AS left_at, lead(roi) OVER w AS target, lead(ts) OVER w AS come_at
    FROM known WINDOW w AS (PARTITION BY user_id ORDER BY ts, roi)
)""") + """ SELECT source, target, user_type, count(*) AS weight FROM moves LEFT JOIN profiles USING (user_id)
        WHERE target IS NOT NULL AND source <> target AND come_at <= left_at + INTERVAL 6 HOUR GROUP BY ALL""",
    "user_stays": _enriched + """, opened AS (
        SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
        FROM enriched WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS stay FROM opened)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last,
        count(*) AS photos FROM numbered GROUP BY user_id, stay""",
    "hidden_gems": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, _GEMS) + """ SELECT roi, Tourist, Resident, total,
        round(localness, 6) AS localness_index FROM gems""",
    "peak_hour": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, _HEATMAP) + """ SELECT roi, hour AS peak_hour, count
        FROM heatmap QUALIFY row_number() OVER (PARTITION BY roi ORDER BY count DESC, hour) = 1""",
    "peak_hour_total": _enriched + """, hours AS (SELECT roi, hour(ts)::INTEGER AS peak_hour, count(*) AS count
        FROM known GROUP BY ALL) SELECT * FROM hours
        QUALIFY row_number() OVER (PARTITION BY roi ORDER BY count DESC, peak_hour) = 1""",
    "local_spots": _with(_RAW, _CLEAN, _ENRICHED, _PROFILES, _GEMS) + """ SELECT roi,
        round(localness, 6) AS localness_index FROM gems ORDER BY localness DESC, roi LIMIT 10""",
    "roi_tags": _words + """ SELECT roi, word, count FROM word_counts
        QUALIFY row_number() OVER (PARTITION BY roi ORDER BY count DESC, word) <= 20""",
    "roi_word_weights": _words + """, shown AS (
        SELECT roi, word, count, row_number() OVER (PARTITION BY roi ORDER BY count DESC, word)::INTEGER AS rank
        FROM word_counts QUALIFY rank <= 50)
        SELECT *, round(count / sum(count) OVER (PARTITION BY roi), 6) AS share FROM shown""",
    "user_transactions": _enriched + """ SELECT user_id, string_agg(DISTINCT roi, '|' ORDER BY roi) AS items
        FROM known WHERE year(ts) > 1999 GROUP BY user_id""",
    "freq_itemsets": _rules + " SELECT items, freq FROM set_names",
    # Spark compares the sorted item arrays; '!' sorts before every letter, as the end of an array does.
    "top_itemsets": _rules + """ SELECT items, freq FROM set_names
        ORDER BY freq DESC, replace(items, '|', '!') LIMIT 10""",
    "assoc_rules": _rules + """ SELECT antecedent, consequent, round(confidence, 6) AS confidence,
        round(lift, 6) AS lift, round(support, 6) AS support FROM rules""",
    "rules_top_lift": _rules + """ SELECT antecedent, consequent, round(confidence, 6) AS confidence,
        round(lift, 6) AS lift, round(support, 6) AS support FROM rules
        ORDER BY round(rules.lift, 9) DESC, replace(antecedent, '|', '!'), consequent LIMIT 10""",
    "rules_filtered": _rules + """ SELECT antecedent, consequent, round(rules.confidence, 6) AS confidence,
        round(rules.lift, 6) AS lift FROM rules WHERE rules.lift > 1 AND consequent <> 'Vaticano'
        ORDER BY round(rules.confidence, 9) DESC, replace(antecedent, '|', '!'), consequent LIMIT 10""",
    "flow_links": _rules + "," + _LINKS + """ SELECT source, target, round(l.confidence, 6) AS confidence,
        round(l.lift, 6) AS lift, round(l.support, 6) AS support,
        trunc(l.confidence * 100)::INTEGER AS thickness FROM links l""",
    "flow_nodes": _rules + "," + _LINKS + " SELECT node, idx FROM nodes",
    "flow_link_indices": _rules + "," + _LINKS + """ SELECT l.source, l.target, s.idx AS source_idx,
        t.idx AS target_idx, trunc(l.confidence * 100)::INTEGER AS thickness
        FROM links l JOIN nodes s ON s.node = l.source JOIN nodes t ON t.node = l.target""",
    "start_places": _rules + " SELECT DISTINCT n.roi AS source FROM rules r "
    "JOIN named n ON (r.a_mask >> n.bit::INTEGER) & 1 = 1",
    "next_step": _rules + "," + _NEXT + """ SELECT source, rank, target, round(r.prob, 6) AS prob,
        round(r.lift, 6) AS lift FROM recs r""",
    "next_step_arcs": _rules + "," + _NEXT + """ SELECT c.source, c.rank, c.target, round(c.prob, 6) AS prob,
        round(c.lift, 6) AS lift, round(c.prob * 15, 6) AS width, c.prob > 0.25::DOUBLE AS strong,
        round((s.lat_min + s.lat_max) / 2, 6) AS source_lat, round((s.lon_min + s.lon_max) / 2, 6) AS source_lon,
        round((t.lat_min + t.lat_max) / 2, 6) AS target_lat, round((t.lon_min + t.lon_max) / 2, 6) AS target_lon
        FROM recs c JOIN rois s ON s.roi = c.source JOIN rois t ON t.roi = c.target""",
    "hexbin_density": _enriched + "," + _HEX + """ SELECT
        (CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END)::BIGINT AS hq,
        (CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END)::BIGINT AS hr,
        count(*) AS count FROM errors GROUP BY ALL""",
    "roi_centres": _enriched + """ SELECT roi, round(avg(latitude) + 1e-10, 6) AS lat, round(avg(longitude) + 1e-10, 6) AS lon,
        count(*) AS count FROM known GROUP BY roi""",
    "top_label_centres": _enriched + """ SELECT roi, round(avg(latitude) + 1e-10, 6) AS lat,
        round(avg(longitude) + 1e-10, 6) AS lon, count(*) AS count FROM known GROUP BY roi
        ORDER BY count(*) DESC, roi LIMIT 50""",
    "view_centre": _enriched + """ SELECT round(coalesce(avg(latitude), 41.89) + 1e-10, 6) AS lat,
        round(coalesce(avg(longitude), 12.49) + 1e-10, 6) AS lon, count(*) AS count FROM known""",
    "map_sample": _enriched + """ SELECT photo_id, latitude, longitude, roi FROM known
        ORDER BY md5(photo_id) LIMIT 4000""",
    "filtered_map": _with(_RAW, _CLEAN, _ENRICHED, _TIMED, _PROFILES) + """ SELECT roi, year, month, user_type,
        count(*) AS count FROM timed JOIN profiles USING (user_id)
        WHERE year IN ('2023', '2024') AND month IN (1, 6, 12) AND user_type IN ('Resident', 'Tourist')
          AND roi IN ('Colosseo', 'Pantheon', 'Vaticano') GROUP BY ALL""",
    "hexbin_filtered": _shown + "," + _HEX.replace("FROM known", "FROM shown") + """ SELECT
        (CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END)::BIGINT AS hq,
        (CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END)::BIGINT AS hr,
        count(*) AS count FROM errors GROUP BY ALL""",
    "roi_centres_filtered": _shown + """ SELECT roi, round(avg(latitude) + 1e-10, 6) AS lat,
        round(avg(longitude) + 1e-10, 6) AS lon, count(*) AS count FROM shown GROUP BY roi""",
    "view_centre_filtered": _shown + """ SELECT round(coalesce(avg(latitude), 41.89) + 1e-10, 6) AS lat,
        round(coalesce(avg(longitude), 12.49) + 1e-10, 6) AS lon, count(*) AS count FROM shown""",
    "map_counts_filtered": _shown + " SELECT count(*) AS matching, least(count(*), 50) AS drawn FROM shown",
    "month_roi_filtered": _picked + " SELECT month, roi, count(*) AS count FROM picked GROUP BY ALL",
    "hour_roi_filtered": _picked + " SELECT hour, roi, count(*) AS count FROM picked GROUP BY ALL",
    "weekday_filtered": _picked + """, days AS (SELECT unnest(range(1, 8))::INTEGER AS day_idx)
        SELECT day_idx, dayname(DATE '2023-12-31' + day_idx) AS day_name, count(photo_id) AS count
        FROM days LEFT JOIN picked USING (day_idx) GROUP BY ALL""",
    "day_hour_filtered": _picked + """, cells AS (
        SELECT d::INTEGER AS day_idx, h::INTEGER AS hour FROM range(1, 8) AS a(d), range(24) AS b(h))
        SELECT day_idx, dayname(DATE '2023-12-31' + day_idx) AS day_name, hour, count(photo_id) AS count
        FROM cells LEFT JOIN picked USING (day_idx, hour) GROUP BY ALL""",
    "user_scatter_cut": _profiles + """ SELECT user_id, user_type, total_photos FROM profiles
        ORDER BY md5(user_id) LIMIT 100""",
    "cluster_focus": _tiled + """ SELECT cluster, round(avg(latitude) + 1e-10, 6) AS lat,
        round(avg(longitude) + 1e-10, 6) AS lon, count(*) AS photos FROM tiled WHERE cluster = 16 GROUP BY cluster""",
    "month_roi": _timed + " SELECT month, roi, count(*) AS count FROM timed WHERE roi <> 'Unknown' GROUP BY ALL",
    "hour_roi": _timed + " SELECT hour, roi, count(*) AS count FROM timed WHERE roi <> 'Unknown' GROUP BY ALL",
    "weekday_counts": _timed + """, days AS (SELECT unnest(range(1, 8))::INTEGER AS day_idx)
        SELECT day_idx, dayname(DATE '2023-12-31' + day_idx) AS day_name, count(photo_id) AS count
        FROM days LEFT JOIN (SELECT * FROM timed WHERE roi <> 'Unknown') USING (day_idx) GROUP BY ALL""",
    "day_hour_grid": _timed + """, cells AS (
        SELECT d::INTEGER AS day_idx, h::INTEGER AS hour FROM range(1, 8) AS a(d), range(24) AS b(h))
        SELECT day_idx, dayname(DATE '2023-12-31' + day_idx) AS day_name, hour, count(photo_id) AS count
        FROM cells LEFT JOIN (SELECT * FROM timed WHERE roi <> 'Unknown') USING (day_idx, hour) GROUP BY ALL""",
    "filter_values": _timed + """ SELECT DISTINCT "column", value FROM (
        SELECT 'year' AS "column", year AS value FROM timed WHERE roi <> 'Unknown'
        UNION ALL SELECT 'month', month::VARCHAR FROM timed WHERE roi <> 'Unknown'
        UNION ALL SELECT 'roi', roi FROM timed WHERE roi <> 'Unknown')""",
    "default_rois": _enriched + " SELECT DISTINCT roi FROM known ORDER BY roi LIMIT 2",
    "cluster_silhouette": _tiled + """, sums AS (
        SELECT cluster, count(*) AS n, avg(latitude) AS m_lat, avg(longitude) AS m_lon,
            var_pop(latitude) + var_pop(longitude) AS spread FROM tiled GROUP BY cluster),
    costs AS (
        SELECT t.photo_id, t.cluster AS own, s.cluster AS other, s.n,
            (t.latitude - s.m_lat) * (t.latitude - s.m_lat) + (t.longitude - s.m_lon) * (t.longitude - s.m_lon)
            + s.spread AS mean_cost
        FROM tiled t, sums s),
    sides AS (
        SELECT photo_id, max(n) FILTER (own = other) AS n,
            max(mean_cost * n / nullif(n - 1, 0)) FILTER (own = other) AS a,
            min(mean_cost) FILTER (own <> other) AS b FROM costs GROUP BY photo_id)
    SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 4)
        AS silhouette FROM sides""",
    "cluster_sizes": _tiled + " SELECT cluster, count(*) AS count FROM tiled GROUP BY cluster",
    "cluster_centres": _tiled + """ SELECT cluster, round(avg(latitude) + 1e-10, 6) AS lat,
        round(avg(longitude) + 1e-10, 6) AS lon, count(*) AS photos FROM tiled GROUP BY cluster""",
    "nearest_centre_assign": _enriched + """ SELECT e.photo_id, arg_min(r.priority, [
        sqrt((e.latitude - (r.lat_min + r.lat_max) / 2) * (e.latitude - (r.lat_min + r.lat_max) / 2)
           + (e.longitude - (r.lon_min + r.lon_max) / 2) * (e.longitude - (r.lon_min + r.lon_max) / 2)),
        r.priority])::INTEGER AS cluster FROM enriched e, rois r GROUP BY e.photo_id""",
    "cluster_labels": _tiled + "," + _LABELS + """ SELECT cluster, label, round(lat + 1e-10, 6) AS lat,
        round(lon + 1e-10, 6) AS lon, photos FROM labels_""",
    "cluster_points_sample": _tiled + "," + _LABELS + """, shown AS (
        SELECT photo_id, latitude, longitude, cluster FROM tiled ORDER BY md5(photo_id) LIMIT 4000)
        SELECT s.cluster, photo_id, latitude, longitude, label FROM shown s LEFT JOIN labels_ USING (cluster)""",
    "exec_summary": _tiled + """, yearly AS (
        SELECT strftime(ts, '%Y') AS year, count(*) AS value FROM enriched GROUP BY ALL)
    SELECT 'total_photos' AS section, 1 AS rank, NULL::VARCHAR AS name, count(*) AS value,
        NULL::DOUBLE AS share FROM tiled
    UNION ALL (SELECT 'top_cluster', (row_number() OVER (ORDER BY count(*) DESC, cluster))::INTEGER,
        cluster::VARCHAR, count(*), round(count(*) / (SELECT count(*) FROM tiled), 6)
        FROM tiled GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT 3)
    UNION ALL SELECT 'mapped_photos', 1, NULL, count(*), NULL FROM known
    UNION ALL (SELECT 'top_roi', (row_number() OVER (ORDER BY count(*) DESC, roi))::INTEGER, roi, count(*), NULL
        FROM known GROUP BY roi ORDER BY count(*) DESC, roi LIMIT 3)
    UNION ALL (SELECT 'peak_year', 1, year, value, NULL FROM yearly ORDER BY value DESC, year LIMIT 1)
    UNION ALL SELECT 'top_user', 1, NULL, max(n), NULL
        FROM (SELECT count(*) AS n FROM enriched GROUP BY user_id)""",
}

ORACLES["exact_silhouette"] = ORACLES["cluster_silhouette"]

# Monotone chains over whole micro-degrees: a stack per cluster and way, one step a round.
ORACLES["cluster_hulls"] = "WITH RECURSIVE " + _tiled.removeprefix("WITH ") + """, spots AS (
    SELECT DISTINCT cluster, round(longitude * 1000000)::BIGINT AS x, round(latitude * 1000000)::BIGINT AS y, longitude, latitude FROM tiled),
ways AS MATERIALIZED (
    SELECT cluster, way, x, y, row_number() OVER (PARTITION BY cluster, way ORDER BY x * way, y * way) AS i
    FROM spots, (VALUES (1), (-1)) w(way)),
chain AS (
    SELECT DISTINCT cluster, way, 1::BIGINT AS i, CAST([] AS BIGINT[][]) AS stack FROM ways
    UNION ALL
    SELECT cluster, way, i + (NOT turns)::BIGINT, CASE WHEN turns THEN stack[:len(stack) - 1] ELSE list_append(stack, [x, y]) END
    FROM (SELECT c.*, w.x, w.y, coalesce(len(stack) > 1 AND
            (stack[-1][1] - stack[-2][1]) * (w.y - stack[-2][2]) - (stack[-1][2] - stack[-2][2]) * (w.x - stack[-2][1]) <= 0, false) AS turns
          FROM chain c JOIN ways w USING (cluster, way, i))),
ends AS (
    SELECT c.cluster, c.way, stack[:len(stack) - 1] AS part FROM chain c
    JOIN (SELECT cluster, way, count(*) AS n FROM ways GROUP BY ALL) t ON c.cluster = t.cluster AND c.way = t.way AND c.i = t.n + 1),
rings AS (
    SELECT cluster, list_concat(max(part) FILTER (way = 1), max(part) FILTER (way = -1)) AS ring FROM ends GROUP BY cluster),
corners AS (SELECT cluster, unnest(ring) AS corner, unnest(range(len(ring)))::INTEGER AS idx FROM rings WHERE len(ring) > 2)
SELECT c.cluster, idx, longitude AS lon, latitude AS lat FROM corners c JOIN spots s ON s.cluster = c.cluster AND s.x = corner[1] AND s.y = corner[2]
WHERE c.cluster IN (SELECT cluster FROM tiled GROUP BY cluster HAVING count(*) > 3)"""
