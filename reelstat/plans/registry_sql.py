"""SQL each registered query is checked against, written independently of the operators, for DuckDB."""

from __future__ import annotations

import hashlib

from reelstat.plans.registry import AS_OF, DAY, HMAC_KEY, NEXT_DAY

_BLOCK = HMAC_KEY.encode().ljust(64, b"\0")
assert len(_BLOCK) == 64 and hashlib.sha256().block_size == 64


def _hmac(column: str) -> str:
    inner = bytes(b ^ 0x36 for b in _BLOCK).hex()
    outer = bytes(b ^ 0x5C for b in _BLOCK).hex()
    return (
        f"CASE WHEN {column} <> '' THEN "
        f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({column})))) END"
    )


_CTES = {
    "visitors_flat": """
        SELECT CAST(ts AS DATE) AS dt, json_extract_string(props, '$.k') AS media_id,
               CAST(user_id AS VARCHAR) AS visitor_key,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS load_count,
               CASE WHEN event_type IN ('view', 'purchase') THEN CAST(floor(value / 2) AS BIGINT) ELSE 0 END AS play_count,
               CASE WHEN event_type <> 'click' THEN c_name END AS name,
               CASE WHEN event_type = 'signup' THEN lower(c_mktsegment) || '@example.com' END AS email
        FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "silver_visitors": """
        SELECT dt, media_id, visitor_key, max(load_count) AS load_count, max(play_count) AS play_count,
               max(name) AS name, max(email) AS email
        FROM visitors_flat GROUP BY dt, media_id, visitor_key""",
    "fact": """
        SELECT dt, media_id, CAST(sum(load_count) AS BIGINT) AS loads, CAST(sum(play_count) AS BIGINT) AS plays,
               count(DISTINCT visitor_key) AS unique_visitors,
               CASE WHEN sum(load_count) > 0 THEN CAST(sum(play_count) AS DOUBLE) / sum(load_count) ELSE 0.0 END AS play_rate
        FROM silver_visitors GROUP BY dt, media_id""",
    "media_flat": """
        SELECT CAST(p_partkey AS VARCHAR) AS media_id, p_name AS name, CAST(p_size * 60 AS DOUBLE) AS duration_s,
               CAST(CAST(l_shipdate AS DATE) - l_linenumber AS TIMESTAMP) AS created_at,
               CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS updated_at,
               l_linestatus AS status, l_returnflag = 'R' AS archived, p_type AS section,
               CAST(split_part(p_brand, '#', 2) AS BIGINT) AS project_id, p_brand AS project_name,
               'https://img.example/' || p_partkey AS thumbnail_url, round(1 - l_discount, 9) AS progress,
               CAST(l_shipdate AS DATE) AS dt
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "snapshot": """
        SELECT * EXCLUDE (dt, rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY media_id
                ORDER BY updated_at DESC NULLS LAST, dt DESC, name DESC, duration_s DESC, created_at DESC, status DESC,
                         archived DESC, section DESC, project_id DESC, project_name DESC, thumbnail_url DESC, progress DESC
            ) AS rn FROM media_flat
        ) WHERE rn = 1""",
    "dim": "SELECT * RENAME (name AS title) FROM snapshot",
    "events_flat": f"""
        SELECT CAST(ts AS DATE) AS dt, event_id, ts, user_id,
               CASE WHEN event_id % 31 <> 0 THEN 'e' || (event_id // 2) END AS event_key,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS received_at, event_type,
               CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 <> 0 THEN json_extract_string(props, '$.k') END AS media_id,
               CASE WHEN event_type = 'error' THEN ''
                    WHEN event_type <> 'signup' THEN '10.0.' || (user_id % 256) || '.1' END AS ip,
               CASE WHEN event_id % 41 <> 0 THEN ts END AS "at",
               CASE WHEN event_id % 43 <> 0 THEN value END AS position_s,
               CASE WHEN event_id % 53 <> 0 THEN value / 500 END AS percent_viewed,
               CASE WHEN user_id % 2 = 0 THEN 'US' ELSE 'DE' END AS country,
               'R' || (user_id % 7) AS region, 'City ' || (user_id % 11) AS city,
               event_id % 3 <> 0 AS located,
               CASE WHEN event_id % 5 = 0 THEN 'Org ' || (user_id % 13) END AS org,
               CASE WHEN event_type = 'signup' THEN 'u' || user_id || '@example.com' END AS email,
               CAST(user_id AS VARCHAR) AS visitor_key
        FROM events""",
    "events_once": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY ts, event_id) AS rn FROM events_flat
        ) WHERE rn = 1 OR event_key IS NULL""",
    "by_date": """
        SELECT CAST(ts AS DATE) AS dt, json_extract_string(props, '$.k') AS media_id, count(*) AS n,
               count(DISTINCT user_id) AS u, count(*) FILTER (WHERE event_type = 'view') AS v
        FROM events GROUP BY 1, 2""",
    "by_date_flat": """
        SELECT dt AS day, CASE WHEN CAST(media_id AS BIGINT) % 7 <> 0 THEN n END AS load_count, v AS play_count,
               CAST(v AS DOUBLE) / n AS play_rate, CAST(NULL AS DOUBLE) AS hours_watched, n / 64.0 AS engagement,
               u AS visitors, dt, media_id
        FROM by_date""",
    "payloads": """
        SELECT event_id, ts, json_extract_string(props, '$.k') AS media_id,
               '{"event_key":"e' || event_id || '","received_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
               || '","event_type":"' || event_type || '","percent_viewed":'
               || CASE event_id % 10 WHEN 0 THEN 'null' WHEN 1 THEN '"n/a"' WHEN 2 THEN '1'
                  ELSE '0.' || lpad(CAST(event_id % 90 + 5 AS VARCHAR), 2, '0') || '5' END
               || ',"mobile":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
               || ',"props":' || CASE WHEN event_id % 4 = 0 THEN '["a",1]' ELSE props END
               || CASE WHEN event_id % 3 = 0 THEN ',"org":null' ELSE '' END
               || CASE WHEN event_id % 5 = 0 THEN ',"email":"u' || event_id || '@example.com"' ELSE '' END || '}' AS value
        FROM events""",
    "payloads_viewed": """
        SELECT * FROM payloads
        WHERE json_type(value, '$.percent_viewed') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
          AND CAST(json_extract_string(value, '$.percent_viewed') AS DOUBLE) >= 0.25""",
    "payloads_sampled": "SELECT * FROM payloads_viewed ORDER BY ts, 'e' || event_id LIMIT 100",
    "probed": """
        SELECT json_extract_string(props, '$.k') AS media_id, 1 AS priority, 'updated' AS field,
               CASE event_id % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'text' END AS found, date_trunc('day', ts) AS seen,
               event_id % 3 = 0 AS usable
        FROM events
        UNION ALL SELECT json_extract_string(props, '$.k'), 3, 'modified', 'time', ts, true FROM events
        UNION ALL SELECT json_extract_string(props, '$.k'), 4, 'created_at', 'time', date_trunc('second', ts), true FROM events
        UNION ALL SELECT DISTINCT json_extract_string(props, '$.k'), priority, field, NULL, NULL::TIMESTAMP, false
        FROM events, (VALUES (0, 'updated_at'), (2, 'modified_at'), (5, 'created')) AS absent(priority, field)""",
}

_NEEDS = {
    "silver_visitors": ["visitors_flat"],
    "fact": ["visitors_flat", "silver_visitors"],
    "snapshot": ["media_flat"],
    "dim": ["media_flat", "snapshot"],
    "events_once": ["events_flat"],
    "by_date_flat": ["by_date"],
    "payloads_viewed": ["payloads"],
    "payloads_sampled": ["payloads", "payloads_viewed"],
}


def _sql(body: str, *ctes: str) -> str:
    ordered: list[str] = []
    for name in ctes:
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in ordered) + "\n" + body


def _profile(payloads: str) -> str:
    return f"""
        SELECT key, CAST(sum(n) AS BIGINT) AS observed_in,
               string_agg(type || ':' || n, ',' ORDER BY type || ':' || n) AS types,
               round(CAST(sum(n) FILTER (WHERE type = 'null') AS DOUBLE) / (SELECT count(*) FROM {payloads}), 3) AS nulls
        FROM (
            SELECT key, CASE WHEN kind = 'NULL' THEN 'null' WHEN kind = 'BOOLEAN' THEN 'bool'
                             WHEN kind IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN kind = 'DOUBLE' THEN 'float'
                             WHEN kind = 'VARCHAR' AND contains(text, 'T') AND ends_with(text, 'Z') THEN 'iso_datetime'
                             WHEN kind = 'VARCHAR' THEN 'str' ELSE lower(kind) END AS type, count(*) AS n
            FROM (SELECT key, json_type(value, '$.' || key) AS kind, json_extract_string(value, '$.' || key) AS text
                  FROM (SELECT value, unnest(json_keys(value)) AS key FROM {payloads}))
            GROUP BY 1, 2
        ) GROUP BY key"""


def _flat_profile(payloads: str) -> str:
    return f"SELECT key, observed_in, types, coalesce(nulls, 0.0) AS null_frac FROM ({_profile(payloads)})"


_CLEAN_PAYLOAD = """CASE WHEN event_type <> 'purchase' THEN NULL
    WHEN event_id % 2 = 0 THEN '{"a":{"b":{"c":{"d":' || event_id || ',"org":"<redacted>","z":[[{"ip":null}]]}}}}'
    ELSE '{"email":"<redacted>","n":' || event_id || '}' END"""
_FACT = "dt, media_id, loads, plays, unique_visitors, round(play_rate, 9) AS play_rate"
_WEEK = f"dt BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}'"
_FORTNIGHT = f"dt BETWEEN DATE '{AS_OF}' - 14 AND DATE '{AS_OF}'"
_MASKED = "CASE WHEN {0} IS NOT NULL THEN '<redacted>' END AS {0}"


def _probe(by: str) -> str:
    lead = f"{by}, " if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"""
        SELECT {lead}priority, field, found, parsed, min_ts, max_ts,
               coalesce(priority = min(CASE WHEN parsed > 0 THEN priority END) {over}, false) AS suggested
        FROM (SELECT {lead}priority, field, count(found) AS found, count(*) FILTER (WHERE usable) AS parsed,
                     min(seen) FILTER (WHERE usable) AS min_ts, max(seen) FILTER (WHERE usable) AS max_ts
              FROM probed GROUP BY {lead}priority, field)"""


ORACLES = {
    "visitors_flatten": _sql("SELECT * FROM visitors_flat", "visitors_flat"),
    "visitors_dedup": _sql("SELECT * FROM silver_visitors", "silver_visitors"),
    "visitors_email_hmac": _sql(
        f"SELECT dt, media_id, visitor_key, load_count, play_count, name, {_hmac('email')} AS email FROM silver_visitors",
        "silver_visitors",
    ),
    "fact_media_daily": _sql(f"SELECT {_FACT} FROM fact", "fact"),
    "fact_one_day": _sql(f"SELECT {_FACT} FROM fact WHERE dt = DATE '{DAY}'", "fact"),
    "distinct_visitors_window": _sql(
        f"SELECT media_id, count(DISTINCT visitor_key) AS distinct_visitors FROM silver_visitors WHERE {_WEEK} GROUP BY media_id",
        "silver_visitors",
    ),
    "visitors_by_sketch": _sql(
        "SELECT media_id, count(DISTINCT visitor_key) AS distinct_visitors, true AS within_four_errors FROM silver_visitors GROUP BY media_id",
        "silver_visitors",
    ),
    "visitor_spread": _sql(
        """
        , spread AS (SELECT dt, visitor_key, count(DISTINCT media_id) AS n FROM silver_visitors GROUP BY ALL),
        media AS (SELECT dt, count(DISTINCT media_id) AS media FROM silver_visitors GROUP BY dt)
        SELECT dt, media, count(*) AS visitors, count(*) FILTER (WHERE n = media) AS visitors_under_every_media,
               max(n) AS widest_visitor, round(count(*) FILTER (WHERE n = media) / CAST(count(*) AS DOUBLE), 9) AS share
        FROM spread JOIN media USING (dt) GROUP BY dt, media""",
        "silver_visitors",
    ),
    "media_flatten": _sql("SELECT * FROM media_flat", "media_flat"),
    "media_snapshot_latest": _sql("SELECT * FROM snapshot", "snapshot"),
    "media_snapshot_upsert": _sql("SELECT * FROM snapshot", "snapshot"),
    "dim_media": _sql("SELECT * FROM dim", "dim"),
    "catalog_sweep": _sql(
        """SELECT * FROM snapshot WHERE contains(lower(name), 'ring') AND section = 'ECONOMY'
           ORDER BY updated_at DESC NULLS LAST, media_id OFFSET 10""",
        "snapshot",
    ),
    "catalog_summary": _sql(
        """SELECT (SELECT count(*) FROM snapshot) AS count, string_agg(name, '|' ORDER BY media_id) AS top_titles
           FROM (SELECT media_id, name FROM snapshot WHERE name <> '' ORDER BY media_id LIMIT 10)""",
        "snapshot",
    ),
    "catalog_redacted": _sql(
        """SELECT dt, media_id, '<redacted>' AS owner_email, visitor_key AS owner_id, '<redacted>' AS editor_email,
                  visitor_key AS editor_id FROM visitors_flat""",
        "visitors_flat",
    ),
    "media_perf_view": _sql(
        """SELECT dt, media_id, title, project_name, unique_visitors, loads, plays, round(play_rate, 9) AS play_rate
           FROM fact LEFT JOIN dim USING (media_id)""",
        "fact",
        "dim",
    ),
    "top_by_play_rate_7d": _sql(
        f"""SELECT title, project_name, media_id, round(avg(play_rate), 9) AS avg_play_rate,
                   CAST(sum(plays) AS BIGINT) AS total_plays, CAST(sum(loads) AS BIGINT) AS total_loads,
                   CAST(sum(unique_visitors) AS BIGINT) AS total_unique_visitors
            FROM fact LEFT JOIN dim USING (media_id) WHERE {_WEEK}
            GROUP BY title, project_name, media_id HAVING sum(loads) > 0
            ORDER BY avg(play_rate) DESC, media_id LIMIT 20""",
        "fact",
        "dim",
    ),
    "daily_trend": _sql(
        """SELECT dt, CAST(sum(plays) AS BIGINT) AS plays, CAST(sum(loads) AS BIGINT) AS loads,
                  round(CASE WHEN sum(loads) > 0 THEN CAST(sum(plays) AS DOUBLE) / sum(loads) ELSE 0.0 END, 9) AS play_rate
           FROM fact WHERE dt BETWEEN DATE '2024-01-08' AND DATE '2024-01-18' GROUP BY dt ORDER BY dt""",
        "fact",
    ),
    "fact_with_range": _sql(
        f""", win AS (SELECT DATE '2024-01-08' AS start_dt, DATE '2024-01-18' AS end_dt)
            SELECT {_FACT}, start_dt, end_dt FROM fact, win WHERE dt BETWEEN start_dt AND end_dt""",
        "fact",
    ),
    "most_viewed_7d": _sql(
        f"""SELECT title, project_name, media_id, CAST(sum(plays) AS BIGINT) AS total_plays,
                   CAST(sum(unique_visitors) AS BIGINT) AS total_unique_visitors
            FROM fact LEFT JOIN dim USING (media_id) WHERE {_WEEK}
            GROUP BY title, project_name, media_id ORDER BY total_plays DESC, media_id LIMIT 20""",
        "fact",
        "dim",
    ),
    "plays_per_visitor_14d": _sql(
        f"""SELECT title, media_id, CAST(sum(unique_visitors) AS BIGINT) AS visitors, CAST(sum(plays) AS BIGINT) AS plays,
                   round(CASE WHEN sum(unique_visitors) > 0 THEN CAST(sum(plays) AS DOUBLE) / sum(unique_visitors)
                         ELSE 0.0 END, 9) AS plays_per_visitor
            FROM fact LEFT JOIN dim USING (media_id) WHERE {_FORTNIGHT}
            GROUP BY title, media_id ORDER BY plays_per_visitor DESC, media_id LIMIT 20""",
        "fact",
        "dim",
    ),
    "latest_day": _sql("SELECT max(dt) AS latest_dt FROM fact", "fact"),
    "rows_on_day": _sql(f"SELECT dt, count(*) AS rows FROM fact WHERE dt = DATE '{DAY}' GROUP BY dt", "fact"),
    "rows_per_day": _sql("SELECT dt, count(*) AS rows FROM fact GROUP BY dt ORDER BY dt DESC", "fact"),
    "top_media_of_day": _sql(
        f"""SELECT media_id, round(play_rate, 9) AS play_rate, plays, unique_visitors FROM fact WHERE dt = DATE '{DAY}'
            ORDER BY fact.play_rate DESC, media_id LIMIT 10""",
        "fact",
    ),
    "events_typed": _sql(
        """SELECT dt, event_key, ts AS received_at, "at", event_type, media_id, position_s,
                  round(percent_viewed, 9) AS percent_viewed, visitor_key FROM events_flat""",
        "events_flat",
    ),
    "events_ip_hmac": _sql(
        f"SELECT event_key, received_at, visitor_key, {_hmac('ip')} AS ip_hmac FROM events_flat", "events_flat"
    ),
    "events_pii_dropped": _sql(
        """SELECT dt, event_key, received_at, CASE WHEN event_id % 41 = 0 THEN 'not a time' ELSE received_at END AS "at",
                  event_type, media_id, country, region, visitor_key FROM events_flat""",
        "events_flat",
    ),
    "events_redacted": _sql(
        "SELECT event_key, received_at, country, region, "
        + ", ".join(_MASKED.format(c) for c in ("ip", "email", "city", "org"))
        + ", CASE WHEN located THEN '<redacted>' END AS lat, CASE WHEN located THEN '<redacted>' END AS lon FROM events_flat",
        "events_flat",
    ),
    "events_redacted_nulls": _sql(
        "SELECT event_key, received_at, country, region, "
        + ", ".join(f"'<redacted>' AS {c}" for c in ("ip", "email", "city", "org", "lat", "lon"))
        + " FROM events_flat",
        "events_flat",
    ),
    "events_payload_redacted": _sql(
        """SELECT event_key, received_at,
                  """
        + _CLEAN_PAYLOAD
        + " AS conversion_data FROM events_flat",
        "events_flat",
    ),
    "events_dedup": _sql(
        f"""SELECT dt, event_key, ts AS received_at, "at", event_type, media_id, position_s,
                   round(percent_viewed, 9) AS percent_viewed, country, region, visitor_key, {_hmac('ip')} AS ip_hmac
            FROM events_once""",
        "events_once",
    ),
    "events_overlap_excluded": _sql(
        """SELECT dt, event_key, ts AS received_at, media_id FROM events_once
           WHERE event_key IS NULL
              OR event_key NOT IN (SELECT event_key FROM events_flat WHERE event_key IS NOT NULL AND dt = DATE '2024-01-09')""",
        "events_once",
    ),
    "event_key_duplicates": _sql(
        """SELECT event_key, count(*) AS copies FROM events_flat WHERE event_key IS NOT NULL
           GROUP BY event_key HAVING count(*) > 1""",
        "events_flat",
    ),
    "events_window": _sql(
        """SELECT event_key, received_at, media_id, event_type FROM events_flat
           WHERE media_id = '7' AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
        "events_flat",
    ),
    "events_min_percent": _sql(
        """SELECT event_key, received_at, event_type FROM events_flat
           WHERE percent_viewed >= 0.05""",
        "events_flat",
    ),
    "top_media_by_events": _sql(
        """SELECT coalesce(nullif(media_id, ''), '<none>') AS media_id, count(*) AS events FROM events_flat
           GROUP BY 1 ORDER BY events DESC, 1 LIMIT 10""",
        "events_flat",
    ),
    "media_id_from_path": _sql(
        """SELECT event_key, received_at, dt, 'm ' || visitor_key AS path_first,
                  coalesce(media_id, 'm ' || visitor_key) AS body_first FROM events_flat""",
        "events_flat",
    ),
    "by_date_typed": _sql(
        """SELECT day, load_count, play_count, round(play_rate, 9) AS play_rate, hours_watched,
                  round(CAST(engagement AS DOUBLE), 9) AS engagement, visitors, dt, media_id FROM by_date_flat""",
        "by_date_flat",
    ),
    "by_date_reconcile": _sql(
        """SELECT coalesce(r.day, f.dt) AS dt, coalesce(r.media_id, f.media_id) AS media_id,
                  r.load_count AS reported_loads, r.play_count AS reported_plays, r.visitors AS reported_visitors,
                  round(r.play_rate, 9) AS reported_play_rate,
                  round(CAST(r.play_count AS DOUBLE) / nullif(r.load_count, 0), 9) AS plays_per_load,
                  round(CAST(r.play_count AS DOUBLE) / nullif(r.visitors, 0), 9) AS plays_per_visitor,
                  f.loads, f.plays, f.unique_visitors, round(f.play_rate, 9) AS play_rate,
                  r.load_count - f.loads AS loads_gap, r.play_count - f.plays AS plays_gap
           FROM by_date_flat r FULL JOIN fact f ON r.day = f.dt AND r.media_id = f.media_id""",
        "by_date_flat",
        "fact",
    ),
    "landing_summary": _sql(
        """, lines AS (
               SELECT media_id, '{"media_id":"' || media_id || '","date":"' || dt || '","load_count":"'
                      || CASE WHEN CAST(media_id AS BIGINT) % 7 = 0 THEN 'n/a' ELSE CAST(n AS VARCHAR) END
                      || '","play_count":"' || v || '.0","visitors":"' || u || '"}' AS value
               FROM by_date)
           SELECT CAST(p_partkey AS VARCHAR) AS media_id, count(value) AS rows,
                  CAST(coalesce(sum(strlen(value)), 0) AS BIGINT) AS bytes
           FROM part LEFT JOIN lines ON media_id = CAST(p_partkey AS VARCHAR) GROUP BY p_partkey""",
        "by_date",
    ),
    "payload_profile": _sql(_flat_profile("payloads"), "payloads"),
    "payload_profile_sample": _sql(_flat_profile("payloads_sampled"), "payloads_sampled"),
    "payload_examples": _sql(
        """SELECT '{' || CASE WHEN event_id % 5 = 0 THEN '"email":"<redacted>",' ELSE '' END
                  || '"event_key":"e' || event_id || '","event_type":"' || json_extract_string(value, '$.event_type')
                  || '","mobile":' || json_extract_string(value, '$.mobile')
                  || CASE WHEN event_id % 3 = 0 THEN ',"org":null' ELSE '' END
                  || ',"percent_viewed":' || json_extract(value, '$.percent_viewed')
                  || ',"props":' || replace(CAST(json_extract(value, '$.props') AS VARCHAR), ' ', '')
                  || ',"received_at":"' || json_extract_string(value, '$.received_at') || '"}' AS value
           FROM payloads""",
        "payloads",
    ),
    "payload_summary": _sql(
        """SELECT (SELECT count(*) FROM payloads) AS fetched, (SELECT count(*) FROM payloads_viewed) AS sampled,
                  count(DISTINCT key) AS distinct_keys, string_agg(DISTINCT key, ',' ORDER BY key) AS top_keys
           FROM (SELECT unnest(json_keys(value)) AS key FROM payloads_viewed)""",
        "payloads_viewed",
    ),
    "watermark_probe": _sql(_probe(""), "probed"),
    "watermark_probe_by_media": _sql(_probe("media_id"), "probed"),
    "watermarks": _sql(
        """SELECT dataset, media_id, max(dt) AS last_date, least(max(dt), DATE '2024-01-29') - 1 AS start_date,
                  DATE '2024-01-29' AS end_date
           FROM (SELECT 'fact' AS dataset, media_id, dt FROM fact UNION ALL SELECT 'media', media_id, dt FROM media_flat)
           GROUP BY dataset, media_id""",
        "fact",
        "media_flat",
    ),
    "run_status_latest": """
        SELECT 'day#' || CAST(ts AS DATE) AS run_date, upper(event_type) AS data_in_process,
               arg_max(CASE event_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCEEDED' ELSE 'FAILED' END, ts) AS status,
               max(ts) AS updated_at
        FROM events GROUP BY 1, 2""",
}

# By way of files the whole table is one batch day, and a media_id that is empty comes back from its directory as NULL.
_ONE_DAY = f"DATE '{DAY}' AS dt"

ORACLES["fact_through_files"] = f"""
    WITH visitors_flat AS (SELECT * REPLACE ({_ONE_DAY}) FROM ({_CTES['visitors_flat']})),
    silver_visitors AS ({_CTES['silver_visitors']}), fact AS ({_CTES['fact']})
    SELECT {_FACT} FROM fact"""
ORACLES["by_date_through_files"] = f"SELECT * REPLACE ({_ONE_DAY}) FROM ({ORACLES['by_date_typed']})"
ORACLES["events_through_files"] = _sql(
    f"""SELECT {_ONE_DAY}, event_key, ts AS received_at, "at", event_type, nullif(media_id, '') AS media_id, position_s,
               round(percent_viewed, 9) AS percent_viewed, country, region, visitor_key, {_hmac('ip')} AS ip_hmac,
               {_CLEAN_PAYLOAD} AS conversion_data
        FROM events_once""",
    "events_once",
)
ORACLES["events_through_stream"] = ORACLES["events_through_files"]
_TWO_DAYS = "CASE WHEN dt < DATE '1995-06-15' THEN 1 ELSE 2 END AS dt"
ORACLES["dim_through_files"] = f"""
    WITH media_flat AS (SELECT * REPLACE ({_TWO_DAYS}) FROM ({_CTES['media_flat']})), snapshot AS ({_CTES['snapshot']}),
    dim AS ({_CTES['dim']}) SELECT * FROM dim"""

ORACLES["media_perf_through_catalog"] = f"""
    WITH visitors_flat AS (
        SELECT * REPLACE (CASE WHEN dt < DATE '2024-01-15' THEN DATE '{DAY}' ELSE DATE '{NEXT_DAY}' END AS dt)
        FROM ({_CTES['visitors_flat']})),
    silver_visitors AS ({_CTES['silver_visitors']}), fact AS ({_CTES['fact']}),
    media_flat AS (SELECT * REPLACE ({_TWO_DAYS}) FROM ({_CTES['media_flat']})), snapshot AS ({_CTES['snapshot']}),
    dim AS ({_CTES['dim']}) {ORACLES['media_perf_view'][ORACLES['media_perf_view'].index('SELECT dt, media_id, title'):]}"""

# One line in 37 is cut off and one of the others in 41 has a text where an object belongs.
_LINES = """
    SELECT event_id AS n, ts, event_type, json_extract_string(props, '$.k') AS media_id,
           CASE WHEN event_id % 37 = 0 THEN 'broken' WHEN event_id % 41 = 0 THEN 'partial' END AS kind
    FROM events"""
ORACLES["events_quarantined"] = f"""
    WITH lines AS ({_LINES})
    SELECT {_ONE_DAY}, media_id, kind,
           CASE kind WHEN 'broken' THEN '{{"event_key":"e' || n || '","received_at'
                     ELSE '{{"event_key":"p' || n || '","event_type":"odd","user_agent_details":"x' || n || '"}}' END AS text
    FROM lines WHERE kind IS NOT NULL"""
ORACLES["bronze_file_counts"] = f"""
    WITH lines AS ({_LINES})
    SELECT {_ONE_DAY}, media_id, count(*) AS records, count(*) FILTER (WHERE kind = 'broken') AS broken,
           count(*) FILTER (WHERE kind = 'partial') AS partial
    FROM lines GROUP BY media_id"""
ORACLES["events_beside_broken_lines"] = f"""
    WITH lines AS ({_LINES}), keyed AS (
        SELECT *, CASE WHEN kind = 'partial' THEN 'p' || n WHEN n % 31 <> 0 THEN 'e' || (n // 2) END AS event_key FROM lines),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY ts, n) AS rn
               FROM keyed WHERE kind IS DISTINCT FROM 'broken')
    SELECT event_key, CASE WHEN kind IS NULL THEN ts END AS received_at,
           CASE WHEN kind IS NULL THEN event_type ELSE 'odd' END AS event_type, media_id
    FROM ranked WHERE rn = 1 OR event_key IS NULL"""

# The runs end on the first, second and third of four days; the day before the first has no data.
ORACLES["loaded_by_watermark"] = f"""
    WITH visitors_flat AS (
        SELECT * REPLACE (DATE '{DAY}' + CAST(day(dt) % 4 AS INTEGER) AS dt) FROM ({_CTES['visitors_flat']})),
    silver_visitors AS ({_CTES['silver_visitors']}),
    media AS (SELECT DISTINCT media_id, ascii(right(media_id, 1)) % 3 AS third FROM visitors_flat WHERE media_id IS NOT NULL),
    counts AS (SELECT media_id, count(DISTINCT dt) AS days, count(*) AS visitors FROM silver_visitors
               WHERE dt < DATE '{DAY}' + 3 GROUP BY media_id)
    SELECT 'visitors' AS dataset, media_id, CASE third WHEN 0 THEN DATE '{DAY}' + 1 ELSE DATE '{DAY}' + 2 END AS last_date,
           CASE third WHEN 0 THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-03' END AS updated_at, days, visitors
    FROM media LEFT JOIN counts USING (media_id)"""
