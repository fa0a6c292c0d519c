"""What each query of the catalog must return, as DuckDB SQL over the same test tables.

Written from the rules of the data model and of the sample lines, not from the Spark code. Queries
without an entry have no SQL equivalent.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%g'"

CHANNELS = f"""
channels AS (
  SELECT c_custkey + 1 AS id, c_name AS username,
    CAST(floor(abs(c_acctbal)) AS BIGINT) * 100 AS total_video_visit,
    c_custkey % 50 AS video_count,
    1577836800 + (c_custkey % 1500) * 86400 AS start_date_timestamp,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0
      ELSE CAST(floor(abs(c_acctbal)) AS BIGINT) END AS followers_count,
    n_name AS country,
    CAST(make_date(2025, CAST(1 + c_custkey % 6 AS INT), CAST(1 + c_custkey % 28 AS INT))
      AS TIMESTAMP) AS created_at,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 5 END AS update_count
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

VIDEOS = """
videos AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE c_name END AS owner_username,
    CAST(o_custkey AS VARCHAR) AS owner_id,
    'title ' || o_orderkey AS title,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
      WHEN o_orderkey % 29 = 0 THEN o_orderpriority || ',' || o_orderpriority || ','
      ELSE o_orderpriority || ',' || o_orderstatus END AS tags,
    'u' || o_orderkey AS uid,
    CASE WHEN o_orderkey % 31 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END
      AS visit_count,
    c_name AS owner_name,
    o_orderkey % 3600 AS duration,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 12 END AS comments,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 37) AS BIGINT) END
      AS like_count,
    o_orderkey % 41 = 0 AS is_deleted,
    CAST(o_orderdate AS TIMESTAMP) AS created_at,
    TIMESTAMP '1970-01-01 00:00:00' AS expire_at,
    o_orderkey % 4 AS update_count
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

EVENTS = """
silver AS (
  SELECT v.id AS video_id, v.owner_username AS video_owner_username,
    v.owner_id AS video_owner_id, v.owner_name AS video_owner_name, v.title AS video_title,
    v.tags AS video_tags, v.uid AS video_uid, v.visit_count AS video_visit_count,
    v.duration AS video_duration, v.comments AS video_comments, v.like_count AS video_like_count,
    v.is_deleted AS video_is_deleted, v.created_at AS video_created_at,
    v.expire_at AS video_expire_at, v.update_count AS video_update_count,
    c.id AS channel_id, c.username AS channel_username,
    c.total_video_visit AS channel_total_video_visit, c.video_count AS channel_video_count,
    c.start_date_timestamp AS channel_start_date_timestamp,
    c.followers_count AS channel_followers_count, c.country AS channel_country,
    c.created_at AS channel_created_at, c.update_count AS channel_update_count
  FROM videos v JOIN channels c ON v.owner_username = c.username)"""

WITH_CHANNELS = f"WITH {CHANNELS}"
WITH_VIDEOS = f"WITH {VIDEOS}"
WITH_SILVER = f"WITH {CHANNELS}, {VIDEOS}, {EVENTS}"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def moment(column: str) -> str:
    return f"strftime({column}, {TS})"


SILVER_ROWS = f"""{WITH_SILVER}
SELECT * REPLACE ({moment('video_created_at')} AS video_created_at,
  {moment('video_expire_at')} AS video_expire_at,
  {moment('channel_created_at')} AS channel_created_at) FROM silver"""

GROWTH = f"""{WITH_SILVER}
SELECT channel_username, {day('channel_created_at')} AS date,
  max(coalesce(channel_followers_count, 0)) AS followers_count,
  max(channel_total_video_visit) AS total_video_visits, max(channel_video_count) AS video_count
FROM silver GROUP BY 1, 2"""

TOP = f"""{WITH_SILVER}
SELECT channel_username, {day('video_created_at')} AS date,
  max(coalesce(channel_followers_count, 0)) AS followers_count,
  CAST(sum(video_visit_count) AS BIGINT) AS total_video_visits,
  max(channel_video_count) AS video_count,
  round(avg(CASE WHEN channel_followers_count > 0
    THEN video_visit_count::DOUBLE / channel_followers_count ELSE 0 END), 6)
    AS avg_engagement_rate
FROM silver GROUP BY 1, 2"""

ENGAGEMENT = f"""{WITH_SILVER}
SELECT video_id, {day('video_created_at')} AS date,
  CAST(sum(video_visit_count) AS BIGINT) AS total_visit_count,
  CAST(sum(coalesce(video_like_count, 0)) AS BIGINT) AS total_like_count,
  round(avg(CASE WHEN video_visit_count > 0
    THEN coalesce(video_like_count, 0)::DOUBLE / video_visit_count ELSE 0 END), 6)
    AS average_engagement_rate
FROM silver GROUP BY 1, 2"""

POPULARITY = f"""{WITH_SILVER},
tagged AS (SELECT unnest(string_split(video_tags, ',')) AS tag, * FROM silver
  WHERE video_tags IS NOT NULL)
SELECT tag, {day('video_created_at')} AS date, count(*) AS total_video_count,
  CAST(sum(video_visit_count) AS BIGINT) AS total_visits,
  round(avg(coalesce(video_like_count, 0)), 6) AS average_likes
FROM tagged GROUP BY 1, 2"""

GEOGRAPHY = f"""{WITH_SILVER}
SELECT channel_country AS country, {day('channel_created_at')} AS date,
  count(DISTINCT channel_username) AS channel_count,
  CAST(sum(coalesce(channel_followers_count, 0)) AS BIGINT) AS total_followers,
  CAST(sum(channel_total_video_visit) AS BIGINT) AS total_video_visits
FROM silver GROUP BY 1, 2"""

ACTIVITY = f"""{WITH_SILVER}, dated AS (
  SELECT *, greatest(date_diff('day',
    CAST(TIMESTAMP '1970-01-01' + to_seconds(channel_start_date_timestamp) AS DATE),
    DATE '2025-07-01'), 0) AS days FROM silver)
SELECT channel_username, {day('channel_created_at')} AS created_date,
  CAST(sum(coalesce(channel_update_count, 0)) AS BIGINT) AS total_updates,
  max(days) AS max_activity_duration,
  round(avg(coalesce(channel_update_count, 0)::DOUBLE / greatest(days, 1)), 6)
    AS avg_updates_per_day
FROM dated GROUP BY 1, 2"""

# --- sample lines -----------------------------------------------------------------------------------

LINES = """
rows AS (
  SELECT o_orderkey AS k, coalesce(c_name, '') AS name,
    CAST(floor(o_totalprice) AS BIGINT) AS visits,
    CAST(floor(o_totalprice / 37) AS BIGINT) AS likes, CAST(o_orderdate AS TIMESTAMP) AS made,
    o_orderpriority || ',' || o_orderstatus AS tag_text
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

SHARED_FIELDS = """
    CASE WHEN k % 47 = 0 THEN '' WHEN k % 61 = 0 THEN 'None' WHEN k % 59 = 0
      THEN CAST(k AS VARCHAR) WHEN k % 53 = 0 THEN 'True' ELSE name END AS owner_username,
    '' AS owner_id, '' AS uid, '' AS owner_name, '' AS description,
    'title ' || k || ' "q"' AS title,
    k % 6 IN (1, 3, 5) AS is_deleted,
    k % 3600 AS duration"""

COMMENTS = "CASE WHEN k % 29 = 0 OR k % 8 = 0 THEN 0 ELSE k % 4 END"

# Everything below holds for lines with an object.
DAILY = f"""WITH {LINES}, reasons AS (
  SELECT *, CASE WHEN k % 97 = 0 OR k % 89 = 0 THEN 'bad json'
    WHEN k % 83 = 0 OR k % 79 = 0 THEN '_id'
    WHEN k % 73 = 0 OR k % 71 = 0 THEN 'object'
    WHEN k % 67 = 0 THEN 'object.id'
    WHEN k % 43 = 0 AND k % 17 <> 0 AND k % 11 <> 0 AND k % 7 <> 0 THEN 'visit_count'
    WHEN k % 41 = 0 THEN 'posted_timestamp'
    WHEN k % 37 = 0 THEN 'comments'
    WHEN k % 31 = 0 THEN 'created_at' END AS reason
  FROM rows), documents_ok AS (
  SELECT k, CAST(k AS VARCHAR) AS _id, CAST(k AS VARCHAR) AS id, {SHARED_FIELDS},
    CASE WHEN k % 19 = 0 THEN '' WHEN k % 21 = 0 THEN 'None' ELSE tag_text END AS tags,
    CASE WHEN k % 17 = 0 OR k % 11 = 0 OR k % 7 = 0 THEN 0 WHEN k % 13 = 0 THEN 1
      ELSE visits END AS visit_count,
    '1970-01-01' AS posted_date,
    CASE WHEN k % 23 = 0 THEN '1970-01-01T00:00:00'
      ELSE strftime(made, '%Y-%m-%dT%H:%M:%S') END AS posted_timestamp,
    {COMMENTS} AS comments,
    CASE WHEN k % 9 = 0 THEN NULL WHEN k % 10 = 0 THEN 0 ELSE likes END AS like_count,
    CASE WHEN k % 27 = 0 OR k % 25 = 0 THEN NULL ELSE made END AS created,
    CASE WHEN k % 12 = 0 THEN 0 ELSE k % 4 END AS update_count
  FROM reasons WHERE reason IS NULL)"""

EXTENDED = f"""WITH {LINES}, reasons AS (
  SELECT *, CASE WHEN k % 97 = 0 THEN 'bad json'
    WHEN k % 83 = 0 THEN '_id'
    WHEN k % 73 = 0 THEN CASE WHEN k % 31 = 0 THEN 'created_at' END
    WHEN k % 71 = 0 THEN 'object'
    WHEN k % 43 = 0 AND k % 17 <> 0 AND k % 11 <> 0 THEN 'visit_count'
    WHEN k % 37 = 0 THEN 'comments'
    WHEN k % 31 = 0 THEN 'created_at' END AS reason
  FROM rows WHERE k % 97 = 0 OR k % 89 <> 0), documents_ok AS (
  SELECT k, k % 73 = 0 AS bare, CAST(k AS VARCHAR) AS _id,
    CASE WHEN k % 67 = 0 OR k % 73 = 0 THEN '0' ELSE CAST(k AS VARCHAR) END AS id,
    {SHARED_FIELDS},
    CASE WHEN k % 19 = 0 OR k % 23 = 0 OR k % 73 = 0 THEN 'None' ELSE tag_text END AS tags,
    CASE WHEN k % 17 = 0 OR k % 11 = 0 OR k % 73 = 0 THEN 0 ELSE visits END AS visit_count,
    '1970-01-01 00:00:00' AS posted_date,
    CASE WHEN k % 41 = 0 OR k % 73 = 0 THEN '1970-01-01T00:00:00'
      ELSE strftime(made, '%Y-%m-%dT%H:%M:%S') END AS posted_timestamp,
    {COMMENTS} AS comments,
    CASE WHEN k % 9 = 0 OR k % 10 = 0 OR k % 73 = 0 THEN NULL ELSE likes END AS like_count,
    CASE WHEN k % 25 = 0 THEN TIMESTAMP '1970-01-01'
      ELSE made + to_milliseconds(k % 1000) END AS created,
    k % 4 AS update_count
  FROM reasons WHERE reason IS NULL)"""

# --- channels from events ---------------------------------------------------------------------------

EVENT_CHANNELS = """
drops AS (
  SELECT CASE WHEN user_id % 4 = 0 THEN 'New#' || user_id
      ELSE 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS username,
    ts, event_id FROM events)"""


def upserted(condition: str) -> str:
    return f"""{WITH_CHANNELS}, {EVENT_CHANNELS}, folded AS (
  SELECT username, count(*) AS times, arg_max(ts, (ts, event_id)) AS last
  FROM drops WHERE {condition} GROUP BY 1)
SELECT c.id AS id, coalesce(c.username, f.username) AS username,
  CASE WHEN c.id IS NULL THEN 0 ELSE total_video_visit END AS total_video_visit,
  CASE WHEN c.id IS NULL THEN 0 ELSE video_count END AS video_count,
  CASE WHEN c.id IS NULL THEN 1672531200 ELSE start_date_timestamp END AS start_date_timestamp,
  CASE WHEN c.id IS NULL THEN 0 ELSE followers_count END AS followers_count,
  CASE WHEN c.id IS NULL THEN '-' ELSE country END AS country,
  {moment('coalesce(f.last, c.created_at)')} AS created_at,
  CASE WHEN c.id IS NULL THEN times - 1 ELSE update_count + coalesce(times, 0) END AS update_count
FROM channels c FULL OUTER JOIN folded f ON c.username = f.username"""


KEYS = """
keys AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS made, CASE event_id % 10
    WHEN 0 THEN 'misc/' || event_id || '.csv'
    WHEN 1 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || ' evening/' || event_id || '.csv'
    WHEN 2 THEN '/' || event_id || '.csv'
    WHEN 3 THEN strftime(ts, '%Y-%m-%d') || 'x/' || event_id || '.csv'
    ELSE strftime(ts, '%Y-%m-%d') || '/' || event_type || '/' || event_id || '.csv' END AS key
  FROM events)"""

QUALITY_ROWS = """
rows AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE c_name END AS username,
    CAST(floor(o_totalprice) AS BIGINT) - 5000 AS total_video_visit,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 20 - 1 END AS video_count,
    o_orderkey % 7 AS start_date_timestamp, o_orderkey % 11 - 2 AS followers_count
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

# Silver of a daily run: accepted lines whose owner is a customer.
DAILY_SILVER = f"""{DAILY}, silver AS (
  SELECT d.* FROM documents_ok d JOIN customer ON owner_username = c_name)"""

SQL = {
    "bronze_channels": f"""{WITH_CHANNELS}
        SELECT * REPLACE ({moment('created_at')} AS created_at) FROM channels""",
    "bronze_videos": f"""{WITH_VIDEOS}
        SELECT * REPLACE ({moment('created_at')} AS created_at,
          {moment('expire_at')} AS expire_at) FROM videos""",
    "silver_events": SILVER_ROWS,
    "silver_events_spread": SILVER_ROWS,
    "report_channel_growth": f"{GROWTH} ORDER BY date, channel_username",
    "report_channel_growth_raw_counts": f"""{WITH_SILVER}
        SELECT channel_username, {day('channel_created_at')} AS date,
          count(DISTINCT CAST(video_id AS BIGINT) % 2) AS followers_states,
          count(DISTINCT CAST(video_id AS BIGINT) % 2) AS video_states
        FROM silver GROUP BY 1, 2""",
    "report_top_channels": f"""{TOP}
        ORDER BY total_video_visits DESC, channel_username, date LIMIT 10""",
    "report_top_channels_all": TOP,
    "report_video_engagement": f"{ENGAGEMENT} ORDER BY date, video_id LIMIT 10",
    "report_video_engagement_all": ENGAGEMENT,
    "report_content_popularity": f"{POPULARITY} ORDER BY date, tag",
    "report_geographic_distribution": GEOGRAPHY,
    "report_geographic_channel_grain": f"""{WITH_CHANNELS}, {VIDEOS}
        SELECT country, {day('created_at')} AS date, count(DISTINCT username) AS channel_count,
          CAST(sum(coalesce(followers_count, 0)) AS BIGINT) AS total_followers,
          CAST(sum(total_video_visit) AS BIGINT) AS total_video_visits
        FROM channels WHERE username IN (SELECT owner_username FROM videos) GROUP BY 1, 2""",
    "report_geographic_approx": f"""
        SELECT country, date, total_followers, total_video_visits, TRUE AS near
        FROM ({GEOGRAPHY})""",
    "report_channel_activity": ACTIVITY,
    "state_merge_channel_growth": GROWTH,
    "state_merge_top_channels": TOP,
    "state_merge_video_engagement": ENGAGEMENT,
    "state_merge_content_popularity": POPULARITY,
    "state_merge_geographic_distribution": f"""
        SELECT country, date, total_followers, total_video_visits FROM ({GEOGRAPHY})""",
    "state_merge_channel_activity": ACTIVITY,
    "gold_compacted": f"SELECT *, 1 AS states FROM ({TOP})",
    "month_partitions": f"""{WITH_SILVER}, daily AS (
        SELECT channel_username, CAST(video_created_at AS DATE) AS date,
          sum(video_visit_count) AS visits FROM silver GROUP BY 1, 2)
        SELECT CASE WHEN date < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS part,
          strftime(date, '%Y%m') AS yyyymm, count(*) AS n, CAST(sum(visits) AS BIGINT) AS visits
        FROM daily GROUP BY 1, 2""",
    "normalize_documents": f"""{DAILY}
        SELECT * EXCLUDE (k, created), {moment('created')} AS created_at,
          CAST(NULL AS VARCHAR) AS expire_at FROM documents_ok""",
    "normalize_rejects": f"""{DAILY}
        SELECT k AS line_no, reason FROM reasons WHERE reason IS NOT NULL""",
    "normalize_extended": f"""{EXTENDED}
        SELECT * EXCLUDE (k, bare, created, owner_username, title, is_deleted, duration, comments),
          CASE WHEN bare THEN '' ELSE owner_username END AS owner_username,
          CASE WHEN bare THEN '' ELSE title END AS title,
          CASE WHEN bare THEN FALSE ELSE is_deleted END AS is_deleted,
          CASE WHEN bare THEN 0 ELSE duration END AS duration,
          CASE WHEN bare THEN 0 ELSE comments END AS comments,
          {moment('created')} AS created_at,
          '1970-01-01 00:00:00.000' AS expire_at FROM documents_ok""",
    "normalize_extended_rejects": f"""{EXTENDED}
        SELECT k AS line_no, reason FROM reasons WHERE reason IS NOT NULL""",
    "flatten_documents": f"""{DAILY}
        SELECT _id AS id, owner_username, owner_id, title, tags, uid, visit_count, owner_name,
          duration, comments, like_count, is_deleted,
          {moment("coalesce(created, TIMESTAMP '1970-01-01')")} AS created_at,
          '1970-01-01 00:00:00.000' AS expire_at, update_count
        FROM documents_ok""",
    "events_props_parse": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "comment_part_count": """
        SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 0
            ELSE len(string_split(text, ' - ')) END AS parts,
          CASE WHEN coalesce(text, '') = '' THEN 0
            ELSE len(string_split(text, ',')) END AS comma_parts
        FROM documents""",
    "lenient_timestamps": f"""
        SELECT event_id, {moment('''CASE event_id % 8
          WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
          WHEN 2 THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND - INTERVAL 2 HOUR
          WHEN 5 THEN date_trunc('minute', ts) ELSE TIMESTAMP '1970-01-01' END''')} AS moment
        FROM events""",
    "append_documents": f"""{DAILY}
        SELECT _id, visit_count, {moment('created')} AS created_at FROM documents_ok""",
    "run_rejects": f"""{DAILY}
        SELECT reason, CAST(sum(CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n
        FROM reasons WHERE reason IS NOT NULL GROUP BY 1""",
    "json_lines_roundtrip": f"""{EXTENDED}
        SELECT _id, CASE WHEN bare THEN '' ELSE title END AS title, tags, like_count,
          CASE WHEN created = date_trunc('second', created)
            THEN strftime(created, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(created, '%Y-%m-%dT%H:%M:%S.%f') END AS created_at, update_count
        FROM documents_ok""",
    "json_lines_rejects": f"""{EXTENDED}
        SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY 1""",
    "path_date_filter": f"""WITH {KEYS}, dated AS (
        SELECT event_id, CASE WHEN event_id % 10 IN (0, 2, 3) THEN NULL ELSE made END AS made
        FROM keys)
        SELECT event_id, {day('made')} AS drop_date, CASE WHEN made IS NULL THEN 'invalid'
          WHEN made > DATE '2024-01-15' THEN 'future' ELSE 'due' END AS state FROM dated""",
    "ledger_anti_join": f"""WITH {KEYS}
        SELECT event_id, key FROM keys WHERE NOT (user_id % 3 = 0 AND event_id % 2 = 0)""",
    "ledger_upsert": f"""WITH {KEYS}
        SELECT key AS file_name, user_id % 2 = 0 OR event_id % 2 = 0 AS inserted
        FROM keys WHERE user_id % 3 = 0 OR user_id % 2 = 0""",
    "files_modified_since": """
        SELECT 'docs' AS folder, 'source=' || source AS part, 'epoch' AS since, count(*) AS lines
        FROM documents GROUP BY source""",
    "files_interval": """
        SELECT * FROM (VALUES
          ('neither', (SELECT count(*) FROM documents)),
          ('since', (SELECT count(*) FROM documents WHERE doc_id % 3 > 0)),
          ('until', (SELECT count(*) FROM documents WHERE doc_id % 3 < 2)),
          ('both', (SELECT count(*) FROM documents WHERE doc_id % 3 = 1))
        ) AS t(stage, n)""",
    "files_once_only": "SELECT doc_id, lang, n_chars FROM documents",
    "channel_upsert": upserted("TRUE"),
    "channel_upsert_ids": f"""{WITH_CHANNELS}, {EVENT_CHANNELS}, names AS (
        SELECT username FROM channels UNION SELECT username FROM drops)
        SELECT count(*) AS n, count(*) AS distinct_ids, 1 AS first_id, count(*) AS last_id
        FROM names""",
    "csv_daily_load": upserted("ts < TIMESTAMP '2024-01-20'"),
    "drops_with_refused_file": f"""WITH after AS ({upserted("ts < TIMESTAMP '2024-01-20'")}),
        sums AS (SELECT CAST(sum(update_count) AS BIGINT) AS updates, count(*) AS channels FROM after)
        SELECT drop, reason, updates, channels FROM sums, (VALUES
          ('2024-01-10 drop', 'loaded'), ('2024-01-20 drop', 'loaded'), ('undated', 'no date in key'),
          ('2024-01-20 drop/other columns', 'missing columns: _id, created_at'),
          ('2024-01-20 drop/blank', 'no lines'), ('2024-01-20 drop/empty', 'no lines')) AS t(drop, reason)""",
    "files_with_empty_drop": """
        SELECT asked, 'source=' || source AS folder, 1 AS empty, true AS with_lines
        FROM (SELECT DISTINCT source FROM documents), (VALUES ('all'), ('since')) AS t(asked)""",
    "csv_bulk_load": f"""{WITH_CHANNELS}
        SELECT username, total_video_visit, video_count, start_date_timestamp, followers_count,
          CASE WHEN id % 5 = 0 THEN '' ELSE 'a "b", ' || country END AS country, update_count,
          '2025-01-01 00:00:00.000' AS created_at FROM channels""",
    "quality_violations": f"""WITH {QUALITY_ROWS}
        SELECT 'total_video_visit >= 0' AS rule, username, count(*) AS n
        FROM rows WHERE total_video_visit < 0 GROUP BY 2
        UNION ALL SELECT 'video_count >= 0', username, count(*)
        FROM rows WHERE video_count < 0 GROUP BY 2
        UNION ALL SELECT 'followers_count >= 0', username, count(*)
        FROM rows WHERE followers_count < 0 GROUP BY 2
        UNION ALL SELECT 'username not null', NULL, count(*)
        FROM rows WHERE username IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'username unique', username, count(*)
        FROM rows WHERE username IS NOT NULL GROUP BY 2 HAVING count(*) > 1""",
    "quality_split": f"""WITH {QUALITY_ROWS}
        SELECT o_orderkey, CASE WHEN total_video_visit < 0 THEN 'total_video_visit >= 0'
          WHEN video_count < 0 THEN 'video_count >= 0'
          WHEN followers_count < 0 THEN 'followers_count >= 0'
          WHEN username IS NULL THEN 'username not null' ELSE 'none' END AS rule FROM rows""",
    "keyset_increment": f"""{WITH_CHANNELS}
        SELECT * REPLACE ({moment('created_at')} AS created_at) FROM channels""",
    "time_increment": f"""{WITH_VIDEOS}
        SELECT CASE WHEN created_at < DATE '1997-01-01' THEN 0
          WHEN created_at < DATE '1999-07-01' THEN 1 ELSE 2 END AS slice, id,
          {moment('created_at')} AS created_at FROM videos""",
    "documents_by_time": f"""{DAILY}
        SELECT CASE WHEN created < TIMESTAMP '1997-01-01' THEN 0
          WHEN created < TIMESTAMP '1999-07-01' THEN 1 ELSE 2 END AS slice, _id, {moment('created')} AS created_at
        FROM documents_ok WHERE created IS NOT NULL""",
    "key_page": f"""{WITH_CHANNELS}
        SELECT id, username FROM channels WHERE id > 700 ORDER BY id LIMIT 100""",
    "dedup_first_seen": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
        WHERE rn = 1""",
    "snapshot_reload": f"""{DAILY}
        SELECT _id AS id, visit_count,
          {moment("coalesce(created, TIMESTAMP '1970-01-01')")} AS created_at FROM documents_ok""",
    "unseen_keys": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL
            AND o_orderpriority = '1-URGENT')""",
    "approximate_distinct": """
        SELECT l_returnflag, count(DISTINCT l_partkey) AS n, TRUE AS near FROM lineitem GROUP BY 1""",
    "columns_by_position": "SELECT c_name, c_custkey, c_acctbal FROM customer",
    "silver_stream": f"""{WITH_SILVER}
        SELECT video_id, channel_id, channel_username FROM silver
        WHERE video_created_at >= DATE '1999-07-01' OR channel_created_at < DATE '2025-04-01'""",
    "silver_rebuilt": GROWTH,
    "silver_late_channels": f"""{SILVER_ROWS}""",
    "gold_late_channels": GROWTH,
    "silver_after_cut_append": f"{WITH_SILVER} SELECT video_id, channel_id, channel_username FROM silver",
    "rebuild_after_crash": GROWTH,
    "compact_then_replay": TOP,
    "catalog_tables": f"""{WITH_SILVER}
        SELECT * FROM (VALUES
          ('bronze.channels', (SELECT count(*) FROM channels)),
          ('bronze.videos', (SELECT count(*) FROM videos)),
          ('silver.events', (SELECT count(*) FROM silver)),
          ('gold.channel_growth', (SELECT count(*) FROM (SELECT DISTINCT channel_username, {day('channel_created_at')} FROM silver))),
          ('documents', 0)
        ) AS t(stage, n)""",
    "run_audit_counts": f"""{DAILY_SILVER}
        SELECT * FROM (VALUES
          ('documents', 'success', (SELECT count(*) FROM documents_ok),
            (SELECT count(*) FROM reasons WHERE reason IS NOT NULL)),
          ('bronze_videos', 'success', (SELECT count(*) FROM documents_ok), NULL),
          ('channels', 'success', (SELECT count(*) FROM customer), 0),
          ('bronze_channels', 'success', (SELECT count(*) FROM customer), NULL),
          ('silver_and_gold', 'success', (SELECT count(*) FROM silver), NULL)
        ) AS t(stage, status, rows_out, rows_rejected)""",
    "backfill_rerun": f"""{DAILY_SILVER}
        SELECT * FROM (VALUES
          ('documents', (SELECT count(*) FROM documents_ok)),
          ('rejects', (SELECT count(*) FROM reasons WHERE reason IS NOT NULL)),
          ('channels', (SELECT count(*) FROM customer)),
          ('bronze_videos', (SELECT count(*) FROM documents_ok)),
          ('bronze_channels', (SELECT count(*) FROM customer)),
          ('silver_events', (SELECT count(*) FROM silver)),
          ('tag_occurrences', (SELECT CAST(sum(len(string_split(tags, ','))) AS BIGINT)
            FROM silver))
        ) AS t(stage, n)""",
}
SQL["reload_then_rerun"] = SQL["backfill_rerun"]
