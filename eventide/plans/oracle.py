"""DuckDB SQL equivalents of ``catalog.QUERIES`` (the correctness oracle).

The oracle derives the nested-event fields straight from the ``events``
table with SQL expressions; it shares no code with the Spark path (which goes
through JSON text, ``from_json`` and the enrichment expressions). Sliding
windows are spelled out as the four 15-minute-aligned starts before each
event. Sums are cast to BIGINT (DuckDB widens them), ties at every LIMIT are
broken by the entity key, exactly as on the Spark side.
"""

from __future__ import annotations

from .pipeline import AS_OF, KEYED_APPEND_CUT, PANEL_FROM, PANEL_TO, RETENTION_AS_OF

# ---- adapter, restated in SQL ----------------------------------------------------
SRC = """src AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)"""

TYPE = """CASE
    WHEN event_type = 'click' THEN 'PushEvent'
    WHEN event_type = 'view' THEN 'WatchEvent'
    WHEN event_type = 'error' THEN 'IssuesEvent'
    WHEN event_type = 'purchase' THEN 'PullRequestEvent'
    WHEN event_type = 'signup' AND k % 2 = 0 THEN 'ForkEvent'
    WHEN event_type = 'signup' THEN 'CreateEvent'
    ELSE event_type END"""

EV = f"""ev AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {TYPE} AS type,
         user_id AS actor_id, 'user_' || user_id AS actor_login,
         k AS repo_id, 'org/repo_' || k AS repo_name,
         ts AS created_at, ts + INTERVAL 60 SECOND AS collected_at,
         TIMESTAMP '{AS_OF}' AS processed_at, TRUE AS public, k, event_id, ts
  FROM src
)"""

LANGS = """CASE
    WHEN type = 'PushEvent' AND k % 5 = 0 THEN ['JavaScript', 'Python']
    WHEN type = 'PushEvent' AND k % 5 = 1 THEN ['Go']
    WHEN type = 'PushEvent' AND k % 5 = 2 THEN ['Rust', 'TypeScript']
    WHEN type = 'CreateEvent' AND k % 4 = 1 AND (k // 4) % 5 < 4
      THEN [(['Python', 'Java', 'Go', 'Ruby'])[(k // 4) % 5 + 1]]
    ELSE []::VARCHAR[] END"""

ENR = f"""enr AS (
  SELECT ev.*, {LANGS} AS languages,
    CASE WHEN type = 'WatchEvent' AND k % 10 <> 9 THEN 1
         WHEN type IN ('IssuesEvent', 'PullRequestEvent') AND k % 3 <> 0 THEN k * 10 END AS stars,
    CASE WHEN type = 'ForkEvent' THEN 1
         WHEN type IN ('IssuesEvent', 'PullRequestEvent') AND k % 3 <> 0 THEN k END AS forks,
    CASE WHEN type IN ('IssuesEvent', 'PullRequestEvent') AND k % 3 <> 0 THEN k * 10 + 1 END AS watchers,
    CASE WHEN type IN ('IssuesEvent', 'PullRequestEvent') AND k % 3 <> 0 THEN k % 7 END AS open_issues
  FROM ev
)"""


def wins(size_minutes: int = 60, slide_minutes: int = 15, src: str = "enr") -> str:
    n = size_minutes // slide_minutes
    return f"""(
  SELECT s.*, time_bucket(INTERVAL {slide_minutes} MINUTE, s.created_at)
              - g.i * INTERVAL {slide_minutes} MINUTE AS window_start
  FROM {src} s, generate_series(0, {n - 1}) AS g(i)
)"""


BASE = f"WITH {SRC},\n{EV},\n{ENR}"

RM_BODY = f"""SELECT repo_id, repo_name, window_start, window_start + INTERVAL 1 HOUR AS window_end,
         COUNT(*) AS event_count,
         COUNT(*) FILTER (WHERE type = 'WatchEvent') AS stars,
         COUNT(*) FILTER (WHERE type = 'ForkEvent') AS forks,
         COUNT(*) FILTER (WHERE type = 'PullRequestEvent') AS pull_requests,
         COUNT(*) FILTER (WHERE type = 'IssuesEvent') AS issues
  FROM {wins()} w GROUP BY repo_id, repo_name, window_start"""

ET_BODY = f"""SELECT type AS event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end,
         COUNT(*) AS event_count
  FROM {wins()} w GROUP BY type, window_start"""

UA_BODY = f"""SELECT actor_id AS user_id, actor_login AS username, window_start,
         window_start + INTERVAL 1 HOUR AS window_end, COUNT(*) AS event_count,
         COUNT(DISTINCT repo_id) AS repos_contributed,
         string_agg(type, ',' ORDER BY type) AS event_types
  FROM {wins()} w GROUP BY actor_id, actor_login, window_start"""

LT_BODY = f"""SELECT language, window_start, window_start + INTERVAL 1 HOUR AS window_end,
         COUNT(*) AS event_count
  FROM (SELECT unnest(languages) AS language, window_start FROM {wins()} w) x
  GROUP BY language, window_start"""

METRICS = f"""{BASE},
rm AS ({RM_BODY}),
et AS ({ET_BODY}),
ua AS ({UA_BODY}),
lt AS ({LT_BODY})"""

RECENT = f"window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"
IN_RANGE = "BETWEEN TIMESTAMP '{f}' AND TIMESTAMP '{t}'".format(f=PANEL_FROM, t=PANEL_TO)

TOP_REPOS = f"""SELECT repo_id, repo_name,
         CAST(SUM(event_count) AS BIGINT) AS total_events,
         CAST(SUM(stars) AS BIGINT) AS total_stars,
         CAST(SUM(forks) AS BIGINT) AS total_forks,
         CAST(SUM(pull_requests) AS BIGINT) AS total_prs,
         CAST(SUM(issues) AS BIGINT) AS total_issues
  FROM rm WHERE {RECENT}
  GROUP BY repo_id, repo_name
  ORDER BY total_events DESC, repo_id, repo_name LIMIT 100"""

TOP_USERS = f"""SELECT user_id, username,
         CAST(SUM(event_count) AS BIGINT) AS total_events,
         CAST(SUM(repos_contributed) AS BIGINT) AS total_repos_contributed
  FROM ua WHERE {RECENT}
  GROUP BY user_id, username
  ORDER BY total_events DESC, user_id, username LIMIT 100"""

AGG_METRICS = """SELECT date_trunc('hour', window_start) AS hour,
         CAST(SUM(event_count) AS BIGINT) AS total_events,
         COUNT(DISTINCT repo_id) AS unique_repos,
         CAST(SUM(stars) AS BIGINT) AS total_stars,
         CAST(SUM(forks) AS BIGINT) AS total_forks,
         CAST(SUM(pull_requests) AS BIGINT) AS total_prs,
         CAST(SUM(issues) AS BIGINT) AS total_issues
  FROM rm GROUP BY 1"""

RAW_COLS = """id, type, actor_id, actor_login, repo_id, repo_name, created_at, collected_at,
       processed_at, public"""

D = 50  # defect modulus of the adapter (see sources.adapter)


def _share(measure: str) -> str:
    return (f"CAST(ROUND(CAST(100.0 AS DECIMAL(4,1)) * {measure} "
            f"/ SUM({measure}) OVER (), 2) AS DOUBLE)")


SQL: dict[str, str] = {
    "parse_events": f"""{BASE}
SELECT repo_name AS event_key, id, type, actor_id, actor_login,
       'https://api.example.invalid/users/' || actor_login AS actor_url,
       repo_id, repo_name, 'https://api.example.invalid/repos/org/repo_' || k AS repo_url,
       public, created_at, collected_at,
       CASE WHEN type = 'WatchEvent' THEN 'action'
            WHEN type IN ('IssuesEvent', 'PullRequestEvent') AND k % 3 <> 0 THEN 'action,repository'
            WHEN type IN ('IssuesEvent', 'PullRequestEvent') THEN 'action'
            WHEN type = 'PushEvent' AND k % 5 < 4 THEN 'commits'
            WHEN type = 'PushEvent' THEN ''
            WHEN type = 'ForkEvent' THEN 'forkee'
            WHEN type = 'CreateEvent' AND (k // 4) % 5 < 4 THEN 'language,ref_type'
            WHEN type = 'CreateEvent' THEN 'ref_type'
            ELSE '' END AS payload_keys
FROM ev""",

    "raw_events": f"{BASE}\nSELECT {RAW_COLS} FROM ev",

    "validate_valid": f"""{BASE}
SELECT id, CASE WHEN event_id % {D} = 29 THEN 'SponsorshipTierEvent' ELSE type END AS type,
       actor_id, actor_login, repo_id, repo_name, created_at, collected_at, processed_at, public
FROM ev WHERE event_id % {D} NOT IN (7, 13, 21, 33, 41)""",

    "validate_rejected": f"""{BASE}
SELECT CASE WHEN event_id % {D} = 21 THEN 'unknown' ELSE id END AS id,
       CASE WHEN event_id % {D} = 21 THEN 'unknown' ELSE type END AS type,
       CASE event_id % {D}
         WHEN 7 THEN 'repo.name'
         WHEN 13 THEN 'created_at'
         WHEN 33 THEN 'actor.id'
         WHEN 41 THEN 'collected_at'
         ELSE 'id,type,actor.id,actor.login,actor.url,actor.avatar_url,repo.id,repo.name,'
              || 'repo.url,public,created_at,payload' END AS errors,
       CASE WHEN event_id % {D} = 7 THEN NULL ELSE repo_name END AS event_key
FROM ev WHERE event_id % {D} IN (7, 13, 21, 33, 41)""",

    "unknown_types": f"""{BASE}
SELECT 'SponsorshipTierEvent' AS event_type, COUNT(*) AS event_count
FROM ev WHERE event_id % {D} = 29 HAVING COUNT(*) > 0""",

    "dedup_events": f"""{BASE}
SELECT id, CASE WHEN event_id % 10 = 4 THEN 'CommitCommentEvent' ELSE type END AS type,
       CASE WHEN event_id % 10 = 4 THEN actor_id + 1000000 ELSE actor_id END AS actor_id,
       CASE WHEN event_id % 10 = 4 THEN 'user_' || (actor_id + 1000000)
            ELSE actor_login END AS actor_login,
       repo_id, repo_name, created_at,
       CASE WHEN event_id % 10 = 5 THEN processed_at ELSE collected_at END AS collected_at,
       processed_at, event_id % 10 <> 4 AS public FROM ev""",

    "enrich_languages": f"""{BASE}
SELECT id, type, array_to_string(languages, ',') AS languages,
       CAST(len(languages) AS INTEGER) AS n_languages FROM enr""",

    "enrich_repo_metrics": f"""{BASE}
SELECT id, type, repo_id, repo_name, stars, forks, watchers, open_issues FROM enr""",

    "enrich": f"""{BASE}
SELECT id, type, array_to_string(languages, ',') AS languages, repo_id, repo_name,
       stars, forks, watchers, open_issues FROM enr""",

    "repository_metrics": f"{BASE}\n{RM_BODY}",
    "event_type_distribution": f"{BASE}\n{ET_BODY}",
    "user_activity": f"{BASE}\n{UA_BODY}",
    "user_activity_counts": f"""{BASE}
SELECT user_id, username, window_start, window_start + INTERVAL 1 HOUR AS window_end,
       CAST(SUM(n) AS BIGINT) AS event_count, MAX(repos) AS repos_contributed,
       string_agg(type || ':' || n, ',' ORDER BY type) AS event_types
FROM (SELECT actor_id AS user_id, actor_login AS username, window_start, type, COUNT(*) AS n
      FROM {wins()} w GROUP BY 1, 2, 3, 4) t
JOIN (SELECT actor_id AS user_id, actor_login AS username, window_start,
             COUNT(DISTINCT repo_id) AS repos
      FROM {wins()} w GROUP BY 1, 2, 3) r USING (user_id, username, window_start)
GROUP BY user_id, username, window_start""",
    "language_trends": f"{BASE}\n{LT_BODY}",

    "aggregated_metrics": f"{METRICS}\n{AGG_METRICS}",
    "top_repositories": f"{METRICS}\n{TOP_REPOS}",
    "top_repositories_tiled": f"""{METRICS}
SELECT repo_id, repo_name,
       CAST(SUM(event_count) AS BIGINT) AS total_events,
       CAST(SUM(stars) AS BIGINT) AS total_stars,
       CAST(SUM(forks) AS BIGINT) AS total_forks,
       CAST(SUM(pull_requests) AS BIGINT) AS total_prs,
       CAST(SUM(issues) AS BIGINT) AS total_issues
FROM rm WHERE {RECENT} AND minute(window_start) = 0
GROUP BY repo_id, repo_name
ORDER BY total_events DESC, repo_id, repo_name LIMIT 100""",
    "top_users": f"{METRICS}\n{TOP_USERS}",
    "top_languages": f"""{METRICS}
SELECT language, CAST(SUM(event_count) AS BIGINT) AS total_events
FROM lt WHERE {RECENT} GROUP BY language
ORDER BY total_events DESC, language LIMIT 20""",
    "event_type_summary": f"""{METRICS}
SELECT event_type, CAST(SUM(event_count) AS BIGINT) AS total_events,
       {_share('SUM(event_count)')} AS percentage
FROM et WHERE {RECENT} GROUP BY event_type""",

    "panel_repository_activity": f"""{METRICS},
top AS ({TOP_REPOS})
SELECT window_start AS time, event_count FROM rm
WHERE window_start {IN_RANGE}
  AND repo_id IN (SELECT repo_id FROM (SELECT repo_id FROM top ORDER BY total_events DESC, repo_id, repo_name LIMIT 10))""",
    "panel_series_stats": f"""{METRICS},
top AS ({TOP_REPOS}),
s AS (SELECT window_start AS time, event_count FROM rm
      WHERE window_start {IN_RANGE}
        AND repo_id IN (SELECT repo_id FROM (SELECT repo_id FROM top ORDER BY total_events DESC, repo_id, repo_name LIMIT 10)))
SELECT AVG(event_count) AS mean, MAX(event_count) AS max, CAST(SUM(event_count) AS BIGINT) AS sum FROM s""",
    "panel_event_types": f"""{METRICS}
SELECT event_type, CAST(SUM(event_count) AS BIGINT) AS count,
       {_share('SUM(event_count)')} AS percentage
FROM et WHERE window_start {IN_RANGE} GROUP BY event_type""",
    "panel_event_types_7d": f"""{METRICS}
SELECT event_type, CAST(SUM(event_count) AS BIGINT) AS count,
       {_share('SUM(event_count)')} AS percentage
FROM et WHERE window_start BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND TIMESTAMP '{AS_OF}'
GROUP BY event_type""",
    "panel_top_languages": f"""{METRICS}
SELECT language, CAST(SUM(event_count) AS BIGINT) AS count
FROM lt WHERE window_start {IN_RANGE} GROUP BY language
ORDER BY count DESC, language LIMIT 10""",
    "panel_top_repositories": f"""{METRICS},
top AS ({TOP_REPOS})
SELECT repo_name, total_events, total_stars, total_forks, total_prs, total_issues
FROM top ORDER BY total_events DESC, repo_id, repo_name LIMIT 10""",
    "panel_top_users": f"""{METRICS},
top AS ({TOP_USERS})
SELECT username, total_events, total_repos_contributed
FROM top ORDER BY total_events DESC, user_id, username LIMIT 10""",
    "panel_overall_trends": f"""{METRICS},
am AS ({AGG_METRICS})
SELECT hour AS time, total_events, total_stars, total_forks, total_prs, total_issues
FROM am WHERE hour {IN_RANGE}""",
    "panel_repository_stars": f"""{METRICS}
SELECT repo_name, window_end AS time, stars FROM rm
WHERE window_end > TIMESTAMP '{PANEL_FROM}' AND window_end < TIMESTAMP '{PANEL_TO}'""",

    "flow_check": f"""{BASE}
SELECT COUNT(*) AS event_count, MAX(created_at) AS latest_event,
       CASE WHEN COUNT(*) > 0 THEN 'flowing' ELSE 'no data' END AS status FROM ev""",
    "retain_events": f"""{BASE}
SELECT {RAW_COLS} FROM ev WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
    "retain_tiered": f"""{BASE},
hourly AS ({RM_BODY}),
daily AS (
  SELECT repo_id, repo_name, time_bucket(INTERVAL 1 DAY, created_at) AS window_start,
         time_bucket(INTERVAL 1 DAY, created_at) + INTERVAL 1 DAY AS window_end,
         COUNT(*) AS event_count,
         COUNT(*) FILTER (WHERE type = 'WatchEvent') AS stars,
         COUNT(*) FILTER (WHERE type = 'ForkEvent') AS forks,
         COUNT(*) FILTER (WHERE type = 'PullRequestEvent') AS pull_requests,
         COUNT(*) FILTER (WHERE type = 'IssuesEvent') AS issues
  FROM enr GROUP BY 1, 2, 3)
SELECT * FROM hourly WHERE window_end >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 30 DAY
UNION ALL
SELECT * FROM daily WHERE window_end >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 90 DAY""",
    "arrays_to_text": f"""{BASE}
SELECT id, array_to_string(languages, ',') AS languages, type || ',' || repo_name AS tags FROM enr""",
    "keyed_json": f"""{BASE}
SELECT repo_name AS key,
       to_json(struct_pack(id := id, type := type, actor_id := actor_id,
                           actor_login := actor_login, repo_id := repo_id,
                           repo_name := repo_name,
                           created_at := strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ'),
                           languages := languages))::VARCHAR AS value
FROM enr""",
    "keyed_append": f"""{BASE},
tgt AS (SELECT repo_id, repo_name, window_start, window_start + INTERVAL 1 HOUR AS window_end,
               COUNT(*) AS event_count,
               COUNT(*) FILTER (WHERE type = 'WatchEvent') AS stars,
               COUNT(*) FILTER (WHERE type = 'ForkEvent') AS forks,
               COUNT(*) FILTER (WHERE type = 'PullRequestEvent') AS pull_requests,
               COUNT(*) FILTER (WHERE type = 'IssuesEvent') AS issues
        FROM {wins(src="(SELECT * FROM enr WHERE created_at < TIMESTAMP '" + KEYED_APPEND_CUT + "')")} w
        GROUP BY repo_id, repo_name, window_start),
bat AS ({RM_BODY})
SELECT * FROM tgt
UNION ALL
SELECT b.* FROM bat b WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.repo_id = b.repo_id AND t.repo_name = b.repo_name
    AND t.window_start = b.window_start AND t.window_end = b.window_end)""",
    "stream_repository_metrics": f"""{BASE}
SELECT * FROM ({RM_BODY}) m
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""",
    "lake_top_repositories": f"{METRICS}\n{TOP_REPOS}",
    "stream_repository_metrics_update": f"{BASE}\n{RM_BODY}",
    "stream_raw_events": f"{BASE}\nSELECT id, repo_id, repo_name, created_at FROM ev",
    "stream_then_build": f"{BASE}\n{RM_BODY}",
}
SQL["view_event_type_summary"] = SQL["event_type_summary"]
SQL["lake_retain"] = SQL["retain_events"]
SQL["lake_retain_tiered"] = SQL["retain_tiered"]

# --- sessions, joins by time, trends ------------------------------------------------

SESSIONS = """gaps AS (
  SELECT *, CASE WHEN created_at - lag(created_at) OVER (
                        PARTITION BY actor_id, actor_login ORDER BY created_at)
                      <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM enr),
numbered AS (
  SELECT *, SUM(fresh) OVER (PARTITION BY actor_id, actor_login ORDER BY created_at, fresh DESC
                             ROWS UNBOUNDED PRECEDING) AS nth FROM gaps),
sess AS (
  SELECT actor_id AS user_id, actor_login AS username, MIN(created_at) AS window_start,
         MAX(created_at) + INTERVAL 30 MINUTE AS window_end, COUNT(*) AS event_count,
         COUNT(*) FILTER (WHERE type = 'PushEvent') AS pushes,
         COUNT(*) FILTER (WHERE type = 'WatchEvent') AS stars,
         COUNT(*) FILTER (WHERE type = 'ForkEvent') AS forks,
         COUNT(*) FILTER (WHERE type = 'PullRequestEvent') AS pull_requests,
         COUNT(*) FILTER (WHERE type = 'IssuesEvent') AS issues,
         MAX(created_at) AS last_event_at
  FROM numbered GROUP BY actor_id, actor_login, nth)"""
DRAINED = "(SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE"      # the final watermark

PAIRS = """pairs AS (
  SELECT p.repo_id, p.id AS push_id, p.created_at, s.id AS star_id, s.created_at AS star_at
  FROM ev p JOIN ev s ON s.repo_id = p.repo_id AND s.created_at >= p.created_at
    AND s.created_at <= p.created_at + INTERVAL 1 HOUR
  WHERE p.type = 'PushEvent' AND s.type = 'WatchEvent')"""

HOURLY = """h AS (
  SELECT repo_id, repo_name, date_trunc('hour', created_at) AS hour, COUNT(*) AS event_count
  FROM ev GROUP BY 1, 2, 3)"""


def _rolled(grain: str, by_type: bool) -> str:
    kind = "event_type" if by_type else "'(all)'"
    return f"""SELECT '{grain}' AS grain, date_trunc('{grain}', created_at)::TIMESTAMP AS period,
       {kind} AS event_type, language, COUNT(*) AS event_count
FROM said GROUP BY 1, 2, 3, 4"""


SQL.update({
    "session_activity": f"{BASE},\n{SESSIONS}\nSELECT * FROM sess",
    "stream_sessions": f"{BASE},\n{SESSIONS}\nSELECT * FROM sess WHERE window_end <= {DRAINED}",
    "push_then_star": f"{BASE},\n{PAIRS}\nSELECT * FROM pairs",
    "stream_push_then_star": f"""{BASE},
{PAIRS}
SELECT * FROM pairs
UNION ALL
SELECT repo_id, id, created_at, NULL, NULL FROM ev
WHERE type = 'PushEvent' AND id NOT IN (SELECT push_id FROM pairs)
  AND created_at + INTERVAL 1 HOUR < {DRAINED}""",
    "asof_repository_counters": f"""{BASE},
known AS (
  SELECT repo_id, created_at, stars, forks, open_issues FROM enr
  WHERE type IN ('IssuesEvent', 'PullRequestEvent') AND stars IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY repo_id, created_at ORDER BY id DESC) = 1)
SELECT l.id, l.repo_id, l.created_at, k.stars, k.forks, k.open_issues,
       k.created_at AS reported_at_as_of
FROM (SELECT * FROM enr WHERE type = 'WatchEvent') l
ASOF LEFT JOIN known k ON l.repo_id = k.repo_id AND l.created_at > k.created_at""",
    "events_in_incidents": f"""{BASE},
incidents AS (
  SELECT id AS incident_id, created_at AS began_at,
         created_at + (10 + repo_id % 7 * 50) * INTERVAL 1 MINUTE AS ended_at
  FROM ev WHERE type = 'IssuesEvent' AND repo_id % 20 = 3)
SELECT incident_id, id, type, repo_id, created_at
FROM ev JOIN incidents ON created_at >= began_at AND created_at < ended_at""",
    "user_distinct_repositories": f"""{BASE}
SELECT actor_id AS user_id, actor_login AS username, COUNT(*) AS total_events,
       COUNT(DISTINCT repo_id) AS distinct_repos FROM ev GROUP BY 1, 2""",
    "user_sketched_repositories": f"""{BASE}
SELECT actor_id AS user_id, actor_login AS username, COUNT(*) AS total_events,
       TRUE AS within_error FROM ev GROUP BY 1, 2""",
    "repository_trend": f"""{BASE},
{HOURLY}
SELECT h.repo_id, h.repo_name, h.hour::TIMESTAMP AS hour, h.event_count,
       rank() OVER (PARTITION BY h.hour ORDER BY h.event_count DESC) AS rank,
       h.event_count - coalesce(b.event_count, 0) AS change,
       CAST(SUM(h.event_count) OVER (
         PARTITION BY h.repo_id, h.repo_name ORDER BY h.hour
         RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS moving_24h
FROM h LEFT JOIN h b ON b.repo_id = h.repo_id AND b.repo_name = h.repo_name
  AND b.hour = h.hour - INTERVAL 1 HOUR""",
    "type_language_rollup": f"""{BASE},
said AS (SELECT created_at, type AS event_type,
                unnest(list_concat(['(all)'], list_distinct(languages))) AS language FROM enr)
""" + "\nUNION ALL\n".join(_rolled(g, t) for g in ("hour", "day", "month") for t in (True, False)),
    "build_in_parts": f"""{METRICS}
SELECT 'events' AS table_name, id AS entity, created_at AS at, 1::BIGINT AS n FROM ev
UNION ALL SELECT 'repository_metrics', repo_name, window_start, event_count FROM rm
UNION ALL SELECT 'event_type_distribution', event_type, window_start, event_count FROM et
UNION ALL SELECT 'user_activity', username, window_start,
                 event_count * 1000 + repos_contributed FROM ua
UNION ALL SELECT 'language_trends', language, window_start, event_count FROM lt
UNION ALL SELECT 'rejected_events', errors, TIMESTAMP '2024-01-01 00:00:00', COUNT(*)
FROM (SELECT CASE event_id % {D}
         WHEN 7 THEN 'repo.name' WHEN 13 THEN 'created_at' WHEN 33 THEN 'actor.id'
         WHEN 41 THEN 'collected_at'
         ELSE 'id,type,actor.id,actor.login,actor.url,actor.avatar_url,repo.id,repo.name,'
              || 'repo.url,public,created_at,payload' END AS errors
      FROM ev WHERE event_id % {D} IN (7, 13, 21, 33, 41)) bad GROUP BY errors""",
    "compare_lakes": f"""{BASE},
l AS (SELECT id, type, actor_id, repo_id, created_at, event_id FROM ev),
r AS (SELECT * REPLACE (CASE WHEN event_id % 499 = 5 THEN 'GollumEvent' ELSE type END AS type)
      FROM l WHERE event_id % 487 <> 3)
SELECT id, type, actor_id, repo_id, created_at, 'left' AS side, 1::BIGINT AS copies
FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) a
UNION ALL
SELECT id, type, actor_id, repo_id, created_at, 'right', 1
FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l) b""",
    "stream_enriched_events": f"""{BASE}
SELECT repo_name AS key, id, type, actor_id, actor_login, repo_id,
       date_trunc('milliseconds', created_at)::TIMESTAMP AS created_at,   -- as JSON text has it
       array_to_string(languages, ',') AS languages FROM enr""",
    "stream_heavy_hitters": f"""{BASE},
d AS (SELECT date_trunc('day', created_at)::TIMESTAMP AS window_start, repo_id,
             COUNT(*) AS event_count FROM ev GROUP BY 1, 2),
n AS (SELECT *, CAST(SUM(event_count) OVER (PARTITION BY window_start) AS BIGINT) AS window_events
      FROM d)
SELECT window_start, repo_id, event_count, window_events, TRUE AS within_bounds FROM n
WHERE event_count >= window_events * 0.013
  AND window_start + INTERVAL 1 DAY <= {DRAINED}""",
    "stream_repair": SQL["stream_repository_metrics_update"],
})
