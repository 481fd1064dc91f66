"""DuckDB SQL for the catalogue, written independently of the DataFrame code."""

from __future__ import annotations

from forgemeter import schemas
from forgemeter.sources.dimensions import ranking_rows

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_WEIGHTS = ", ".join(f"('{name}', {w})" for name, w in schemas.EVENT_WEIGHTS.items())
_RANKINGS = ", ".join(
    "('{language}', '{tier}', '{paradigm}', '{type}')".format(**r) for r in ranking_rows()
)

_CANON = f"""
canon AS (
  SELECT event_id, ts, epoch_us(ts) AS event_us,
    CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
      WHEN 'click' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent'
      WHEN 'error' THEN 'ReleaseEvent' END AS event_type,
    CASE WHEN user_id % 50 = 0 THEN '' ELSE 'user' || CAST(user_id AS VARCHAR) END AS actor_login,
    'org' || CAST({_K} % 10 AS VARCHAR) || '/repo' || CAST({_K} AS VARCHAR) AS repo_name,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS trend_weight,
    CASE WHEN {_K} % 11 = 0 THEN '' WHEN {_K} % 13 = 0 THEN 'Unlisted'
      WHEN {_K} % 5 = 0 THEN 'Python' WHEN {_K} % 5 = 1 THEN 'Java'
      WHEN {_K} % 5 = 2 THEN 'Scala' WHEN {_K} % 5 = 3 THEN 'Rust' ELSE 'HTML' END AS language
  FROM events)"""

_VALID = _CANON + """,
valid AS (
  SELECT * FROM canon
  WHERE repo_name IS NOT NULL
    AND event_type IN ('WatchEvent', 'ForkEvent', 'PushEvent', 'IssuesEvent',
                       'PullRequestEvent', 'CreateEvent', 'DeleteEvent')
    AND (trend_weight IS NULL OR trend_weight BETWEEN 0 AND 100))"""

_REPOS = _VALID + """,
repos AS (
  SELECT repo_name,
    COUNT(*) FILTER (event_type = 'WatchEvent') AS star_count,
    COUNT(*) FILTER (event_type = 'ForkEvent') AS fork_count,
    COUNT(*) FILTER (event_type = 'PushEvent') AS push_count,
    CAST(COALESCE(SUM(trend_weight) FILTER (event_type = 'PushEvent'), 0) AS BIGINT)
      AS push_weight,
    COUNT(*) AS activity_count,
    COUNT(DISTINCT actor_login) AS contributor_count,
    MAX(language) FILTER (language <> '') AS event_language
  FROM valid GROUP BY repo_name),
shown AS (SELECT * EXCLUDE (event_language) FROM repos WHERE repo_name <> '')"""

_ACTORS = _VALID + """,
actors AS (
  SELECT actor_login, COUNT(*) AS activity_count FROM valid
  WHERE actor_login IS NOT NULL GROUP BY actor_login),
people AS (SELECT * FROM actors WHERE actor_login <> '')"""

_WINDOWS = _VALID + """,
windows AS (
  SELECT window_start, window_start + 600000 AS window_end,
    COUNT(DISTINCT repo_name) AS repo_count,
    COUNT(*) FILTER (event_type = 'PushEvent') AS push_count
  FROM (SELECT *, (event_us // 300000000 - back) * 300000 AS window_start
        FROM valid, (VALUES (0), (1)) AS steps(back)) AS placed
  GROUP BY window_start),
new_repos AS (
  SELECT printf('%016d', window_start) AS row_key, repo_count AS count, window_start, window_end
  FROM windows),
push_speed AS (
  SELECT printf('%016d', window_start) AS row_key, push_count AS count, window_start, window_end
  FROM windows)"""

_LANGUAGES = _REPOS + f""",
rankings AS (SELECT * FROM (VALUES {_RANKINGS}) AS r(language, tier, paradigm, type)),
languages AS (
  SELECT event_language AS language, COALESCE(tier, '3') AS tier,
    COALESCE(paradigm, 'unknown') AS paradigm, COALESCE(type, 'unknown') AS lang_type,
    CAST(SUM(star_count) AS BIGINT) AS total_stars,
    CAST(SUM(fork_count) AS BIGINT) AS total_forks,
    CAST(SUM(push_count) AS BIGINT) AS total_pushes,
    CAST(SUM(activity_count) AS BIGINT) AS total_activity,
    COUNT(*) AS repo_count
  FROM repos LEFT JOIN rankings ON event_language = language
  WHERE event_language IS NOT NULL
  GROUP BY event_language, tier, paradigm, type)"""


def _compact(n: str) -> str:
    return (
        f"CASE WHEN {n} >= 1000000 THEN CAST({n} // 1000000 AS VARCHAR) || '.' "
        f"|| CAST({n} % 1000000 // 100000 AS VARCHAR) || 'M' "
        f"WHEN {n} >= 1000 THEN CAST({n} // 1000 AS VARCHAR) || '.' "
        f"|| CAST({n} % 1000 // 100 AS VARCHAR) || 'K' ELSE CAST({n} AS VARCHAR) END"
    )


_RANK_CLASS = (
    "CASE rank WHEN 1 THEN 'badge-warning' WHEN 2 THEN 'badge-neutral' "
    "WHEN 3 THEN 'badge-accent' ELSE 'badge-ghost' END AS rank_class"
)


def _repo_panel(order: str, metric: str) -> str:
    return f"""WITH {_REPOS},
snapshot AS (SELECT * FROM shown ORDER BY activity_count DESC, repo_name DESC LIMIT 100),
top AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM snapshot)
SELECT rank, {_RANK_CLASS}, repo_name, 'https://github.com/' || repo_name AS link,
  {metric} AS metric, {_compact(metric)} AS metric_text
FROM top WHERE rank <= 10"""


def _window_panel(table: str) -> str:
    return f"""WITH {_WINDOWS},
recent AS (SELECT * FROM {table} ORDER BY window_start DESC LIMIT 12)
SELECT window_start, strftime(make_timestamp(window_start * 1000), '%H:%M') AS label, count,
  MAX(count) OVER () AS max_value,
  CAST(count AS DOUBLE) / NULLIF(MAX(count) OVER (), 0) AS share
FROM recent"""


_FLAT = f"""
sent AS (
  SELECT *, {_K} AS k,
    CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
      WHEN 'click' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent'
      WHEN 'error' THEN 'ReleaseEvent' ELSE 'OtherEvent' END AS own_type,
    CASE WHEN {_K} % 2 = 0 THEN 'CreateEvent' ELSE 'IssuesEvent' END AS companion_type
  FROM events),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS id, own_type AS type, * FROM sent
  UNION ALL
  SELECT 'c' || CAST(event_id AS VARCHAR), companion_type, * FROM sent),
weights AS (SELECT * FROM (VALUES {_WEIGHTS}) AS w(event_type, weight)),
flat AS (
  SELECT id AS event_id, raw.type AS event_type, 'user' || CAST(user_id AS VARCHAR) AS actor_login,
    user_id AS actor_id, k AS repo_id, 'org/repo' || CAST(k AS VARCHAR) AS repo_name,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    CAST(COALESCE(weight, 0) AS BIGINT) AS trend_weight,
    CASE raw.type WHEN 'PushEvent' THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS push_size,
    CASE raw.type WHEN 'PushEvent' THEN 'refs/heads/b' || CAST(k AS VARCHAR) ELSE '' END
      AS push_ref,
    CASE raw.type WHEN 'CreateEvent' THEN CASE WHEN k % 2 = 0 THEN 'branch' ELSE 'tag' END
      ELSE '' END AS ref_type,
    CASE raw.type WHEN 'ForkEvent' THEN 'fork/' || CAST(raw.event_id AS VARCHAR) ELSE '' END
      AS fork_repo,
    CASE raw.type WHEN 'ReleaseEvent' THEN 'v' || CAST(raw.event_id AS VARCHAR) ELSE '' END
      AS release_tag,
    CASE raw.type WHEN 'PullRequestEvent'
      THEN CASE WHEN k % 3 = 0 THEN 'opened' ELSE 'closed' END ELSE '' END AS pr_action,
    CASE raw.type WHEN 'IssuesEvent'
      THEN CASE WHEN k % 3 = 0 THEN 'opened' ELSE 'closed' END ELSE '' END AS issue_action
  FROM raw LEFT JOIN weights ON raw.type = weights.event_type)"""

_BY_REPO = """
by_repo AS (
  SELECT repo_name, MAX(language) AS language FROM canon WHERE language <> '' GROUP BY repo_name)"""


def _list_json(table: str, fields: dict[str, str], texts: set[str], order: str) -> str:
    parts = []
    for column, name in fields.items():
        value = f"'\"' || {column} || '\"'" if column in texts else f"CAST({column} AS VARCHAR)"
        parts.append(f"'\"{name}\":' || {value}")
    item = "'{' || " + " || ',' || ".join(parts) + " || '}'"
    return f"(SELECT COALESCE(string_agg({item}, ',' ORDER BY {order}), '') FROM {table})"


_WINDOW_JSON = {"window_start": "windowStart", "window_end": "windowEnd"}
_TEXTS = {"repo_name", "language", "tier", "paradigm", "lang_type", "actor_login"}


def _message(seq: int, kind: str, name: str, items: str) -> str:
    return (
        f"SELECT '{kind}' AS type, '{{\"type\":\"{kind}\",\"{name}\":[' || {items} || ']}}' AS body,"
        f" CAST({seq} AS BIGINT) AS seq"
    )


def _cte(*parts: str) -> str:
    """Several CTE chains that begin alike, with the common beginning once."""
    out = parts[0]
    for part in parts[1:]:
        out += part.removeprefix(_VALID)
    return out


_ALL = _cte(_LANGUAGES, _ACTORS, _WINDOWS)

_SERVER_MESSAGES = f"""WITH {_ALL},
w1 AS (SELECT * FROM new_repos ORDER BY window_start DESC LIMIT 24),
w2 AS (SELECT * FROM push_speed ORDER BY window_start DESC LIMIT 24),
top_r AS (SELECT * FROM shown ORDER BY activity_count DESC, repo_name DESC LIMIT 100),
top_a AS (SELECT * FROM people ORDER BY activity_count DESC, actor_login DESC LIMIT 50)
""" + "\nUNION ALL ".join(
    [
        _message(
            0,
            "Snapshot",
            "windows",
            _list_json("w1", _WINDOW_JSON | {"count": "count"}, _TEXTS, "window_start DESC"),
        ),
        _message(
            1,
            "PushSpeedSnapshot",
            "windows",
            _list_json("w2", _WINDOW_JSON | {"count": "pushCount"}, _TEXTS, "window_start DESC"),
        ),
        _message(
            2,
            "RepoStatsSnapshot",
            "repos",
            _list_json(
                "top_r",
                {
                    "repo_name": "repoName",
                    "star_count": "starCount",
                    "fork_count": "forkCount",
                    "push_count": "pushCount",
                    "push_weight": "pushWeight",
                    "activity_count": "activityCount",
                    "contributor_count": "contributorCount",
                },
                _TEXTS,
                "activity_count DESC, repo_name DESC",
            ),
        ),
        _message(
            3,
            "LanguageStatsSnapshot",
            "languages",
            _list_json(
                "languages",
                {
                    "language": "language",
                    "tier": "tier",
                    "paradigm": "paradigm",
                    "lang_type": "langType",
                    "total_stars": "totalStars",
                    "total_forks": "totalForks",
                    "total_pushes": "totalPushes",
                    "total_activity": "totalActivity",
                    "repo_count": "repoCount",
                },
                _TEXTS,
                "language",
            ),
        ),
        _message(
            4,
            "ActorStatsSnapshot",
            "actors",
            _list_json(
                "top_a",
                {"actor_login": "actorLogin", "activity_count": "activityCount"},
                _TEXTS,
                "activity_count DESC, actor_login DESC",
            ),
        ),
    ]
)


def _window_message(seq: int, kind: str, measure: str, name: str) -> str:
    return (
        f"SELECT '{kind}' AS type, '{{\"type\":\"{kind}\",\"window\":{{\"windowStart\":' "
        f"|| CAST(window_start AS VARCHAR) || ',\"windowEnd\":' || CAST(window_end AS VARCHAR) "
        f"|| ',\"{name}\":' || CAST({measure} AS VARCHAR) || '}}}}' AS body, "
        f"CAST({seq} AS BIGINT) AS seq FROM windows"
    )


_TOP_REPOS = f"WITH {_REPOS} SELECT * FROM shown ORDER BY activity_count DESC, repo_name DESC LIMIT 100"
_NO_CONTRIBUTORS = "* EXCLUDE (contributor_count)"

ORACLES: dict[str, str] = {
    "clean_events": f"""WITH {_VALID}
SELECT event_id, event_type, actor_login, repo_name, trend_weight, language, event_us
FROM valid""",
    "anomaly_counts": f"""WITH {_CANON}
SELECT event_type,
  CASE WHEN repo_name IS NULL THEN 'missing_repo' WHEN event_type IS NULL THEN 'missing_type'
    WHEN event_type NOT IN ('WatchEvent', 'ForkEvent', 'PushEvent', 'IssuesEvent',
      'PullRequestEvent', 'CreateEvent', 'DeleteEvent') THEN 'unknown_type'
    WHEN trend_weight < 0 OR trend_weight > 100 THEN 'extreme_weight' ELSE 'kept' END AS verdict,
  COUNT(*) AS events
FROM canon GROUP BY 1, 2""",
    "envelope_round_trip": f"""WITH {_CANON}
SELECT event_type, actor_login, repo_name, trend_weight, language, event_us FROM canon""",
    "envelope_clean_events": f"""WITH {_VALID}
SELECT event_type, actor_login, repo_name, trend_weight, language, event_us // 1000 AS event_ms
FROM valid""",
    "raw_event_flatten": f"WITH {_FLAT} SELECT * FROM flat",
    "ingest_records": f"""WITH {_CANON}, {_FLAT}, {_BY_REPO},
by_short AS (
  SELECT 'org/' || split_part(repo_name, '/', 2) AS repo_name, language FROM by_repo)
SELECT event_id AS key, event_type, flat.repo_name, COALESCE(language, '') AS language,
  trend_weight
FROM flat LEFT JOIN by_short USING (repo_name)""",
    "trend_weight_lookup": f"""WITH {_CANON},
weights AS (SELECT * FROM (VALUES {_WEIGHTS}) AS w(event_type, weight)),
both_kinds AS (
  SELECT event_id, event_type FROM canon UNION ALL SELECT event_id, event_type FROM events)
SELECT event_id, event_type, CAST(COALESCE(weight, 0) AS BIGINT) AS weight
FROM both_kinds LEFT JOIN weights USING (event_type)""",
    "repo_language_lookup": f"""WITH {_CANON}, {_BY_REPO},
asked AS (
  SELECT event_id, CASE WHEN actor_login = '' THEN '' ELSE repo_name END AS repo_name FROM canon)
SELECT event_id, repo_name, COALESCE(language, '') AS language
FROM asked LEFT JOIN by_repo USING (repo_name)""",
    "dedup_events": f"""WITH {_CANON},
copies AS (
  SELECT * EXCLUDE (ts), event_us AS ingest_us FROM canon
  UNION ALL
  SELECT * EXCLUDE (ts) REPLACE (language || '-late' AS language), event_us + 1 FROM canon)
SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_us) = 1""",
    "next_page_link": """SELECT page_id,
  CASE WHEN length(url) % 2 = 0 THEN url || '?page=3' END AS next_url FROM pages""",
    "repo_stats": f"WITH {_REPOS} SELECT * FROM repos",
    "repo_contributors_approx": f"""WITH {_REPOS}
SELECT repo_name, contributor_count, TRUE AS approx_ok FROM repos""",
    "actor_stats": f"WITH {_ACTORS} SELECT * FROM actors",
    "window_activity": f"WITH {_WINDOWS} SELECT * FROM windows",
    "window_repos_approx": f"""WITH {_WINDOWS}
SELECT window_start, repo_count, TRUE AS approx_ok FROM windows""",
    "new_repos_per_window": f"WITH {_WINDOWS} SELECT * FROM new_repos",
    "push_speed_per_window": f"WITH {_WINDOWS} SELECT * FROM push_speed",
    "language_stats": f"WITH {_LANGUAGES} SELECT * FROM languages",
    "string_cells_round_trip": f"""WITH {_ACTORS}
SELECT actor_login, activity_count, CAST(activity_count AS VARCHAR) AS activity_text,
  CAST(0 AS BIGINT) AS absent_count, '' AS absent_text FROM actors""",
    "result_tables": f"""WITH {_ALL}
SELECT 'new_repos_per_window' AS table_name, COUNT(*) AS row_count FROM windows
UNION ALL SELECT 'push_speed_per_window', COUNT(*) FROM windows
UNION ALL SELECT 'repo_stats', COUNT(*) FROM shown
UNION ALL SELECT 'actor_stats', COUNT(*) FROM people
UNION ALL SELECT 'language_stats', COUNT(*) FROM languages""",
    "top_repos_snapshot": f"""WITH {_REPOS},
scanned AS (SELECT * FROM shown ORDER BY repo_name LIMIT 40)
SELECT * FROM scanned ORDER BY activity_count DESC, repo_name DESC LIMIT 20""",
    "top_repos_global": _TOP_REPOS,
    "top_actors_snapshot": f"""WITH {_ACTORS},
scanned AS (SELECT * FROM people ORDER BY actor_login LIMIT 100)
SELECT * FROM scanned ORDER BY activity_count DESC, actor_login DESC LIMIT 50""",
    "top_actors_global": f"""WITH {_ACTORS}
SELECT * FROM people ORDER BY activity_count DESC, actor_login DESC LIMIT 50""",
    "recent_new_repo_windows": f"""WITH {_WINDOWS}
SELECT * FROM new_repos ORDER BY window_start DESC LIMIT 24""",
    "recent_push_windows": f"""WITH {_WINDOWS}
SELECT * FROM push_speed ORDER BY window_start DESC LIMIT 24""",
    "windows_since": f"""WITH {_WINDOWS}
SELECT * FROM push_speed WHERE window_start > 1705276800000 ORDER BY window_start""",
    "top10_repos_activity": _repo_panel("activity_count DESC, repo_name", "activity_count"),
    "top10_repos_stars": _repo_panel("star_count DESC, activity_count, repo_name", "star_count"),
    "top10_repos_forks": _repo_panel("fork_count DESC, activity_count, repo_name", "fork_count"),
    "top10_contributors": f"""WITH {_ACTORS},
snapshot AS (SELECT * FROM people ORDER BY activity_count DESC, actor_login DESC LIMIT 50),
top AS (
  SELECT *, row_number() OVER (ORDER BY activity_count DESC, actor_login) AS rank FROM snapshot)
SELECT rank, {_RANK_CLASS}, actor_login, 'https://github.com/' || actor_login AS link,
  activity_count, {_compact('activity_count')} AS activity_text
FROM top WHERE rank <= 10""",
    "top10_languages": f"""WITH {_LANGUAGES},
top AS (
  SELECT *, row_number() OVER (ORDER BY total_activity DESC, language DESC) AS rank
  FROM languages)
SELECT rank, {_RANK_CLASS}, language, paradigm,
  CASE paradigm WHEN 'functional' THEN 'badge-secondary'
    WHEN 'object-oriented' THEN 'badge-primary' WHEN 'systems' THEN 'badge-error'
    WHEN 'concurrent' THEN 'badge-accent' ELSE 'badge-ghost' END AS paradigm_class,
  CASE tier WHEN '1' THEN 'Tier 1' WHEN '2' THEN 'Tier 2' ELSE 'Tier 3' END AS tier_label,
  {_compact('total_stars')} AS total_stars_text, {_compact('total_forks')} AS total_forks_text,
  {_compact('total_pushes')} AS total_pushes_text, total_activity, repo_count
FROM top WHERE rank <= 10""",
    "overview_totals": f"""WITH {_REPOS},
snapshot AS (SELECT * FROM shown ORDER BY activity_count DESC, repo_name DESC LIMIT 100),
totals AS (
  SELECT COUNT(*) AS repos, CAST(SUM(star_count) AS BIGINT) AS stars,
    CAST(SUM(fork_count) AS BIGINT) AS forks, CAST(SUM(push_count) AS BIGINT) AS pushes,
    CAST(SUM(contributor_count) AS BIGINT) AS contributors FROM snapshot)
SELECT *, {_compact('stars')} AS stars_text, {_compact('forks')} AS forks_text,
  {_compact('pushes')} AS pushes_text, {_compact('contributors')} AS contributors_text
FROM totals""",
    "window_panel_new_repos": _window_panel("new_repos"),
    "window_panel_push_speed": _window_panel("push_speed"),
    "gate_history": f"""WITH {_VALID},
days AS (
  SELECT DISTINCT (event_us // 86400000000 + 1) * 86400000 AS refreshed_at FROM valid),
marks AS (
  SELECT refreshed_at, MAX(n) AS high_water FROM (
    SELECT refreshed_at, repo_name, COUNT(*) AS n
    FROM days JOIN valid ON event_us < refreshed_at * 1000
    GROUP BY refreshed_at, repo_name) AS counted
  GROUP BY refreshed_at)
SELECT refreshed_at, high_water,
  high_water > COALESCE(lag(high_water) OVER (ORDER BY refreshed_at), 0) AS sent
FROM marks""",
    "gate_history_fine": f"""WITH {_VALID},
steps AS (
  SELECT repo_name, (event_us // 5000000 + 1) * 5000 AS refreshed_at, COUNT(*) AS n
  FROM valid GROUP BY 1, 2),
totals AS (
  SELECT refreshed_at, SUM(n) OVER (PARTITION BY repo_name ORDER BY refreshed_at) AS total FROM steps),
peaks AS (SELECT refreshed_at, CAST(MAX(total) AS BIGINT) AS peak FROM totals GROUP BY refreshed_at),
marks AS (
  SELECT *, COALESCE(MAX(peak) OVER (
    ORDER BY refreshed_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM peaks)
SELECT refreshed_at, greatest(peak, before) AS high_water, peak > before AS sent FROM marks""",
    "long_language_messages": f"""WITH {_CANON},
names AS (
  SELECT prefix || CAST(event_id AS VARCHAR) AS language
  FROM canon, (VALUES ('lang'), ('Lang')) AS p(prefix)),
placed AS (
  SELECT language, row_number() OVER (ORDER BY language) - 1 AS place, COUNT(*) OVER () AS n FROM names)
SELECT CASE WHEN n > 10000 THEN place // 10000 + 1 END AS part,
  CASE WHEN n > 10000 THEN (n - 1) // 10000 + 1 END AS parts, COUNT(*) AS row_count,
  MIN(language) AS first_language, MAX(language) AS last_language, COUNT(*) AS total_activity
FROM placed GROUP BY n, place // 10000""",
    "server_messages": _SERVER_MESSAGES,
    "window_messages": f"WITH {_WINDOWS} "
    + _window_message(0, "NewWindow", "repo_count", "count")
    + " UNION ALL "
    + _window_message(1, "PushSpeedNewWindow", "push_count", "pushCount"),
    "decoded_messages": f"""WITH {_WINDOWS}
SELECT window_start, window_end, push_count AS count FROM windows""",
    "stream_window_activity": f"WITH {_WINDOWS} SELECT * FROM push_speed",
    "stream_repo_stats": f"WITH {_REPOS} SELECT {_NO_CONTRIBUTORS} FROM repos",
    "stream_language_stats": f"WITH {_LANGUAGES} SELECT * FROM languages",
    "stream_repo_updates": f"SELECT {_NO_CONTRIBUTORS} FROM ({_TOP_REPOS}) AS top",
    "stream_window_messages": "SELECT type, body FROM (WITH "
    + _WINDOWS
    + " "
    + _window_message(1, "PushSpeedNewWindow", "push_count", "pushCount")
    + ") AS sent",
    "stream_repo_messages": f"SELECT {_NO_CONTRIBUTORS} FROM ({_TOP_REPOS}) AS top",
    "stream_all_messages": f"""SELECT 'NewWindow' AS type, CAST(window_start AS VARCHAR) AS key,
  CAST(NULL AS BIGINT) AS count FROM (WITH {_WINDOWS} SELECT * FROM new_repos) AS a
UNION ALL SELECT 'PushSpeedNewWindow', CAST(window_start AS VARCHAR), count
FROM (WITH {_WINDOWS} SELECT * FROM push_speed) AS b
UNION ALL SELECT 'RepoStatsUpdated', repo_name, activity_count FROM ({_TOP_REPOS}) AS c
UNION ALL SELECT 'ActorStatsUpdated', actor_login, activity_count FROM (
  WITH {_ACTORS} SELECT * FROM people ORDER BY activity_count DESC, actor_login DESC LIMIT 50) AS d
UNION ALL SELECT 'LanguageStatsSnapshot', language, total_activity
FROM (WITH {_LANGUAGES} SELECT * FROM languages) AS e""",
    "stream_actor_stats": f"WITH {_ACTORS} SELECT * FROM people",
    "stream_dedup": f"WITH {_CANON} SELECT * EXCLUDE (ts) FROM canon",
    "stream_incremental_windows": f"""WITH {_WINDOWS}
SELECT *, CAST(0 AS BIGINT) AS round FROM push_speed""",
    "stream_changes_feed": f"""WITH {_ACTORS},
steps AS (
  SELECT actor_login, event_id % 4 AS batch_id, COUNT(*) AS n FROM valid
  WHERE actor_login IS NOT NULL GROUP BY 1, 2)
SELECT actor_login, CAST(SUM(n) OVER (PARTITION BY actor_login ORDER BY batch_id) AS BIGINT)
  AS activity_count, CAST(batch_id AS BIGINT) AS batch_id FROM steps
UNION ALL SELECT actor_login, activity_count, CAST(4 AS BIGINT) FROM actors""",
    "stream_language_changes": "WITH " + _LANGUAGES.replace(
        "MAX(language) FILTER (language <> '') AS event_language",
        """MAX(CASE WHEN event_id % 4 = 2 AND repo_name LIKE '%3' THEN 'Swift'
      WHEN event_id % 4 = 3 AND repo_name LIKE '%1' THEN 'TypeScript'
      WHEN language <> '' THEN language END) AS event_language""",
    ) + " SELECT * FROM languages",
    "window_activity_panes": f"""WITH {_VALID}
SELECT (event_us // 300000000 - back) * 300000 AS window_start,
  (event_us // 300000000 - back) * 300000 + 3600000 AS window_end,
  COUNT(DISTINCT repo_name) AS repo_count,
  COUNT(*) FILTER (event_type = 'PushEvent') AS push_count
FROM valid, range(12) AS steps(back) GROUP BY 1, 2""",
    "ingest_twice": f"""WITH {_FLAT}
SELECT flat.*, CAST(CASE WHEN CAST(ltrim(event_id, 'c') AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS BIGINT)
  AS run
FROM flat""",
    "stream_late_events": """WITH mark AS (
  SELECT epoch_us(max(ts)) // 1000 * 1000 - 86400000000 AS late_us FROM events),
sent AS (
  SELECT ts, false AS again FROM events
  UNION ALL SELECT ts, true FROM events WHERE event_id % 10 = 0),
judged AS (SELECT ts, again AND epoch_us(ts) <= late_us AS is_late FROM sent, mark)
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS event_count FROM judged WHERE NOT is_late GROUP BY 1
UNION ALL SELECT 'late', COUNT(*) FILTER (is_late) FROM judged""",
    "contributors_by_range": f"""WITH {_VALID},
ranges(range_id, first_ms, end_ms) AS (VALUES ('all', 0, 4102444800000),
  ('fortnight', 1704672000000, 1705881600000), ('day', 1705276800000, 1705363200000),
  ('half_day', 1705280700000, 1705323900000))
SELECT range_id, COUNT(*) AS event_count, COUNT(*) FILTER (event_type = 'PushEvent') AS push_count,
  COUNT(DISTINCT repo_name) AS repo_count, COUNT(DISTINCT actor_login) AS contributor_count,
  true AS approx_ok
FROM valid JOIN ranges ON event_us >= first_ms * 1000 AND event_us < end_ms * 1000 GROUP BY range_id""",
    "compacted_reads": f"""WITH {_REPOS}
SELECT {_NO_CONTRIBUTORS} FROM repos,
  (VALUES ('merged'), ('vacuumed'), ('leased'), ('folded')) AS states(state)""",
    "rebuilt_tables": f"""WITH {_REPOS},
counted AS (
  SELECT repo_name, half, COUNT(*) FILTER (event_type = 'WatchEvent') AS star_count,
    COUNT(*) FILTER (event_type = 'ForkEvent') AS fork_count,
    COUNT(*) FILTER (event_type = 'PushEvent') AS push_count, COUNT(*) AS activity_count,
    MAX(language) FILTER (language <> '') AS event_language
  FROM valid, (VALUES (false), (true)) AS h(half) WHERE NOT half OR event_id % 2 = 0
  GROUP BY repo_name, half),
merged AS (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY repo_name ORDER BY half DESC) = 1),
people AS (
  SELECT actor_login, half, COUNT(*) AS activity_count
  FROM valid, (VALUES (false), (true)) AS h(half)
  WHERE actor_login <> '' AND (NOT half OR event_id % 2 = 0) GROUP BY actor_login, half)
SELECT 'repo_stats' AS table_name, repo_name AS key, star_count, fork_count, push_count, activity_count
FROM merged WHERE repo_name <> ''
UNION ALL SELECT 'actor_stats', actor_login, NULL, NULL, NULL, activity_count FROM (
  SELECT * FROM people QUALIFY row_number() OVER (PARTITION BY actor_login ORDER BY half DESC) = 1)
UNION ALL SELECT 'language_stats', event_language, CAST(SUM(star_count) AS BIGINT),
  CAST(SUM(fork_count) AS BIGINT), CAST(SUM(push_count) AS BIGINT), CAST(SUM(activity_count) AS BIGINT)
FROM merged WHERE event_language IS NOT NULL GROUP BY event_language""",
}
