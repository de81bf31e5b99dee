"""The same results in plain SQL over the test tables, written independently of Spark.

Every statement starts from the common expressions below, in the order listed.
"""

from __future__ import annotations

D, E = "DATE '2024-01-30'", "DATE '2024-01-25'"

COMMON = {
    "ev": """
        SELECT event_id, ts, CAST(user_id AS VARCHAR) AS usr, event_type,
               CAST(trunc(value) AS BIGINT) AS amount,
               ['en','fr','de','es','ru'][user_id % 5 + 1] || '.wikipedia' AS page,
               'T' || CASE WHEN k < 30 THEN k // 10 ELSE 3 + (event_id * 7 + k) % 4000 END AS title
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
    "ed": """
        SELECT ts AS timestamp_utc, page || '.org' AS project, event_id AS rev_id, title, usr,
               amount AS edit_size
        FROM ev WHERE event_type IN ('click', 'purchase', 'error')""",
    "vw": """
        SELECT date_trunc('hour', ts) AS hour_utc, page AS project, title, amount AS views
        FROM ev WHERE event_type = 'view'
        UNION ALL
        SELECT date_trunc('hour', ts), page, '-', amount FROM ev WHERE event_type IN ('view', 'signup')""",
    "tp": """
        SELECT * FROM (
            SELECT date_trunc('day', hour_utc) AS date_utc, project,
                   row_number() OVER (PARTITION BY date_trunc('day', hour_utc), project
                                      ORDER BY sum(views) DESC, title) AS rank,
                   title AS article, CAST(sum(views) AS BIGINT) AS views
            FROM vw WHERE title <> '-' GROUP BY 1, 2, title)
        WHERE rank <= 5""",
    "ids": """
        SELECT DISTINCT project, title,
               CASE WHEN title <> 'T9' THEN 'Q' || substring(title, 2) END AS wikidata_id
        FROM ed""",
}


def aggregated(source: str, by: str = "") -> str:
    return f"""
        SELECT {by} project, title, count(*) AS edit_count,
               CAST(sum(abs(edit_size)) AS BIGINT) AS total_edit_size,
               count(DISTINCT usr) AS unique_editors,
               min(timestamp_utc) AS first_edit, max(timestamp_utc) AS last_edit,
               CASE WHEN epoch_us(max(timestamp_utc)) // 1000000 > epoch_us(min(timestamp_utc)) // 1000000
                    THEN round(count(*) / (epoch_us(max(timestamp_utc)) // 1000000
                                           - epoch_us(min(timestamp_utc)) // 1000000) * 60, 4)
                    ELSE CAST(count(*) AS DOUBLE) END AS edit_velocity
        FROM {source} GROUP BY {by} project, title"""


def z_score_days(metric: str) -> str:
    """Baseline and exact z of a metric for each article on each day, over the observed days of its window."""
    return f"""
        SELECT g.day, g.project, g.title, median(g.n) AS baseline,
               (any_value(g.today) - median(g.n)) / greatest(1.4826 * mad(g.n), 1.0) AS z
        FROM (SELECT a.day, a.project, a.title, a.{metric} AS today, CAST(coalesce(h.{metric}, 0) AS DOUBLE) AS n
              FROM agg_days a JOIN obs_days o ON o.day >= a.day - 28 AND o.day < a.day
              LEFT JOIN agg_days h ON h.project = a.project AND h.title = a.title AND h.day = o.day) g
        GROUP BY 1, 2, 3"""


def joined(edits: str, views: str, top: str) -> str:
    return f"""
        SELECT a.title, a.project AS edit_project, replace(a.project, '.org', '') AS pageview_project,
               a.edit_count, a.total_edit_size, a.unique_editors, a.first_edit, a.last_edit,
               a.edit_velocity, i.wikidata_id,
               CAST(coalesce(v.views, 0) AS BIGINT) AS pageviews,
               CAST(coalesce(r.rank, 9999) AS BIGINT) AS pageview_rank
        FROM ({aggregated(edits)}) a
        LEFT JOIN ids i ON i.project = a.project AND i.title = a.title
        LEFT JOIN (SELECT project, title, sum(views) AS views FROM {views} WHERE title <> '-'
                   GROUP BY ALL) v
               ON v.project || '.org' = a.project AND v.title = a.title
        LEFT JOIN (SELECT project, article, min(rank) AS rank FROM {top} GROUP BY ALL) r
               ON r.project || '.org' = a.project AND r.article = a.title"""


def z_score(metric: str) -> str:
    """Baseline and exact z of a metric over the dense grid of articles and observed days."""
    return f"""
        SELECT g.project, g.title, median(g.n) AS baseline,
               (any_value(g.today) - median(g.n)) / greatest(1.4826 * mad(g.n), 1.0) AS z
        FROM (SELECT t.project, t.title, t.{metric} AS today,
                     CAST(coalesce(h.{metric}, 0) AS DOUBLE) AS n
              FROM agg_today t CROSS JOIN obs
              LEFT JOIN hist h ON h.project = t.project AND h.title = t.title AND h.day = obs.day) g
        GROUP BY 1, 2"""


COMMON |= {
    "ed_today": f"SELECT * FROM ed WHERE CAST(timestamp_utc AS DATE) = {D}",
    "ed_past": f"""
        SELECT *, strftime(timestamp_utc, '%Y%m%d') AS day FROM ed
        WHERE timestamp_utc >= {D} - INTERVAL 28 DAY AND timestamp_utc < {D}""",
    "vw_today": f"SELECT * FROM vw WHERE CAST(hour_utc AS DATE) = {D}",
    "tp_today": f"SELECT * FROM tp WHERE CAST(date_utc AS DATE) = {D}",
    "obs": "SELECT DISTINCT day FROM ed_past",
    "hist": """
        SELECT p.project, p.title, p.day, count(*) AS edit_count, count(DISTINCT p.usr) AS unique_editors
        FROM ed_past p WHERE (p.project, p.title) IN (SELECT (project, title) FROM ed_today)
        GROUP BY ALL""",
    "agg_today": aggregated("ed_today"),
    "emg": f"""
        SELECT t.project, t.title, t.edit_count, t.unique_editors,
               CAST((SELECT count(*) FROM obs) AS INTEGER) AS history_days,
               e.baseline AS baseline_editors,
               e.z >= 2.0 AND t.unique_editors >= 3 AS is_emerging,
               round_even(e.z * 100, 0) / 100 AS z_editors,
               round_even(c.z * 100, 0) / 100 AS z_edits,
               round_even(e.z * 100, 0) / 100 AS anomaly_score
        FROM agg_today t
        JOIN ({z_score("unique_editors")}) e USING (project, title)
        JOIN ({z_score("edit_count")}) c USING (project, title)""",
    "scored": f"""
        SELECT j.*, round(j.edit_count * j.unique_editors / ln(j.pageviews + 2), 4) AS trending_score,
               g.history_days, g.baseline_editors, g.is_emerging, g.z_editors, g.z_edits, g.anomaly_score,
               coalesce(j.wikidata_id, j.edit_project || '|' || j.title) AS entity_key
        FROM ({joined("ed_today", "vw_today", "tp_today")}) j
        JOIN emg g ON g.project = j.edit_project AND g.title = j.title""",
}


def signature(source: str, by: str = "") -> str:
    """Languages per entity (and day), joined back to its articles."""
    return f"""
        SELECT s.*, l.language_count, l.languages_editing, l.first_language,
               round_even((epoch_us(s.first_edit) - epoch_us(l.entity_first)) / 60000000.0 * 10, 0) / 10
                   AS language_lag_minutes
        FROM {source} s JOIN (
            SELECT {by} entity_key, count(*) AS language_count,
                   string_agg(edit_project, ',' ORDER BY first_edit, edit_project) AS languages_editing,
                   arg_min(edit_project, (first_edit, edit_project)) AS first_language,
                   min(first_edit) AS entity_first
            FROM (SELECT {by} entity_key, edit_project, min(first_edit) AS first_edit FROM {source} GROUP BY ALL)
            GROUP BY {by} entity_key) l USING ({by} entity_key)"""


def events(source: str, by: str = "") -> str:
    return f"""
        SELECT {by} wikidata_id, any_value(language_count) AS language_count,
               any_value(languages_editing) AS languages_editing, any_value(first_language) AS first_language,
               min(first_edit) AS first_edit, max(language_lag_minutes) AS spread_minutes,
               string_agg(split_part(edit_project, '.', 1) || ':' || title, ' | '
                          ORDER BY first_edit, edit_project, title) AS titles,
               CAST(sum(edit_count) AS BIGINT) AS total_edits,
               CAST(sum(unique_editors) AS BIGINT) AS sum_editors,
               CAST(sum(pageviews) AS BIGINT) AS total_pageviews,
               CAST(sum(CASE WHEN is_emerging THEN 1 ELSE 0 END) AS INTEGER) AS emerging_languages,
               bool_or(is_emerging) AS is_emerging
        FROM {source} WHERE wikidata_id IS NOT NULL AND language_count >= 2 GROUP BY {by} wikidata_id"""


COMMON |= {
    "trd": signature("scored"),
    # the same for every day at once
    "edd": "SELECT *, CAST(timestamp_utc AS DATE) AS day FROM ed",
    "agg_days": aggregated("edd", "day,"),
    "obs_days": "SELECT DISTINCT day FROM edd",
    "known_days": "SELECT a.day, count(o.day) AS n FROM obs_days a LEFT JOIN obs_days o ON o.day >= a.day - 28 AND o.day < a.day GROUP BY 1",
    "emg_days": f"""
        SELECT a.*, CAST(k.n AS INTEGER) AS history_days, CASE WHEN k.n >= 3 THEN e.baseline END AS baseline_editors,
               coalesce(k.n >= 3 AND e.z >= 2.0 AND a.unique_editors >= 3, FALSE) AS is_emerging,
               CASE WHEN k.n >= 3 THEN round_even(e.z * 100, 0) / 100 END AS z_editors,
               CASE WHEN k.n >= 3 THEN round_even(c.z * 100, 0) / 100 END AS z_edits,
               CASE WHEN k.n >= 3 THEN round_even(e.z * 100, 0) / 100 END AS anomaly_score
        FROM agg_days a JOIN known_days k USING (day)
        LEFT JOIN ({z_score_days("unique_editors")}) e USING (day, project, title)
        LEFT JOIN ({z_score_days("edit_count")}) c USING (day, project, title)""",
    "scored_days": """
        SELECT a.* EXCLUDE (project), a.project AS edit_project, replace(a.project, '.org', '') AS pageview_project,
               i.wikidata_id, coalesce(v.views, 0) AS pageviews, coalesce(r.rank, 9999) AS pageview_rank,
               round(a.edit_count * a.unique_editors / ln(coalesce(v.views, 0) + 2), 4) AS trending_score,
               coalesce(i.wikidata_id, a.project || '|' || a.title) AS entity_key
        FROM emg_days a
        LEFT JOIN ids i ON i.project = a.project AND i.title = a.title
        LEFT JOIN (SELECT CAST(hour_utc AS DATE) AS day, project, title, CAST(sum(views) AS BIGINT) AS views
                   FROM vw WHERE title <> '-' GROUP BY ALL) v
               ON v.day = a.day AND v.project || '.org' = a.project AND v.title = a.title
        LEFT JOIN (SELECT CAST(date_utc AS DATE) AS day, project, article, CAST(min(rank) AS BIGINT) AS rank FROM tp GROUP BY ALL) r
               ON r.day = a.day AND r.project || '.org' = a.project AND r.article = a.title
        WHERE a.day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'""",
    "trd_days": signature("scored_days", "day,"),
    "clv": events("trd"),
    "clv_days": events("trd_days", "day, "),
    # lead-lag: hours of the window, one row per article and hour, one per article and lag
    "eh": f"""
        SELECT replace(project, '.org', '') AS project, title,
               CAST(date_diff('hour', {E}, date_trunc('hour', timestamp_utc)) AS INTEGER) AS slot,
               count(*) AS edits
        FROM ed WHERE timestamp_utc >= {E} AND timestamp_utc < {E} + INTERVAL 48 HOUR GROUP BY ALL""",
    "act": """
        SELECT project, title, CAST(sum(edits) AS BIGINT) AS event_edits FROM eh WHERE slot < 24
        GROUP BY 1, 2 HAVING sum(edits) >= 3""",
    "vh": f"""
        SELECT project, title, CAST(date_diff('hour', {E}, hour_utc) AS INTEGER) AS slot,
               CAST(sum(views) AS BIGINT) AS views
        FROM vw WHERE hour_utc >= {E} AND hour_utc < {E} + INTERVAL 48 HOUR GROUP BY ALL""",
    "fac": """
        SELECT project, slot, factor FROM (
            SELECT project, slot, views / avg(views) OVER (PARTITION BY project) AS factor
            FROM vh WHERE title = '-')
        WHERE factor <> 0""",
    "vadj": """
        SELECT v.project, v.title, v.slot, v.views, v.views / coalesce(f.factor, 1.0) AS views_adj
        FROM vh v LEFT JOIN fac f USING (project, slot) WHERE v.title <> '-'""",
    "grid": """
        SELECT a.project, a.title, h.slot, coalesce(e.edits, 0) AS e, coalesce(v.views_adj, 0.0) AS v,
               coalesce(v.views, 0) AS raw
        FROM act a CROSS JOIN (SELECT CAST(range AS INTEGER) AS slot FROM range(48)) h
        LEFT JOIN eh e ON e.project = a.project AND e.title = a.title AND e.slot = h.slot
        LEFT JOIN vadj v ON v.project = a.project AND v.title = a.title AND v.slot = h.slot""",
    "lags": """
        SELECT a.project, a.title, k.lag, CAST(count(*) AS INTEGER) AS n,
               CASE WHEN max(a.e) > min(a.e) AND max(b.v) > min(b.v) THEN corr(a.e, b.v) END AS corr
        FROM grid a CROSS JOIN (SELECT CAST(range AS INTEGER) AS lag FROM range(-12, 25)) k
        JOIN grid b ON b.project = a.project AND b.title = a.title AND b.slot = a.slot + k.lag
        GROUP BY 1, 2, 3""",
    "best": """
        SELECT *, n - 2 AS dof, (n - 2) % 2 AS odd, (n - 2) // 2 AS cut FROM (
            SELECT *, row_number() OVER (PARTITION BY project, title ORDER BY round(corr, 10) DESC, lag) AS place
            FROM lags WHERE corr IS NOT NULL)
        WHERE place = 1""",
    "tail": """
        SELECT *, CASE WHEN odd = 0 THEN (1 - corr * s) / 2
                       ELSE (1 - 2 / pi() * (asin(corr) + corr * sqrt(1 - corr * corr) * s)) / 2 END AS p
        FROM (SELECT *, list_sum([list_product([1.0] || [(2 * j - 1 + odd) / (2 * j + odd) for j in range(1, k + 1)])
                                  * (1 - corr * corr) ** k for k in range(0, cut)]) AS s FROM best)""",
    "peaks": """
        SELECT project, title, CAST(sum(raw) AS BIGINT) AS total_views,
               arg_max(slot, (e, -slot)) FILTER (slot < 24) AS edit_peak,
               CASE WHEN max(v) > 0 THEN arg_max(slot, (v, -slot)) END AS view_peak,
               round_even(max(v) / greatest(median(v), 1.0) * 10000, 0) / 10000 AS view_surge_ratio
        FROM grid GROUP BY 1, 2""",
    "ll": f"""
        SELECT a.project, a.title, a.event_edits, p.total_views, b.lag AS best_lag_hours,
               round_even(b.corr * 10000, 0) / 10000 AS best_corr,
               round(CASE WHEN b.p * 37 > 1 THEN 1.0 ELSE b.p * 37 END, 6) AS p_value,
               CAST(p.view_peak - p.edit_peak AS INTEGER) AS peak_lag_hours,
               CAST({E} AS TIMESTAMP) + to_hours(p.edit_peak) AS edit_peak_utc,
               CAST({E} AS TIMESTAMP) + to_hours(p.view_peak) AS view_peak_utc,
               p.view_surge_ratio,
               CASE WHEN b.lag IS NULL OR round_even(b.corr * 10000, 0) / 10000 < 0.2 OR b.p * 37 > 0.05
                         THEN 'decorrelated'
                    WHEN b.lag > 0 THEN 'edit_led' WHEN b.lag < 0 THEN 'view_led'
                    ELSE 'simultaneous' END AS pattern
        FROM act a JOIN peaks p USING (project, title) LEFT JOIN tail b USING (project, title)""",
}


def sql(body: str) -> str:
    """``body`` after the common expressions it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in COMMON:
            if name in words and name not in needed:
                needed.add(name)
                visit(COMMON[name])

    visit(body)
    parts = [f"{name} AS ({COMMON[name]})" for name in COMMON if name in needed]
    recursive = "RECURSIVE " if "walk" in body else ""
    return f"WITH {recursive}" + ",\n".join(parts) + ("\n" if parts else "") + body if parts else body


TRENDING_COLUMNS = """title, edit_project, pageview_project, edit_count, total_edit_size, unique_editors,
    first_edit, last_edit, edit_velocity, wikidata_id, pageviews, pageview_rank, trending_score,
    history_days, baseline_editors, is_emerging, z_editors, z_edits, anomaly_score, entity_key,
    language_count, languages_editing, first_language, language_lag_minutes"""

RESPONSES = """
    SELECT p_partkey, 'part_' || p_partkey AS asked, p_brand AS page,
           CASE WHEN p_brand NOT LIKE '%5' THEN 'Q' || p_brand END AS item
    FROM part"""

BODIES = {
    "change_events": """
        SELECT CAST(epoch_us(ts) // 1000000 AS DOUBLE) AS timestamp, page || '.org' AS project, title, usr AS user,
               'edit' AS type, FALSE AS minor, CAST(0 AS BIGINT) AS length_old, amount AS length_new,
               '' AS comment, event_id AS rev_id
        FROM ev WHERE event_type IN ('click', 'purchase')""",
    "messages_by_event_day": """
        SELECT strftime(timestamp_utc, '%Y%m%d') AS day, project, count(*) AS edits FROM ed GROUP BY 1, 2""",
    "stream_drain": """
        SELECT strftime(timestamp_utc, '%Y%m%d') AS day, count(*) AS edits FROM ed GROUP BY 1""",
    "drain_skipped": """
        SELECT count(*) AS received, count(*) FILTER (event_type IN ('signup', 'view')) AS skipped FROM ev""",
    "live_hours": """
        SELECT date_trunc('hour', timestamp_utc) AS hour_utc, replace(project, '.org', '') AS project, title, count(*) AS edits
        FROM ed
        WHERE date_trunc('hour', timestamp_utc) + INTERVAL 3 HOUR <= (SELECT date_trunc('second', max(timestamp_utc)) FROM ed)
        GROUP BY ALL""",
    "raw_committed": """
        SELECT project, count(*) AS edits, count(DISTINCT rev_id) AS revisions FROM ed_today GROUP BY 1""",
    "history_counts": f"""
        , filed AS (
            SELECT *, CAST(timestamp_utc AS DATE) AS dated,
                   CAST(timestamp_utc AS DATE) + CASE WHEN rev_id % 20 = 0 THEN 1 ELSE 0 END AS folder
            FROM ed),
        within AS (
            SELECT * FROM filed WHERE folder <> DATE '2024-01-15' AND folder BETWEEN {D} - 28 AND {D} - 1),
        folders AS (SELECT DISTINCT folder FROM within)
        SELECT project, title, strftime(dated, '%Y%m%d') AS day, count(*) AS edit_count,
               count(DISTINCT usr) AS unique_editors, CAST((SELECT count(*) FROM folders) AS INTEGER) AS history_days
        FROM within WHERE dated IN (SELECT folder FROM folders) GROUP BY 1, 2, 3""",
    "published_tables": f"""
        SELECT 'TrendingArticles' AS table_name, strftime(day, '%Y%m%d') AS day, count(*) AS rows
        FROM trd_days WHERE day <> {D} OR language_count = 1 GROUP BY 2
        UNION ALL
        SELECT 'CrossLanguageEvents', strftime(day, '%Y%m%d'), count(*) FROM clv_days GROUP BY 2""",
    "edits_normalized": """
        SELECT DISTINCT to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC' AS timestamp_utc,
               page || '.org' AS project, CASE WHEN event_type <> 'error' THEN event_id END AS rev_id,
               title, usr AS user, CASE WHEN event_type = 'purchase' THEN 'new' ELSE 'edit' END AS type,
               event_type = 'click' AS minor, amount AS edit_size, CAST(100 AS BIGINT) AS length_old,
               amount + 100 AS length_new,
               CASE WHEN event_type <> 'error' THEN 'c' || usr ELSE '' END AS comment
        FROM ev WHERE event_type IN ('click', 'purchase', 'error')""",
    "edits_aggregated": aggregated("ed"),
    "days_united": f"""
        SELECT strftime(timestamp_utc, '%Y%m%d') AS day, project, count(*) AS edits, CAST(sum(edit_size) AS BIGINT) AS edit_size
        FROM ed WHERE CAST(timestamp_utc AS DATE) BETWEEN {D} - 6 AND {D} GROUP BY 1, 2""",
    "inputs_absent": """
        , month AS (
            SELECT strftime(CAST(n AS DATE), '%Y%m%d') AS day
            FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS s(n))
        SELECT 'formatted' AS layer, 'Edits' AS table_name, day FROM month
        WHERE day = '20240115' OR day NOT IN (SELECT strftime(timestamp_utc, '%Y%m%d') FROM ed)
        UNION ALL SELECT 'formatted', 'PageviewsHourly', day FROM month""",
    "optional_entities": f"""
        SELECT e.day, e.project, e.title, e.edit_count, CASE WHEN e.day = '20240130' THEN i.wikidata_id END AS wikidata_id
        FROM (SELECT strftime(timestamp_utc, '%Y%m%d') AS day, project, title, count(*) AS edit_count FROM ed
              WHERE CAST(timestamp_utc AS DATE) BETWEEN {D} - 1 AND {D} GROUP BY 1, 2, 3) e
        JOIN ids i ON i.project = e.project AND i.title = e.title""",
    "target_day": """
        SELECT '20240130' AS day, 'landed' AS status, count(*) AS edits FROM ed_today
        UNION ALL SELECT '20231201', 'missing', 0""",
    "lake_days": """
        SELECT strftime(timestamp_utc, '%Y%m%d') AS day, count(*) AS edits, count(DISTINCT rev_id) AS revisions
        FROM ed GROUP BY 1""",
    "dump_parsed": """
        SELECT date_trunc('hour', ts) AS hour_utc, page AS project, title, amount AS views
        FROM ev WHERE event_type IN ('view', 'click')""",
    "hourly_merged": f"""
        SELECT date_trunc('hour', ts) AS hour_utc, page AS project, title, CAST(sum(amount) AS BIGINT) AS views
        FROM ev WHERE event_type IN ('view', 'click')
          AND (page || '.org', title) IN (
              SELECT (project, title) FROM ed
              WHERE CAST(timestamp_utc AS DATE) BETWEEN {D} - INTERVAL 1 DAY AND {D})
        GROUP BY ALL
        UNION ALL
        SELECT date_trunc('hour', ts), page, '-', CAST(sum(amount) AS BIGINT)
        FROM ev WHERE event_type IN ('view', 'click') GROUP BY 1, 2""",
    "dump_hours_missing": f"""
        SELECT CASE WHEN n = 0 THEN 'no file' ELSE 'several files' END AS problem,
               strftime(h, '%Y-%m-%d %H:%M') AS name
        FROM (SELECT h, count(page) AS n
              FROM (SELECT {D} + INTERVAL (i) HOUR AS h FROM range(24) r(i)) AS every_hour
              LEFT JOIN (SELECT DISTINCT page, date_trunc('hour', ts) AS h FROM ev
                         WHERE event_type = 'click' AND page <> 'ru.wikipedia') AS files USING (h)
              GROUP BY h) AS per_hour
        WHERE n <> 1
        UNION ALL
        SELECT DISTINCT 'unreadable name', 'lost-' || strftime(ts, '%H') FROM ev
        WHERE event_type = 'click' AND page = 'ru.wikipedia'""",
    "hourly_tsv": """
        SELECT hour_utc, project, '"The" ' || title || CASE WHEN views % 2 = 0 THEN '"' ELSE '' END AS title, views
        FROM vw""",
    "hourly_normalized": "SELECT hour_utc, project, 'The ' || title AS title, views FROM vw",
    "daily_views": """
        SELECT project, title, CAST(sum(views) AS BIGINT) AS views FROM vw WHERE title <> '-' GROUP BY 1, 2""",
    "top_exploded": "SELECT date_utc, project, rank, 'The ' || article AS article, views FROM tp",
    "top_lists": "SELECT date_utc, project, rank, 'The ' || article AS article, views FROM tp_today",
    "top_ranks": "SELECT project, article AS title, min(rank) AS rank FROM tp GROUP BY 1, 2",
    "joined_readership": joined("ed_today", "vw_today", "tp_today"),
    "trending_scores": f"""
        SELECT *, round(edit_count * unique_editors / ln(pageviews + 2), 4) AS trending_score
        FROM ({joined("ed", "vw", "tp")}) j""",
    "edit_to_view": f"""
        SELECT *, round(edit_count / ln(pageviews + 2), 4) AS edit_to_view_ratio
        FROM ({joined("ed_today", "vw_today", "tp_today")}) j WHERE edit_count > 1 AND pageviews > 0""",
    "observed_days": "SELECT day FROM obs",
    "history": "SELECT project, title, day, edit_count, unique_editors FROM hist",
    "emergence_scores": "SELECT * FROM emg",
    "trending": f"SELECT {TRENDING_COLUMNS} FROM trd",
    "top_emerging": """
        SELECT title, edit_project, unique_editors, baseline_editors, z_editors, pageviews, language_count
        FROM trd WHERE is_emerging ORDER BY z_editors DESC, edit_project, title LIMIT 10""",
    "language_signature": f"""
        , keyed AS (
            SELECT a.project AS edit_project, a.title, i.wikidata_id, a.first_edit, a.edit_count,
                   coalesce(i.wikidata_id, a.project || '|' || a.title) AS entity_key
            FROM ({aggregated("ed")}) a LEFT JOIN ids i USING (project, title))
        {signature("keyed")}""",
    "cross_language_events": "SELECT * FROM clv",
    "ordered_titles": """
        SELECT wikidata_id, first_edit, edit_project, title, split_part(edit_project, '.', 1) || ':' || title AS language_title,
               row_number() OVER (PARTITION BY wikidata_id ORDER BY first_edit, edit_project, title) - 1 AS position
        FROM trd_days WHERE wikidata_id IS NOT NULL AND language_count >= 2""",
    "cross_language_titles": """
        SELECT wikidata_id, first_edit, edit_project, title,
               split_part(edit_project, '.', 1) || ':' || title AS language_title
        FROM trd WHERE wikidata_id IS NOT NULL AND language_count >= 2""",
    "hourly_edits": "SELECT project, title, slot, edits FROM eh",
    "active_articles": "SELECT project, title, event_edits FROM act",
    "diurnal_factors": "SELECT project, slot, round(factor, 8) AS factor FROM fac",
    "views_adjusted": "SELECT project, title, slot, views, round(views_adj, 6) AS views_adj FROM vadj",
    "lag_correlations": "SELECT project, title, lag, n, round(corr, 6) AS corr FROM lags",
    "lead_lag": "SELECT * FROM ll",
    "top_edit_led": """
        SELECT project, title, event_edits, best_lag_hours, best_corr, view_surge_ratio
        FROM ll WHERE pattern = 'edit_led' ORDER BY view_surge_ratio DESC, project, title LIMIT 10""",
    "pattern_counts": "SELECT pattern, count(*) AS articles FROM ll GROUP BY 1",
    "pattern_share": """
        SELECT pattern, count(*) AS articles, round(count(*) / sum(count(*)) OVER () * 100, 4) AS percent
        FROM ll GROUP BY 1""",
    "pattern_profile": """
        SELECT pattern, count(*) AS articles, round(count(*) / sum(count(*)) OVER (), 4) AS share,
               median(best_lag_hours) AS median_lag_hours
        FROM ll GROUP BY 1""",
    "panel_lag_histogram": """
        SELECT best_lag_hours, pattern, count(*) AS articles FROM ll WHERE pattern <> 'decorrelated' GROUP BY 1, 2""",
    "panel_edit_led": "SELECT count(*) FILTER (pattern = 'edit_led') AS edit_led FROM ll",
    "panel_articles": "SELECT count(*) AS articles FROM trd",
    "panel_emerging": "SELECT count(*) FILTER (is_emerging) AS emerging FROM trd",
    "panel_multilingual": "SELECT count(*) AS subjects FROM clv",
    "panel_emerging_table": """
        , cells AS (
            SELECT title, edit_project, max(unique_editors) AS editors, max(baseline_editors) AS baseline,
                   max(z_editors) AS z, max(pageviews) AS views, max(language_count) AS languages
            FROM trd WHERE is_emerging GROUP BY 1, 2),
        leaders AS (SELECT title, max(z) AS title_z FROM cells GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50),
        placed AS (
            SELECT title, title_z, edit_project,
                   CAST(row_number() OVER (PARTITION BY title ORDER BY z DESC, edit_project) AS INTEGER) AS place,
                   editors, baseline, z, views, languages
            FROM cells JOIN leaders USING (title))
        SELECT * FROM placed WHERE place <= 5""",
    "trending_days": f"SELECT day, {TRENDING_COLUMNS} FROM trd_days",
    "events_days": "SELECT * FROM clv_days",
    "panel_emerging_per_day": """
        , days AS (SELECT CAST(range AS DATE) AS day FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)),
        langs AS (SELECT edit_project FROM trd_days WHERE is_emerging GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
        SELECT d.day, l.edit_project, count(p.title) AS emerging
        FROM days d CROSS JOIN langs l
        LEFT JOIN trd_days p ON p.day = d.day AND p.edit_project = l.edit_project AND p.is_emerging
        GROUP BY 1, 2""",
    "panel_search": """
        SELECT titles, language_count, first_language, spread_minutes, sum_editors, total_pageviews,
               emerging_languages
        FROM clv""",
    "panel_first_languages": """
        SELECT first_language, count(*) AS subjects FROM clv_days GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "rolling_articles": f"""
        SELECT count(*) AS articles FROM trd_days WHERE day BETWEEN {D} - 14 AND {D}""",
    "headline_totals": """
        SELECT 'edits' AS metric, count(*) AS value FROM ed
        UNION ALL SELECT 'article_days', count(*) FROM trd_days
        UNION ALL SELECT 'emerging', count(*) FROM trd_days WHERE is_emerging
        UNION ALL SELECT 'multilingual_subjects', count(*) FROM clv_days""",
    "quality_edits": f"""
        SELECT 'daily_edits' AS rule, CAST(count(*) AS DOUBLE) AS value, CAST(1000 AS DOUBLE) AS threshold,
               count(*) >= 1000 AS ok FROM ed
        UNION ALL
        SELECT 'in_day_share', avg(CASE WHEN CAST(timestamp_utc AS DATE) = {D} THEN 1.0 ELSE 0.0 END), 0.99,
               avg(CASE WHEN CAST(timestamp_utc AS DATE) = {D} THEN 1.0 ELSE 0.0 END) >= 0.99 FROM ed
        UNION ALL
        SELECT 'edits:' || p, CAST(count(ed.project) AS DOUBLE), 1.0, count(ed.project) > 0
        FROM (SELECT unnest(['en','fr','de','es','ru']) || '.wikipedia.org' AS p) LEFT JOIN ed ON ed.project = p
        GROUP BY p""",
    "quality_trending": """
        SELECT 'view_match:' || edit_project AS rule, avg(CASE WHEN pageviews > 0 THEN 1.0 ELSE 0.0 END) AS value,
               CAST(0.8 AS DOUBLE) AS threshold,
               avg(CASE WHEN pageviews > 0 THEN 1.0 ELSE 0.0 END) >= 0.8 AS ok FROM trd GROUP BY edit_project
        UNION ALL
        SELECT 'duplicate_articles', CAST(count(*) - count(DISTINCT (edit_project, title)) AS DOUBLE), 0.0,
               count(*) = count(DISTINCT (edit_project, title)) FROM trd
        UNION ALL
        SELECT 'emerging_share', avg(CASE WHEN is_emerging THEN 1.0 ELSE 0.0 END), 0.05,
               avg(CASE WHEN is_emerging THEN 1.0 ELSE 0.0 END) <= 0.05 FROM trd""",
    "quality_ids": """
        SELECT 'id_rate' AS rule, count(wikidata_id) / count(*) AS value, CAST(0.5 AS DOUBLE) AS threshold,
               count(wikidata_id) / count(*) >= 0.5 AS ok FROM ids""",
    "view_match": """
        SELECT edit_project, avg(CASE WHEN pageviews > 0 THEN 1.0 ELSE 0.0 END) AS view_match,
               count(*) AS articles FROM trd GROUP BY 1""",
    "missing_projects": """
        , tracked AS (SELECT unnest(['en','fr','de','es','ru']) || '.wikipedia.org' AS project)
        SELECT project FROM tracked WHERE project NOT IN (SELECT project FROM ed WHERE edit_size > 400)""",
    "request_batches": """
        SELECT project, CAST((place - 1) // 50 AS BIGINT) AS batch, string_agg(title, '|' ORDER BY title) AS titles
        FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY title) AS place
              FROM (SELECT DISTINCT ['en','fr','de','es','ru'][o_custkey % 5 + 1] || '.wikipedia.org' AS project,
                           'O' || o_orderkey AS title FROM orders))
        GROUP BY 1, 2""",
    "redirect_chains": """
        WITH RECURSIVE edges AS (
            SELECT 'en.wikipedia.org' AS project, 'P' || p_partkey AS src, 'P' || (p_partkey // 2) AS dst
            FROM part WHERE p_partkey >= 1
            UNION ALL
            SELECT 'fr.wikipedia.org', 'L' || p_partkey,
                   'L' || (CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 3 ELSE p_partkey + 1 END) FROM part),
        walk AS (
            SELECT project, src AS title, src AS cur, CAST([] AS VARCHAR[]) AS seen FROM edges
            UNION ALL
            SELECT w.project, w.title, e.dst, list_append(w.seen, w.cur)
            FROM walk w JOIN edges e ON e.project = w.project AND e.src = w.cur
            WHERE NOT list_contains(w.seen, w.cur))
        SELECT project, title, arg_max(cur, len(seen)) AS final FROM walk GROUP BY 1, 2""",
    "entity_ids": f"""
        SELECT 'en.wikipedia.org' AS project, asked AS title, item AS wikidata_id FROM ({RESPONSES})""",
    "response_problems": f"""
        SELECT 'en.wikipedia.org' AS project, 'http ' || status AS problem, status <> 404 AS retry,
               count(*) AS responses
        FROM (SELECT CASE WHEN asked LIKE '%7' THEN 429 WHEN asked LIKE '%8' THEN 503
                          WHEN asked LIKE '%9' THEN 404 END AS status FROM ({RESPONSES}))
        WHERE status IS NOT NULL GROUP BY status""",
    "documents_keyed": """
        SELECT 'wikipedia-trending' AS _index, sha1('20240130|' || edit_project || '|' || title) AS _id,
               '20240130' AS date, wikidata_id, language_count, CAST(is_emerging AS VARCHAR) AS is_emerging
        FROM trd
        UNION ALL
        SELECT 'wikipedia-crosslang', sha1('20240130|wikidata|' || wikidata_id), '20240130', wikidata_id,
               language_count, CAST(is_emerging AS VARCHAR)
        FROM clv""",
    "documents_rejected": """
        SELECT 'wikipedia-trending' AS _index, sha1('20240130|' || edit_project || '|' || title) AS _id,
               'one language' AS reason
        FROM trd WHERE language_count < 2""",
    "documents_in_parts": f"""
        SELECT 'wikipedia-trending' AS _index, sha1('20240130|' || project || '|' || title) AS _id, edit_count
        FROM ({aggregated("ed")})""",
    "documents_upserted": f"""
        SELECT sha1('20240130|' || a.project || '|' || a.title) AS _id,
               coalesce(t.edit_count, a.edit_count) AS edit_count
        FROM ({aggregated("ed")}) a LEFT JOIN agg_today t USING (project, title)""",
}

ORACLE = {name: sql(body) for name, body in BODIES.items()}
