"""Usage reports over the app log."""

from __future__ import annotations

from meterlake import proxies as P
from meterlake.plans import usage as U
from meterlake.queries import Query
from meterlake.queries.views import AS_OF, EVENTS_AS_OF, pct, sdiv, week

RECENT = f"activity_date >= DATE '{EVENTS_AS_OF}' - 30"
WEEKS = 365


def _n(event: str) -> str:
    return f"COUNT(*) FILTER (event_type = '{event}')"


def _report(fn, **kw):
    return lambda spark, d: fn(P.app_usage_logs(spark, d), EVENTS_AS_OF, **kw)


def _retention(view: str, as_of: str, weeks: int) -> str:
    joins = " ".join(
        f"LEFT JOIN w AS w{k} ON w0.user_email = w{k}.user_email AND w{k}.week = w0.week + {7 * k}" for k in (1, 2, 4)
    )
    return f"""
WITH w AS (SELECT DISTINCT {week('activity_date')} AS week, user_email FROM {view} WHERE activity_date >= DATE '{as_of}' - {7 * weeks})
SELECT w0.week AS cohort_week, COUNT(DISTINCT w0.user_email) AS week_0_users, COUNT(DISTINCT w1.user_email) AS week_1_users,
  COUNT(DISTINCT w2.user_email) AS week_2_users, COUNT(DISTINCT w4.user_email) AS week_4_users,
  {pct('COUNT(DISTINCT w1.user_email)', 'COUNT(DISTINCT w0.user_email)', 1)} AS week_1_retention_pct,
  {pct('COUNT(DISTINCT w4.user_email)', 'COUNT(DISTINCT w0.user_email)', 1)} AS week_4_retention_pct
FROM w AS w0 {joins} GROUP BY w0.week"""


def _profile(per_user: bool) -> Query:
    counts = (
        f"SELECT user_email, client_platform, COUNT(*) AS n FROM logs WHERE {RECENT} GROUP BY 1, 2"
        if per_user
        else f"""SELECT DISTINCT l.user_email, l.client_platform, g.n FROM logs l
  JOIN (SELECT client_platform, COUNT(*) AS n FROM logs GROUP BY 1) g ON l.client_platform = g.client_platform WHERE {RECENT}"""
    )
    sql = f"""
WITH c AS ({counts}),
best AS (SELECT user_email, client_platform FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_email ORDER BY n DESC, client_platform) AS rn
  FROM c WHERE client_platform IS NOT NULL) r WHERE rn = 1)
SELECT l.user_email, user_name, COUNT(DISTINCT activity_date) AS days_active, COUNT(*) AS total_activities,
  {_n('conversation_created')} AS conversations, {_n('file_uploaded')} AS files_uploaded,
  {pct(_n('file_uploaded'), _n('conversation_created'), 1)} AS files_per_conversation_pct,
  {_n('project_created')} AS projects_created, COUNT(DISTINCT project_uuid) AS unique_projects,
  MAX(b.client_platform) AS preferred_platform,
  CAST(2 * {_n('conversation_created')} + {_n('file_uploaded')} + 3 * {_n('project_created')} AS BIGINT) AS engagement_score
FROM logs l LEFT JOIN best b ON l.user_email = b.user_email WHERE {RECENT} GROUP BY 1, 2"""
    return Query(_report(U.user_productivity_profile, per_user=per_user), sql)


QUERIES = {
    "daily_active_users": Query(
        _report(U.daily_active_users),
        f"""SELECT activity_date, COUNT(DISTINCT user_email) AS daily_active_users, COUNT(*) AS total_events,
  {_n('conversation_created')} AS conversations_created, {_n('file_uploaded')} AS files_uploaded,
  {_n('project_created')} AS projects_created, COUNT(*) FILTER (client_platform = 'desktop_app') AS desktop_events,
  COUNT(*) FILTER (client_platform = 'web_claude_ai') AS web_events, COUNT(*) FILTER (client_platform = 'ios') AS ios_events,
  COUNT(*) FILTER (client_platform = 'android') AS android_events FROM logs WHERE {RECENT} GROUP BY 1""",
    ),
    "user_productivity_profile": _profile(False),
    "user_productivity_profile_per_user": _profile(True),
    "research_power_users": Query(
        _report(U.research_power_users),
        f"""WITH u AS (SELECT user_email, user_name, {_n('conversation_created')} AS conversations, {_n('file_uploaded')} AS files_uploaded
  FROM logs WHERE {RECENT} GROUP BY 1, 2)
SELECT *, ROUND({sdiv('files_uploaded', 'conversations')}, 2) AS files_per_conversation,
  CASE WHEN {sdiv('files_uploaded', 'conversations')} >= 3 THEN 'Research-Heavy'
    WHEN {sdiv('files_uploaded', 'conversations')} >= 1 THEN 'Balanced' ELSE 'Conversation-Focused' END AS user_type
FROM u WHERE conversations > 0""",
    ),
    "weekly_platform_adoption": Query(
        _report(U.weekly_platform_adoption),
        f"""SELECT {week('activity_date')} AS week, client_platform, COUNT(DISTINCT user_email) AS unique_users,
  COUNT(*) AS total_events FROM logs WHERE activity_date >= DATE '{EVENTS_AS_OF}' - 90 AND client_platform IS NOT NULL GROUP BY 1, 2""",
    ),
    "project_collaboration": Query(
        _report(U.project_collaboration),
        f"""SELECT activity_date, COUNT(DISTINCT CASE WHEN event_type = 'project_created' THEN user_email END) AS users_creating_projects,
  {_n('project_created')} AS projects_created, COUNT(DISTINCT project_uuid) AS unique_projects_active,
  COUNT(DISTINCT CASE WHEN project_uuid IS NOT NULL THEN user_email END) AS users_in_projects
FROM logs WHERE {RECENT} GROUP BY 1""",
    ),
    "event_type_distribution": Query(
        _report(U.event_type_distribution),
        f"""SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_email) AS unique_users,
  ROUND({sdiv('COUNT(*) * 100', 'SUM(COUNT(*)) OVER ()')}, 2) AS pct_of_total FROM logs WHERE {RECENT} GROUP BY 1""",
    ),
    "weekly_retention": Query(
        lambda s, d: U.weekly_retention(P.order_logs(s, d), AS_OF, WEEKS), _retention("order_logs", AS_OF, WEEKS)
    ),
    "weekly_retention_app": Query(_report(U.weekly_retention), _retention("logs", EVENTS_AS_OF, 12)),
}
