"""Productivity reports over the app usage log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, week_start
from meterlake.functions.numbers import arg_max, count_big, count_distinct_if, percent, safe_divide
from meterlake.operators.aggregates import pct_of_total
from meterlake.operators.filters import trailing
from meterlake.operators.joins import self_join_shift

# Event types and platforms the reports name.
CONVERSATION, FILE, PROJECT = "conversation_created", "file_uploaded", "project_created"
PLATFORMS = [("desktop_app", "desktop"), ("web_claude_ai", "web"), ("ios", "ios"), ("android", "android")]

# Engagement weight per event.
ENGAGEMENT = [(CONVERSATION, 2), (FILE, 1), (PROJECT, 3)]


def _is(event: str) -> Column:
    # A NULL event type is no event of that type, not an unknown.
    return F.coalesce(F.col("event_type") == event, F.lit(False))


def _n(event: str) -> Column:
    return count_big(_is(event))


def _recent(logs: DataFrame, as_of: Day, days: int) -> DataFrame:
    return trailing(logs, "activity_date", days, as_of)


def daily_active_users(logs: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    out = _recent(logs, as_of, days).groupBy("activity_date").agg(
        F.countDistinct("user_email").alias("daily_active_users"),
        count_big().alias("total_events"),
        _n(CONVERSATION).alias("conversations_created"),
        _n(FILE).alias("files_uploaded"),
        _n(PROJECT).alias("projects_created"),
        *[count_big(F.col("client_platform") == p).alias(f"{name}_events") for p, name in PLATFORMS],
    )
    return out.orderBy(F.col("activity_date").desc())


def user_productivity_profile(logs: DataFrame, as_of: Day, days: int = 30, per_user: bool = False) -> DataFrame:
    """Activity profile per user.

    The preferred platform is, among those the user touched, the one with the
    most events over *all* users and dates; ``per_user`` ranks by the user's
    own events in the window instead. Ties go to the smaller name.

    A user's platforms are collected as a set with the other figures, so the
    events are not read again to join them. Platforms are a handful of names.
    """
    recent = _recent(logs, as_of, days)
    keys = ["user_email", "user_name"]
    score = sum((_n(event) * weight for event, weight in ENGAGEMENT), F.lit(0))
    profile = recent.groupBy(*keys).agg(
        F.countDistinct("activity_date").alias("days_active"),
        count_big().alias("total_activities"),
        _n(CONVERSATION).alias("conversations"),
        _n(FILE).alias("files_uploaded"),
        percent(_n(FILE), _n(CONVERSATION), 1).alias("files_per_conversation_pct"),
        _n(PROJECT).alias("projects_created"),
        F.countDistinct("project_uuid").alias("unique_projects"),
        score.cast("bigint").alias("engagement_score"),
        F.collect_set("client_platform").alias("_platforms"),
    )
    out = _own_platform(profile, recent, keys) if per_user else _global_platform(profile, logs)
    return out.orderBy(F.col("engagement_score").desc(), "user_email")


def _global_platform(profile: DataFrame, logs: DataFrame) -> DataFrame:
    counts = logs.filter(F.col("client_platform").isNotNull()).groupBy("client_platform").agg(count_big().alias("n"))
    overall = counts.agg(F.map_from_entries(F.collect_list(F.struct("client_platform", "n")))).scalar()
    ranked = F.transform("_platforms", lambda p: F.struct((-F.col("_overall")[p]).alias("n"), p.alias("p")))
    return profile.withColumn("_overall", overall).withColumn("preferred_platform", F.array_min(ranked)["p"]).drop(
        "_overall", "_platforms"
    )


def _own_platform(profile: DataFrame, recent: DataFrame, keys: list[str]) -> DataFrame:
    touched = recent.filter(F.col("client_platform").isNotNull()).groupBy(*keys, "client_platform").agg(count_big().alias("n"))
    best = touched.groupBy(*keys).agg(arg_max("client_platform", "n").alias("preferred_platform"))
    profile = profile.drop("_platforms")
    same_user = profile["user_email"].eqNullSafe(best["user_email"]) & profile["user_name"].eqNullSafe(best["user_name"])
    return profile.join(best, same_user, "left").select(*[profile[c] for c in profile.columns], "preferred_platform")


def research_power_users(logs: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    """Files per conversation; classes use the unrounded ratio."""
    users = _recent(logs, as_of, days).groupBy("user_email", "user_name").agg(
        _n(CONVERSATION).alias("conversations"), _n(FILE).alias("files_uploaded")
    )
    ratio = safe_divide("files_uploaded", "conversations")
    out = users.filter(F.col("conversations") > 0).select(
        "*",
        F.round(ratio, 2).alias("files_per_conversation"),
        F.when(ratio >= 3, "Research-Heavy").when(ratio >= 1, "Balanced").otherwise("Conversation-Focused").alias("user_type"),
    )
    return out.orderBy(F.col("files_per_conversation").desc(), "user_email")


def weekly_platform_adoption(logs: DataFrame, as_of: Day, days: int = 90) -> DataFrame:
    rows = _recent(logs, as_of, days).filter(F.col("client_platform").isNotNull())
    out = rows.groupBy(week_start("activity_date").alias("week"), "client_platform").agg(
        F.countDistinct("user_email").alias("unique_users"), count_big().alias("total_events")
    )
    return out.orderBy(F.col("week").desc(), F.col("unique_users").desc(), "client_platform")


def project_collaboration(logs: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    out = _recent(logs, as_of, days).groupBy("activity_date").agg(
        count_distinct_if(_is(PROJECT), "user_email").alias("users_creating_projects"),
        _n(PROJECT).alias("projects_created"),
        F.countDistinct("project_uuid").alias("unique_projects_active"),
        count_distinct_if(F.col("project_uuid").isNotNull(), "user_email").alias("users_in_projects"),
    )
    return out.orderBy(F.col("activity_date").desc())


def event_type_distribution(logs: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    types = _recent(logs, as_of, days).groupBy("event_type").agg(
        count_big().alias("event_count"), F.countDistinct("user_email").alias("unique_users")
    )
    return pct_of_total(types, "event_count").orderBy(F.col("event_count").desc(), "event_type")


def weekly_retention(logs: DataFrame, as_of: Day, weeks: int = 12) -> DataFrame:
    """Of the users active in a week, how many are active 1, 2 and 4 weeks later.

    The cohort is every *active* week of a user, not the first one.
    """
    rows = _recent(logs, as_of, 7 * weeks)
    active = rows.select("user_email", week_start("activity_date").alias("cohort_week"))
    marked = self_join_shift(active, "cohort_week", "user_email", [1, 2, 4])
    counts = marked.groupBy("cohort_week").agg(
        F.count("user_email").alias("week_0_users"),
        *[count_big(F.col(f"after_{k}")).alias(f"week_{k}_users") for k in (1, 2, 4)],
    )
    return counts.select(
        "*", *[percent(f"week_{k}_users", "week_0_users", 1).alias(f"week_{k}_retention_pct") for k in (1, 4)]
    ).orderBy(F.col("cohort_week").desc())
