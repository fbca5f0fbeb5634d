"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from meterlake.queries import all_queries
from meterlake.session import local_session

HEADLINE = [
    "kpi_total_cost", "kpi_daily_average", "kpi_cost_per_user", "kpi_budget_variance", "daily_spend_trend",
    "provider_breakdown", "top_spenders", "user_cost_histogram", "weekly_cost_by_model", "weekly_cost_by_token_type",
    "team_attribution", "alert_user_budget", "alert_cache_efficiency", "alert_seat_utilization",
    "daily_active_users", "user_productivity_profile", "research_power_users", "weekly_platform_adoption",
    "project_collaboration", "event_type_distribution", "weekly_retention",
    "spend_deltas", "allocate_cost_to_keys", "fct_usage_daily", "date_coverage", "duplicate_groups",
    "monthly_finance", "productivity_metrics", "cost_allocation", "cost_anomaly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    queries = all_queries()

    def run(name: str) -> float:
        t = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run(names[0])  # start the JVM's code paths once
    times = {name: round(min(run(name) for _ in range(3)), 3) for name in names}
    print(json.dumps({
        "metric": "total seconds of headline queries, best of three runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "slowest": max(times, key=times.get),
        "median": round(statistics.median(times.values()), 3),
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
