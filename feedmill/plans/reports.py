"""All log reports of a day in one run, each with its counters by cause."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation

from feedmill.operators import causes, logstats
from feedmill.operators.popularity import count_per
from feedmill.operators.quality import RunCounters

Report = Callable[[DataFrame, Observation], DataFrame]

#: Of the client log; every report is one pass that also counts what it leaves out.
LOG_REPORTS: dict[str, Report] = {
    "diversion_records": lambda log, seen: causes.kept_rows(log, causes.diversion_rule(), seen),
    "daily_consume": lambda log, seen: count_per(causes.kept_rows(log, causes.daily_consume_rule(), seen), "uid"),
    "tab_consumers": lambda log, seen: causes.kept_rows(log, causes.tab_consumers_rule(), seen),
    "depth_report": lambda log, seen: logstats.depth_totals(causes.kept_rows(log, causes.depth_rule(), seen)),
    "find_users": lambda log, seen: causes.kept_rows(log, causes.find_users_rule(), seen),
    "source_report": lambda log, seen: logstats.source_totals(causes.kept_rows(log, causes.source_rule(), seen)),
}


def run_reports(log: DataFrame, exposure: DataFrame, path: str) -> dict[str, dict[str, int]]:
    """Write every report below ``path`` as parquet; gives the records of each by cause, from the same passes."""
    counters = RunCounters()
    for name, report in LOG_REPORTS.items():
        report(log, counters.watch(name)).write.mode("overwrite").parquet(f"{path}/{name}")
    shown = causes.exposed_items(exposure, counters.watch("author_exposure"))
    logstats.items_per_author(shown).write.mode("overwrite").parquet(f"{path}/author_exposure")
    return counters.counts()
