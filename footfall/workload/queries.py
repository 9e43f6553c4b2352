"""Reports of the spec tables, device and debug reports."""

from __future__ import annotations

from footfall.plans import reports
from footfall.plans.specs import JOBS, REPORTS
from footfall.workload.log import log_of, lookups_of
from footfall.workload.oracle import report_oracles
from footfall.workload.registry import query

_CHECKS = report_oracles()


def _report(name: str) -> None:
    query(name, _CHECKS[name])(lambda spark, sf: reports.report(name, log_of(spark, sf), lookups_of(spark)))


for _name in [*REPORTS, *JOBS]:
    _report(_name)

query("daily_terminal", _CHECKS["daily_terminal"])(lambda spark, sf: reports.terminal(log_of(spark, sf)))
query("debug_daily_trend", _CHECKS["daily_trend"])(lambda spark, sf: reports.debug_trend(log_of(spark, sf)))
query("debug_hourly_trend", _CHECKS["hourly_trend"])(lambda spark, sf: reports.debug_trend(log_of(spark, sf), by_hour=True))
