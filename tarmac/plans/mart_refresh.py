"""Refresh sets of marts on disk."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators import cells, marts
from tarmac.sources.tables import refresh_mart, write_batch

log = logging.getLogger(__name__)

MONTHLY = ["YEAR", "MONTH"]


def daily_trends(flights: DataFrame, target_date: dt.date | None = None) -> DataFrame:
    """Daily trend with its month; a date refreshes the whole month it lies in,
    which is the partition its flights are read from anyway."""
    trend = marts.delay_trends_daily(marts.in_month(flights, target_date))
    return trend.withColumns({"YEAR": F.year("FLIGHT_DATE"), "MONTH": F.month("FLIGHT_DATE")})


# Mart name → query over the flights; all are stored by month.
FLIGHT_MARTS: dict[str, Callable[..., DataFrame]] = {
    "delay_trends_monthly": marts.delay_trends_monthly,
    "delay_trends_daily": daily_trends,
    "airline_performance": marts.airline_performance,
    "airport_stats": marts.airport_stats,
    "delay_cause_breakdown": marts.delay_cause_breakdown,
    "route_performance": marts.route_performance,
}

# Mart name → roll-up of the shared cells, used when several are refreshed.
CELL_MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "delay_trends_monthly": cells.delay_trends_monthly,
    "airline_performance": cells.airline_performance,
    "airport_stats": cells.airport_stats,
    "delay_cause_breakdown": cells.delay_cause_breakdown,
    "route_performance": cells.route_performance,
}

# Set name and the marts in it.
MART_SETS = {
    "delay_trends": ["delay_trends_monthly", "delay_trends_daily"],
    "airline": ["airline_performance"],
    "airports": ["airport_stats"],
    "delay_causes": ["delay_cause_breakdown"],
    "routes": ["route_performance"],
    "nas_status": ["airport_nas_status"],
    "weather": ["weather_delay_correlation"],
    "all": [
        "delay_trends_monthly",
        "delay_trends_daily",
        "airline_performance",
        "airport_stats",
        "delay_cause_breakdown",
        "route_performance",
        "airport_nas_status",
        "weather_delay_correlation",
    ],
}


def refresh(
    flights: DataFrame, nas: DataFrame | None, path: str, mart_set: str = "all", target_date: dt.date | None = None
) -> dict[str, str]:
    """Refresh a set of marts; a failure is noted and the others go on.

    With a date only its partitions are rewritten, other months stay.  When the
    set holds several monthly marts, the flights are read once: their cells are
    written under ``path`` and the marts are rolled up from there.
    """
    names = MART_SETS[mart_set]
    shared = None
    if sum(name in CELL_MARTS for name in names) > 1:
        try:
            shared = _write_cells(marts.in_month(flights, target_date), f"{path}/flight_cells")
        except Exception as problem:  # noqa: BLE001 - each mart then reads the flights itself
            log.error("shared cells failed: %s", problem)
    outcome = {}
    for name in names:
        try:
            outcome[name] = _refresh_one(name, flights, nas, shared, f"{path}/{name}", target_date)
        except Exception as problem:  # noqa: BLE001 - one mart must not stop the rest
            log.error("%s failed: %s", name, problem)
            outcome[name] = f"failed: {type(problem).__name__}"
    return outcome


def _write_cells(flights: DataFrame, path: str) -> DataFrame:
    rows = cells.flight_cells(flights)
    write_batch(rows, path)
    return flights.sparkSession.read.schema(rows.schema).parquet(path)


def _refresh_one(
    name: str,
    flights: DataFrame,
    nas: DataFrame | None,
    shared: DataFrame | None,
    path: str,
    target_date: dt.date | None,
) -> str:
    if name == "airport_nas_status":
        if nas is None:
            return "skipped: no status table"
        refresh_mart(marts.airport_nas_status(nas), path)
    elif name == "weather_delay_correlation":
        if not marts.weather_ready(flights):
            return "skipped: no weather joined"
        refresh_mart(marts.weather_delay_correlation(flights), path)
    else:
        from_cells = shared is not None and name in CELL_MARTS
        mart = CELL_MARTS[name](shared) if from_cells else FLIGHT_MARTS[name](flights, target_date)
        refresh_mart(mart, path, MONTHLY, month=target_date)
    return "refreshed"
