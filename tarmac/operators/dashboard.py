"""Report frames of the dashboard, one function per chart or table.

Each is one plan from a mart to the shown rows; nothing is aggregated on the
client.  Year bounds are inclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import dims
from tarmac.dims import CAUSE_LABELS
from tarmac.functions.measures import mean, percent, percent_at_least_one, rounded_mean, total
from tarmac.functions.text import name_and_code
from tarmac.operators.keys import largest
from tarmac.operators.lookup import LOOKUP_ROWS, join_lookup

# Defaults of the page controls.
TOP_AIRLINES = 15
TOP_AIRLINES_BY_YEAR = 8
TOP_AIRPORTS = 20
TOP_AIRPORTS_COMPARED = 60
TOP_ROUTES = 20
TOP_ROUTES_BY_DISTANCE = 200
MIN_AIRPORT_DEPARTURES = 10_000
MIN_ROUTE_FLIGHTS = 1_000
MAX_YEARS_SHOWN_APART = 6
DEFAULT_ROUTE = "LAX-JFK"


def in_years(mart: DataFrame, first_year: int | None, last_year: int | None) -> DataFrame:
    """Rows of an inclusive year range; an open end is not checked."""
    if first_year is not None and last_year is not None:
        return mart.where(F.col("YEAR").between(first_year, last_year))
    if first_year is not None:
        return mart.where(F.col("YEAR") >= first_year)
    return mart if last_year is None else mart.where(F.col("YEAR") <= last_year)


def year_range(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("YEAR").alias("MIN_Y"), F.max("YEAR").alias("MAX_Y"))


def with_month_label(rows: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(dims.months(rows.sparkSession)), "MONTH", "left")


def summed(*names: str) -> list[Column]:
    return [total(name).alias(name) for name in names]


def averaged(*names: str) -> list[Column]:
    return [mean(name).alias(name) for name in names]


# -- home ------------------------------------------------------------------


def home_totals(monthly: DataFrame) -> DataFrame:
    return monthly.agg(
        F.sum("TOTAL_FLIGHTS").alias("TOTAL_FLIGHTS"),
        rounded_mean("DELAY_RATE").alias("AVG_DELAY_RATE"),
        rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
        rounded_mean("AVG_ARR_DELAY_MIN").alias("AVG_ARR_DELAY_MIN"),
        F.concat(F.min("YEAR").cast("string"), F.lit(" – "), F.max("YEAR").cast("string")).alias("YEAR_RANGE"),
        F.count_distinct("YEAR").alias("YEARS_COVERED"),
    )


def airline_count(airlines: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return airlines.agg(count("AIRLINE_CODE").alias("N_AIRLINES"))


def home_annual(monthly: DataFrame) -> DataFrame:
    """Flight-weighted rate next to a mean of monthly means."""
    return (
        monthly.groupBy("YEAR")
        .agg(
            F.sum("TOTAL_FLIGHTS").alias("TOTAL_FLIGHTS"),
            F.sum("TOTAL_DELAYED").alias("TOTAL_DELAYED"),
            F.sum("TOTAL_CANCELLED").alias("TOTAL_CANCELLED"),
            percent(F.sum("TOTAL_DELAYED"), F.sum("TOTAL_FLIGHTS")).alias("DELAY_RATE"),
            rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
        )
        .orderBy("YEAR")
    )


def home_seasonal(monthly: DataFrame) -> DataFrame:
    by_month = monthly.groupBy("MONTH").agg(
        rounded_mean("DELAY_RATE").alias("AVG_DELAY_RATE"),
        rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
    )
    return with_month_label(by_month).orderBy("MONTH")


# -- delay trends ----------------------------------------------------------


def trend_months(monthly: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Month rows of the range with a ``YYYY-MM`` period."""
    period = F.concat(F.col("YEAR").cast("string"), F.lit("-"), F.lpad(F.col("MONTH").cast("string"), 2, "0"))
    return (
        in_years(monthly, first_year, last_year)
        .drop("TOTAL_CANCELLED")
        .withColumn("PERIOD", period)
        .orderBy("YEAR", "MONTH")
    )


def trend_years(monthly: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    by_year = (
        in_years(monthly, first_year, last_year)
        .dropna(subset=["YEAR"])
        .groupBy("YEAR")
        .agg(*summed("TOTAL_FLIGHTS", "TOTAL_DELAYED"), *averaged("AVG_DEP_DELAY_MIN"))
    )
    return by_year.withColumn("DELAY_RATE", percent("TOTAL_DELAYED", "TOTAL_FLIGHTS")).orderBy("YEAR")


def trend_lines(monthly: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Few years: one line per year.  Many years: the mean month pattern."""
    rows = in_years(monthly, first_year, last_year)
    if last_year - first_year + 1 <= MAX_YEARS_SHOWN_APART:
        return with_month_label(rows.select("YEAR", "MONTH", "DELAY_RATE")).orderBy("YEAR", "MONTH")
    by_month = (
        rows.dropna(subset=["MONTH"])
        .groupBy("MONTH")
        .agg(mean("DELAY_RATE").alias("AVG_DELAY_RATE"), mean("AVG_DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"))
    )
    return with_month_label(by_month).orderBy("MONTH")


def trend_cause_shares(monthly: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    return (
        in_years(monthly, first_year, last_year)
        .dropna(subset=["YEAR"])
        .groupBy("YEAR")
        .agg(
            mean("CARRIER_DELAY_SHARE").alias("CARRIER"),
            mean("WEATHER_DELAY_SHARE").alias("WEATHER"),
            mean("NAS_DELAY_SHARE").alias("NAS"),
        )
        .orderBy("YEAR")
    )


# -- airlines --------------------------------------------------------------


def with_airline_label(rows: DataFrame, as_name: str = "AIRLINE_NAME") -> DataFrame:
    """``Name (CODE)`` per airline code, the code itself where unknown."""
    names = dims.airlines(rows.sparkSession).withColumnRenamed("AIRLINE_NAME", "_name")
    joined = rows.join(F.broadcast(names), "AIRLINE_CODE", "left")
    return joined.withColumn(as_name, name_and_code("_name", "AIRLINE_CODE")).drop("_name")


def airline_summary(
    airlines: DataFrame, first_year: int | None = 2015, last_year: int | None = None, top_n: int = TOP_AIRLINES
) -> DataFrame:
    by_airline = (
        in_years(airlines, first_year, last_year)
        .dropna(subset=["AIRLINE_CODE"])
        .groupBy("AIRLINE_CODE")
        .agg(
            *summed("TOTAL_FLIGHTS", "DELAYED_FLIGHTS", "CANCELLED_FLIGHTS", "ON_TIME_FLIGHTS"),
            *averaged("AVG_DEP_DELAY_MIN", "AVG_ARR_DELAY_MIN"),
        )
    )
    rated = by_airline.withColumns(
        {
            "DELAY_RATE": percent("DELAYED_FLIGHTS", "TOTAL_FLIGHTS"),
            "CANCEL_RATE": percent("CANCELLED_FLIGHTS", "TOTAL_FLIGHTS"),
            "ON_TIME_RATE": percent("ON_TIME_FLIGHTS", "TOTAL_FLIGHTS"),
        }
    )
    return with_airline_label(largest(rated, top_n, "TOTAL_FLIGHTS", "AIRLINE_CODE"))


def airline_years(
    airlines: DataFrame,
    first_year: int | None = 2015,
    last_year: int | None = None,
    top_n: int = TOP_AIRLINES,
    top_shown: int = TOP_AIRLINES_BY_YEAR,
) -> DataFrame:
    """Yearly rate of the largest airlines of the range.

    The key list comes from a ``limit``, so broadcasting it is bounded.
    """
    top = largest(airline_summary(airlines, first_year, last_year, top_n), top_shown, "TOTAL_FLIGHTS", "AIRLINE_CODE")
    names = dims.airlines(airlines.sparkSession)
    rates = (
        in_years(airlines, first_year, last_year)
        .join(F.broadcast(top.select("AIRLINE_CODE")), "AIRLINE_CODE", "left_semi")
        .groupBy("YEAR", "AIRLINE_CODE")
        .agg(percent(F.sum("DELAYED_FLIGHTS"), F.sum("TOTAL_FLIGHTS")).alias("DELAY_RATE"))
    )
    labelled = rates.join(F.broadcast(names), "AIRLINE_CODE", "left")
    return labelled.select(
        "YEAR", "AIRLINE_CODE", "DELAY_RATE", F.coalesce("AIRLINE_NAME", "AIRLINE_CODE").alias("AIRLINE_LABEL")
    ).orderBy("YEAR", "AIRLINE_CODE")


def airline_table(summary: DataFrame) -> DataFrame:
    """``airline_summary`` under display names, best on-time rate first."""
    return summary.select(
        F.col("AIRLINE_NAME").alias("Airline"),
        F.col("TOTAL_FLIGHTS").alias("Total Flights"),
        F.col("ON_TIME_RATE").alias("On-Time Rate (%)"),
        F.col("DELAY_RATE").alias("Delay Rate (%)"),
        F.col("CANCEL_RATE").alias("Cancel Rate (%)"),
        F.col("AVG_DEP_DELAY_MIN").alias("Avg Dep Delay (min)"),
        F.col("AVG_ARR_DELAY_MIN").alias("Avg Arr Delay (min)"),
    ).orderBy(F.col("On-Time Rate (%)").desc(), "Airline")


# -- airports --------------------------------------------------------------


def airport_summary(
    airports: DataFrame,
    first_year: int | None = 2019,
    last_year: int | None = None,
    min_flights: int = MIN_AIRPORT_DEPARTURES,
) -> DataFrame:
    keys = ["AIRPORT", "CITY", "STATE"]
    by_airport = (
        in_years(airports, first_year, last_year)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            *summed("DEP_FLIGHTS", "ARR_FLIGHTS", "DEP_DELAYED", "ARR_DELAYED", "DEP_CANCELLED"),
            *averaged("AVG_DEP_DELAY_MIN", "AVG_ARR_DELAY_MIN"),
        )
    )
    rated = by_airport.withColumns(
        {
            "DEP_DELAY_RATE": percent_at_least_one("DEP_DELAYED", "DEP_FLIGHTS"),
            "ARR_DELAY_RATE": percent_at_least_one("ARR_DELAYED", "ARR_FLIGHTS"),
            "CANCEL_RATE": percent_at_least_one("DEP_CANCELLED", "DEP_FLIGHTS"),
            "LABEL": F.concat("AIRPORT", F.lit(" — "), F.split_part("CITY", F.lit(","), F.lit(1))),
        }
    )
    return rated.where(F.col("DEP_FLIGHTS") >= min_flights)


def busiest_airports(summary: DataFrame, top_n: int = TOP_AIRPORTS) -> DataFrame:
    return largest(summary, top_n, "DEP_FLIGHTS", "AIRPORT", "CITY").orderBy("DEP_FLIGHTS", "AIRPORT", "CITY")


def most_delayed_airports(summary: DataFrame, top_n: int = TOP_AIRPORTS) -> DataFrame:
    return largest(summary, top_n, "DEP_DELAY_RATE", "AIRPORT", "CITY").orderBy("DEP_DELAY_RATE", "AIRPORT", "CITY")


def airport_comparison(summary: DataFrame, top_n: int = TOP_AIRPORTS_COMPARED) -> DataFrame:
    """The largest airports with both rates and the largest rate among them.

    The maximum is taken over the limited frame and joined as a scalar, so no
    window without a key is needed.
    """
    shown = largest(summary, top_n, "DEP_FLIGHTS", "AIRPORT", "CITY")
    ceiling = shown.agg(F.greatest(F.max("DEP_DELAY_RATE"), F.max("ARR_DELAY_RATE"))).scalar()
    return shown.select("AIRPORT", "LABEL", "STATE", "DEP_FLIGHTS", "DEP_DELAY_RATE", "ARR_DELAY_RATE").withColumn(
        "MAX_RATE", ceiling
    )


def states(summary: DataFrame) -> DataFrame:
    by_state = summary.groupBy("STATE").agg(*summed("DEP_FLIGHTS", "DEP_DELAYED"))
    return by_state.withColumn("DEP_DELAY_RATE", percent_at_least_one("DEP_DELAYED", "DEP_FLIGHTS"))


def airport_table(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.col("AIRPORT").alias("Code"),
        F.col("CITY").alias("City"),
        F.col("STATE").alias("State"),
        F.col("DEP_FLIGHTS").alias("Dep Flights"),
        F.col("ARR_FLIGHTS").alias("Arr Flights"),
        F.col("DEP_DELAY_RATE").alias("Dep Delay %"),
        F.col("ARR_DELAY_RATE").alias("Arr Delay %"),
        F.col("CANCEL_RATE").alias("Cancel %"),
        F.col("AVG_DEP_DELAY_MIN").alias("Avg Dep Delay (min)"),
        F.col("AVG_ARR_DELAY_MIN").alias("Avg Arr Delay (min)"),
    ).orderBy(F.col("Dep Flights").desc(), "Code")


# -- causes ----------------------------------------------------------------


def cause_totals(causes: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Minutes and percentage per cause in long form, largest first.

    The grand total is part of the same one-row aggregate.  IS_TOP marks the
    leading cause.
    """
    names = [name for name, _ in CAUSE_LABELS]
    one_row = in_years(causes, first_year, last_year).agg(*summed(*names))
    every = sum(F.col(name) for name in names)
    leading = F.greatest(*names)
    pairs = F.array(*[F.struct(F.lit(label).alias("CAUSE"), F.col(name).alias("TOTAL_MIN")) for name, label in CAUSE_LABELS])
    long = one_row.select(every.alias("_every"), leading.alias("_leading"), F.inline(pairs))
    return long.select(
        "CAUSE",
        "TOTAL_MIN",
        F.coalesce(percent("TOTAL_MIN", "_every", 1), F.lit(0.0)).alias("PCT"),
        (F.col("TOTAL_MIN") == F.col("_leading")).alias("IS_TOP"),
    ).orderBy(F.col("TOTAL_MIN").desc(), "CAUSE")


def cause_years(causes: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    rows = in_years(causes, first_year, last_year).dropna(subset=["YEAR"])
    return rows.groupBy("YEAR").agg(*summed(*[name for name, _ in CAUSE_LABELS])).orderBy("YEAR")


def cause_year_shares(by_year: DataFrame) -> DataFrame:
    """``cause_years`` as percentages of the year's total, one decimal."""
    every = sum(F.col(name) for name, _ in CAUSE_LABELS)
    shares = [percent(name, every, 1).alias(f"{label}_PCT") for name, label in CAUSE_LABELS]
    return by_year.select("YEAR", *shares).orderBy("YEAR")


def cause_months(causes: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    rows = in_years(causes, first_year, last_year).dropna(subset=["MONTH"])
    by_month = rows.groupBy("MONTH").agg(*[rounded_mean(name, 0).alias(name) for name, _ in CAUSE_LABELS])
    return with_month_label(by_month).orderBy("MONTH")


# -- routes ----------------------------------------------------------------


def route_summary(
    routes: DataFrame,
    first_year: int | None = 2019,
    last_year: int | None = None,
    min_flights: int = MIN_ROUTE_FLIGHTS,
) -> DataFrame:
    keys = ["ORIGIN", "DEST", "ROUTE"]
    by_route = (
        in_years(routes, first_year, last_year)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            *summed("TOTAL_FLIGHTS", "DELAYED_FLIGHTS"),
            rounded_mean("AVG_DEP_DELAY_MIN", 1).alias("AVG_DEP_DELAY_MIN"),
            rounded_mean("AVG_DISTANCE", 0).alias("AVG_DISTANCE"),
        )
    )
    rated = by_route.withColumn("DELAY_RATE", percent_at_least_one("DELAYED_FLIGHTS", "TOTAL_FLIGHTS"))
    return rated.where(F.col("TOTAL_FLIGHTS") >= min_flights)


def most_delayed_routes(summary: DataFrame, top_n: int = TOP_ROUTES) -> DataFrame:
    return largest(summary, top_n, "DELAY_RATE", "ROUTE").orderBy("DELAY_RATE", "ROUTE")


def busiest_route_rows(summary: DataFrame, top_n: int = TOP_ROUTES) -> DataFrame:
    return largest(summary, top_n, "TOTAL_FLIGHTS", "ROUTE").orderBy("TOTAL_FLIGHTS", "ROUTE")


def routes_by_distance(summary: DataFrame, top_n: int = TOP_ROUTES_BY_DISTANCE) -> DataFrame:
    return largest(summary, top_n, "TOTAL_FLIGHTS", "ROUTE").select(
        "ROUTE", "AVG_DISTANCE", "DELAY_RATE", "TOTAL_FLIGHTS", "AVG_DEP_DELAY_MIN"
    )


def default_route(route_names: DataFrame) -> DataFrame:
    """The default route if it is listed, else the first one by name."""
    preferred = F.col("ROUTE") == DEFAULT_ROUTE
    return route_names.orderBy(preferred.desc(), "ROUTE").limit(1)


def route_months(
    routes: DataFrame, route: str, first_year: int | None = 2019, last_year: int | None = None
) -> DataFrame:
    """Month series of one route."""
    return (
        in_years(routes.where(F.col("ROUTE") == route), first_year, last_year)
        .groupBy("YEAR", "MONTH")
        .agg(
            F.sum("TOTAL_FLIGHTS").alias("TOTAL_FLIGHTS"),
            F.sum("DELAYED_FLIGHTS").alias("DELAYED_FLIGHTS"),
            percent(F.sum("DELAYED_FLIGHTS"), F.sum("TOTAL_FLIGHTS")).alias("DELAY_RATE"),
            rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
        )
        .orderBy("YEAR", "MONTH")
    )


def route_years(months: DataFrame) -> DataFrame:
    """Annual roll-up of ``route_months``: unweighted means of the months."""
    by_year = months.groupBy("YEAR").agg(*summed("TOTAL_FLIGHTS"), *averaged("DELAY_RATE", "AVG_DEP_DELAY_MIN"))
    return by_year.orderBy("YEAR")


def route_names(summary: DataFrame) -> DataFrame:
    return summary.select("ROUTE").distinct().orderBy("ROUTE")


def route_search(summary: DataFrame, text: str, pattern: bool = False) -> DataFrame:
    """Routes that contain the upper-cased text, or match it as a pattern."""
    wanted = F.lit(text.upper())
    hit = F.rlike("ROUTE", wanted) if pattern else F.contains("ROUTE", wanted)
    return summary.where(hit)


def route_table(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.col("ROUTE").alias("Route"),
        F.col("TOTAL_FLIGHTS").alias("Total Flights"),
        F.col("DELAY_RATE").alias("Delay Rate (%)"),
        F.col("AVG_DEP_DELAY_MIN").alias("Avg Dep Delay (min)"),
        F.col("AVG_DISTANCE").alias("Avg Distance (mi)"),
    ).orderBy(F.col("Delay Rate (%)").desc(), "Route")


def route_history(routes: DataFrame, origin: str, dest: str) -> DataFrame:
    """Latest month of one route."""
    return (
        routes.where((F.col("ORIGIN") == origin) & (F.col("DEST") == dest))
        .orderBy(F.col("YEAR").desc(), F.col("MONTH").desc())
        .limit(1)
        .select("ORIGIN", "DEST", "AVG_DEP_DELAY_MIN", "TOTAL_FLIGHTS")
    )


def with_route_history(flights: DataFrame, routes: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame:
    """Each flight with the latest month of its route.

    ``max_by`` folds a route's months to one row per route, which is then a
    lookup of at most airports × airports rows.
    """
    month = F.col("YEAR") * 12 + F.col("MONTH")
    latest = routes.groupBy("ORIGIN", "DEST").agg(
        F.max_by("AVG_DEP_DELAY_MIN", month).alias("ROUTE_AVG_DEP_DELAY_MIN"),
        F.max_by("TOTAL_FLIGHTS", month).alias("ROUTE_TOTAL_FLIGHTS"),
    )
    return join_lookup(flights, latest, ["ORIGIN", "DEST"], limit)
