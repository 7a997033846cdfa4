"""Dimension tables with fixed content.

Every table here is a list of literals of at most a few dozen rows, so a
broadcast of one is bounded by this file and does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Airport code, latitude, longitude, time zone, display name.
AIRPORT_SITES = [
    ("ATL", 33.6407, -84.4277, "America/New_York", "Hartsfield-Jackson Atlanta"),
    ("DFW", 32.8998, -97.0403, "America/Chicago", "Dallas/Fort Worth"),
    ("DEN", 39.8561, -104.6737, "America/Denver", "Denver International"),
    ("ORD", 41.9742, -87.9073, "America/Chicago", "O'Hare International"),
    ("LAX", 33.9425, -118.4081, "America/Los_Angeles", "Los Angeles International"),
    ("CLT", 35.2140, -80.9431, "America/New_York", "Charlotte Douglas"),
    ("LAS", 36.0840, -115.1537, "America/Los_Angeles", "Harry Reid International"),
    ("PHX", 33.4373, -112.0078, "America/Phoenix", "Phoenix Sky Harbor"),
    ("MCO", 28.4312, -81.3081, "America/New_York", "Orlando International"),
    ("SEA", 47.4502, -122.3088, "America/Los_Angeles", "Seattle-Tacoma"),
    ("MIA", 25.7959, -80.2870, "America/New_York", "Miami International"),
    ("IAH", 29.9902, -95.3368, "America/Chicago", "George Bush Intercontinental"),
    ("JFK", 40.6413, -73.7781, "America/New_York", "John F. Kennedy International"),
    ("EWR", 40.6895, -74.1745, "America/New_York", "Newark Liberty"),
    ("MSP", 44.8848, -93.2223, "America/Chicago", "Minneapolis-Saint Paul"),
    ("BOS", 42.3656, -71.0096, "America/New_York", "Boston Logan"),
    ("DTW", 42.2162, -83.3554, "America/Detroit", "Detroit Metropolitan"),
    ("PHL", 39.8729, -75.2437, "America/New_York", "Philadelphia International"),
    ("LGA", 40.7772, -73.8726, "America/New_York", "LaGuardia"),
    ("FLL", 26.0726, -80.1527, "America/New_York", "Fort Lauderdale-Hollywood"),
    ("BWI", 39.1754, -76.6682, "America/New_York", "Baltimore/Washington"),
    ("DCA", 38.8521, -77.0377, "America/New_York", "Ronald Reagan Washington National"),
    ("MDW", 41.7868, -87.7522, "America/Chicago", "Chicago Midway"),
    ("SFO", 37.6213, -122.3790, "America/Los_Angeles", "San Francisco International"),
    ("SLC", 40.7884, -111.9778, "America/Denver", "Salt Lake City International"),
    ("IAD", 38.9531, -77.4565, "America/New_York", "Dulles International"),
    ("SAN", 32.7338, -117.1933, "America/Los_Angeles", "San Diego International"),
    ("TPA", 27.9755, -82.5332, "America/New_York", "Tampa International"),
    ("PDX", 45.5898, -122.5951, "America/Los_Angeles", "Portland International"),
    ("HOU", 29.6454, -95.2789, "America/Chicago", "William P. Hobby"),
    ("STL", 38.7499, -90.3748, "America/Chicago", "St. Louis Lambert"),
    ("BNA", 36.1245, -86.6782, "America/Chicago", "Nashville International"),
    ("OAK", 37.7213, -122.2208, "America/Los_Angeles", "Oakland International"),
    ("MCI", 39.2976, -94.7139, "America/Chicago", "Kansas City International"),
    ("SMF", 38.6954, -121.5908, "America/Los_Angeles", "Sacramento International"),
    ("RDU", 35.8776, -78.7875, "America/New_York", "Raleigh-Durham"),
    ("SJC", 37.3626, -121.9290, "America/Los_Angeles", "San Jose Mineta"),
    ("MSY", 29.9934, -90.2580, "America/Chicago", "Louis Armstrong New Orleans"),
    ("SAT", 29.5337, -98.4698, "America/Chicago", "San Antonio International"),
    ("CLE", 41.4117, -81.8498, "America/New_York", "Cleveland Hopkins"),
    ("CVG", 39.0488, -84.6678, "America/New_York", "Cincinnati/Northern Kentucky"),
    ("PIT", 40.4915, -80.2329, "America/New_York", "Pittsburgh International"),
    ("CMH", 39.9980, -82.8919, "America/New_York", "John Glenn Columbus"),
    ("IND", 39.7173, -86.2944, "America/Indiana/Indianapolis", "Indianapolis International"),
    ("MKE", 42.9472, -87.8966, "America/Chicago", "Milwaukee Mitchell"),
    ("AUS", 30.1975, -97.6664, "America/Chicago", "Austin-Bergstrom"),
    ("OGG", 20.8986, -156.4305, "Pacific/Honolulu", "Kahului (Maui)"),
    ("HNL", 21.3245, -157.9251, "Pacific/Honolulu", "Daniel K. Inouye (Honolulu)"),
    ("ANC", 61.1743, -149.9963, "America/Anchorage", "Ted Stevens Anchorage"),
    ("SNA", 33.6757, -117.8682, "America/Los_Angeles", "John Wayne (Orange County)"),
]

# The one airport with coordinates for which no weather is fetched.
NO_WEATHER_AIRPORTS = ["CLE"]

# Airports of the delay-program feed.
NAS_AIRPORTS = [
    "ATL", "DFW", "DEN", "ORD", "LAX", "JFK", "LAS", "MCO", "MIA", "CLT",
    "SEA", "PHX", "EWR", "SFO", "IAH", "BOS", "FLL", "MSP", "LGA", "BWI",
    "DTW", "PHL", "SLC", "DCA", "IAD", "MDW", "SAN", "TPA", "PDX", "HOU",
    "BNA", "MEM", "AUS", "STL", "ONT", "SNA", "OAK", "CLE", "RDU", "MSY",
    "SMF", "SJC", "PIT", "RSW", "CVG", "IND", "ABQ", "ELP", "BUF", "ANC",
]

# Carrier code, carrier name.
AIRLINE_NAMES = [
    ("AA", "American Airlines"),
    ("DL", "Delta Air Lines"),
    ("UA", "United Airlines"),
    ("WN", "Southwest Airlines"),
    ("B6", "JetBlue Airways"),
    ("AS", "Alaska Airlines"),
    ("NK", "Spirit Airlines"),
    ("F9", "Frontier Airlines"),
    ("G4", "Allegiant Air"),
    ("HA", "Hawaiian Airlines"),
    ("VX", "Virgin America"),
    ("OO", "SkyWest Airlines"),
    ("MQ", "Envoy Air"),
    ("YX", "Republic Airways"),
    ("9E", "Endeavor Air"),
    ("EV", "ExpressJet Airlines"),
    ("OH", "PSA Airlines"),
    ("YV", "Mesa Airlines"),
    ("US", "US Airways"),
    ("FL", "AirTran Airways"),
    ("CO", "Continental Airlines"),
    ("NW", "Northwest Airlines"),
    ("HP", "America West Airlines"),
    ("TW", "Trans World Airlines (TWA)"),
    ("TZ", "ATA Airlines"),
    ("XE", "ExpressJet (XE)"),
    ("ZW", "Air Wisconsin"),
    ("CP", "Compass Airlines"),
    ("PT", "Piedmont Airlines"),
]

# Month labels, weekday names from Monday, cause columns and labels.
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CAUSE_LABELS = [
    ("CARRIER_DELAY_TOTAL_MIN", "Carrier"),
    ("WEATHER_DELAY_TOTAL_MIN", "Weather"),
    ("NAS_DELAY_TOTAL_MIN", "NAS"),
    ("SECURITY_DELAY_TOTAL_MIN", "Security"),
    ("LATE_AIRCRAFT_DELAY_TOTAL_MIN", "Late Aircraft"),
]


def airports(spark: SparkSession) -> DataFrame:
    """One row per known airport with membership flags for the three lists."""
    sites = {site[0]: site for site in AIRPORT_SITES}
    extra = [code for code in NAS_AIRPORTS if code not in sites]
    rows = [
        (
            code,
            *(sites[code][1:] if code in sites else (None, None, None, None)),
            code in sites,
            code in sites and code not in NO_WEATHER_AIRPORTS,
            code in NAS_AIRPORTS,
        )
        for code in [*sites, *extra]
    ]
    return spark.createDataFrame(
        rows,
        "IATA_CODE string, LATITUDE double, LONGITUDE double, TIME_ZONE string, AIRPORT_NAME string,"
        " HAS_COORDINATES boolean, HAS_WEATHER boolean, IN_NAS_FEED boolean",
    )


def airlines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AIRLINE_NAMES, "AIRLINE_CODE string, AIRLINE_NAME string")


def months(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(MONTH_LABELS, 1)), "MONTH int, MONTH_LABEL string")


def weekdays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(WEEKDAY_NAMES, 1)), "DAY_OF_WEEK int, DAY_NAME string")
