from pyspark.sql import functions as F

from tarmac.schemas import NAS_SNAPSHOT
from tarmac.sources import nas_feeds
from tests.conftest import rows

XML = """<?xml version="1.0"?>
<AIRPORT_STATUS_INFORMATION>
  <Update_Time>Tue</Update_Time>
  <Delay_type><Name>Ground Delay Programs</Name>
    <Ground_Delay_List>
      <Ground_Delay><ARPT>sfo</ARPT><Reason>low ceilings &amp; fog</Reason><Avg>1 hour and 5 minutes</Avg><Max>2 hours</Max></Ground_Delay>
      <Ground_Delay><Reason>wind</Reason><ARPT> ewr </ARPT><Avg>0 minutes</Avg></Ground_Delay>
    </Ground_Delay_List></Delay_type>
  <Delay_type><Name>General Arrival/Departure Delay Info</Name>
    <Arrival_Departure_Delay_List>
      <Delay id="7"><ARPT>JFK</ARPT><Reason>VOL</Reason>
        <Arrival_Departure Type="Departure"><Min>16 minutes</Min><Max>30 minutes</Max><Trend>Increasing</Trend></Arrival_Departure>
      </Delay>
    </Arrival_Departure_Delay_List></Delay_type>
  <Delay_type><Name>Airport Closures</Name>
    <Airport_Closure_List><Airport><ARPT>ANC</ARPT><Reason>snow</Reason><Start>x</Start><Reopen>noon</Reopen></Airport>
      <Airport><ARPT></ARPT><Reason>nobody</Reason></Airport>
      <Airport><Empty/><Other>no code</Other></Airport></Airport_Closure_List></Delay_type>
  <Delay_type><Name>Airspace Flow Programs</Name><Airspace_Flow_List><Airspace_Flow><CTL_Element>A</CTL_Element></Airspace_Flow></Airspace_Flow_List></Delay_type>
</AIRPORT_STATUS_INFORMATION>"""


def responses(spark, body, **more):
    frame = spark.createDataFrame([(body,)], "BODY string")
    stamps = {"SNAPSHOT_TS": F.lit("2024-01-05T06:00:00"), "FETCH_DATE": F.lit("2024-01-05")}
    return frame.withColumns({**stamps, **{name: F.lit(value) for name, value in more.items()}})


def shown(frame, *names):
    assert frame.columns == NAS_SNAPSHOT.names
    return sorted(rows(frame.select(*names)))


def test_xml(spark, tmp_path):
    (tmp_path / "snapshot.xml").write_text(XML)
    read = nas_feeds.read_responses(spark, str(tmp_path / "snapshot.xml"))
    stamps = {"SNAPSHOT_TS": F.lit("2024-01-05T06:00:00"), "FETCH_DATE": F.lit("2024-01-05")}
    frame = nas_feeds.rows_from_xml(read.withColumns(stamps))
    got = shown(
        frame, "IATA_CODE", "DELAY_TYPE", "REASON", "AVG_DELAY_MIN", "MIN_DELAY_MIN", "MAX_DELAY_MIN", "TREND", "END_TIME"
    )
    assert got == [
        ("ANC", "Closure", "snow", None, None, None, "", "noon"),
        ("EWR", "GroundDelay", "wind", None, None, None, "", ""),
        ("JFK", "ArriveDepart", "VOL", None, 16, 30, "Increasing", ""),
        ("SFO", "GroundDelay", "low ceilings & fog", 65, None, 120, "", ""),
    ]
    assert set(rows(frame.select("HAS_DELAY", "DELAY_COUNT", "FETCH_DATE"))) == {(True, 1, "2024-01-05")}


def test_a_long_list_without_airport_codes_is_read_in_linear_time(spark):
    entry = "<Airspace_Flow><CTL_Element>A</CTL_Element><Reason>x</Reason><Avg>5 minutes</Avg></Airspace_Flow>"
    coded = "<Airspace_Flow><ARPT>BOS</ARPT><Avg>5 minutes</Avg></Airspace_Flow>"
    body = (
        "<A><Delay_type><Name>Airspace Flow Programs</Name><Airspace_Flow_List>"
        + entry * 1000
        + coded
        + "</Airspace_Flow_List></Delay_type></A>"
    )
    assert rows(nas_feeds.rows_from_xml(responses(spark, body)).select("IATA_CODE", "AVG_DELAY_MIN")) == [("BOS", 5)]


def test_entries_of_any_list_and_depth():
    deep = (
        "<A><Delay_type><Name>New Programs</Name><Some_New_List><Group><Entry><ARPT>bos</ARPT><a><Min>1 minute</Min>"
        "<b><Max>2 minutes</Max></b><Max>3 minutes</Max></a><Min>4 minutes</Min></Entry></Group></Some_New_List>"
        "<Loose><ARPT>SEA</ARPT></Loose></Delay_type><Other><X><ARPT>LAX</ARPT></X></Other></A>"
    )
    found = list(nas_feeds.xml_entries(deep))
    assert [(name, entry["ARPT"]) for name, entry in found] == [("New Programs", "bos"), ("New Programs", "SEA")]
    assert (found[0][1]["Min"], found[0][1]["Max"]) == ("1 minute", "2 minutes") and "Min" not in found[1][1]
    assert list(nas_feeds.xml_entries("<A><Delay_type>")) == list(nas_feeds.xml_entries(None)) == []


def test_texts_are_whole_where_no_length_is_given(spark):
    body = XML.replace("low ceilings &amp; fog", "w" * 700)
    reason = F.max(F.length("REASON"))
    assert rows(nas_feeds.rows_from_xml(responses(spark, body)).select(reason)) == [(500,)]
    assert rows(nas_feeds.rows_from_xml(responses(spark, body), lengths={}).select(reason)) == [(700,)]


def test_xml_without_delays(spark):
    assert nas_feeds.rows_from_xml(responses(spark, "<AIRPORT_STATUS_INFORMATION/>")).count() == 0


AIRPORT = """{"Delay": true, "DelayCount": 2, "Status": [
  {"Type": "Ground Stop", "AvgDelay": "45 minutes", "Reason": "fog", "Trend": "Up", "EndTime": "9 pm"},
  {"type": "gdp", "min_delay": "10", "MaxDelay": "1 hour", "Reason": null}],
  "Weather": {"Temp": ["72.0 F (22 C)"], "Visibility": [10.00], "Wind": ["North at 4"], "Conditions": " Fair "}}"""


def test_airport_json(spark):
    frame = nas_feeds.rows_from_airport_json(responses(spark, AIRPORT, IATA_CODE="ord"))
    got = shown(
        frame, "IATA_CODE", "HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "REASON", "MAX_DELAY_MIN", "WEATHER_TEMP_F",
        "WEATHER_VIS_MI", "WEATHER_WIND", "WEATHER_CONDITION",
    )
    weather = (72.0, 10.0, "North at 4", "Fair")
    assert got == [
        ("ORD", True, 2, "GroundDelay", "", 60, *weather),
        ("ORD", True, 2, "GroundStop", "fog", None, *weather),
    ]
    assert shown(frame, "DELAY_TYPE", "AVG_DELAY_MIN", "MIN_DELAY_MIN", "TREND", "END_TIME") == [
        ("GroundDelay", None, 10, "", ""),
        ("GroundStop", 45, None, "Up", "9 pm"),
    ]


def test_airport_json_lower_case_and_no_delay(spark):
    quiet = '{"delay": false, "status": [], "weather": {"temp": "50 F", "wind": ""}}'
    frame = nas_feeds.rows_from_airport_json(responses(spark, quiet, IATA_CODE="ATL"))
    assert rows(frame.select("HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "REASON", "WEATHER_TEMP_F", "WEATHER_WIND")) == [
        (False, 0, None, None, 50.0, None)
    ]
    no_list = nas_feeds.rows_from_airport_json(responses(spark, '{"Delay": true, "Status": "x"}', IATA_CODE="ATL"))
    assert rows(no_list.select("HAS_DELAY", "DELAY_TYPE")) == [(False, None)]


def test_aggregate_json(spark):
    body = """{"airport_status_information": {"delay_type": [
        {"Name": "Ground Stop Programs", "airport_closure_list": [
            {"ARPT": " atl ", "Avg": "30 minutes", "Reason": "x"}, {"airport": "dfw", "max_delay": "1 hour"}, {"Reason": "no code"}]},
        {"airport_closure_list": [{"ARPT": "LAX"}]}, {"Name": "Airport Closures", "airport_closure_list": "none"}]}}"""
    frame = nas_feeds.rows_from_aggregate_json(responses(spark, body))
    assert shown(frame, "IATA_CODE", "DELAY_TYPE", "AVG_DELAY_MIN", "MAX_DELAY_MIN", "REASON") == [
        ("ATL", "GroundStop", 30, None, "x"),
        ("DFW", "GroundStop", None, 60, ""),
        ("LAX", "Unknown", None, None, ""),
    ]
    bare = nas_feeds.rows_from_aggregate_json(
        responses(spark, '{"delay_type": [{"Name": "GDP", "airport_closure_list": [{"ARPT": "BOS"}]}]}')
    )
    assert shown(bare, "IATA_CODE", "DELAY_TYPE") == [("BOS", "GroundDelay")]


def test_entries_of_a_large_response_come_in_parts(spark):
    entry = "<E><ARPT>atl</ARPT><Avg>5 minutes</Avg></E>"
    body = f"<A><Delay_type><Name>Ground Stop</Name>{entry * (2 * nas_feeds.ENTRIES_PER_PART + 1)}</Delay_type></A>"
    responses = spark.createDataFrame([("2024-01-01T00:00:00", "2024-01-01", body), (None, None, "no xml")], "SNAPSHOT_TS string, FETCH_DATE string, BODY string")
    found = nas_feeds.rows_from_xml(responses.coalesce(1))
    assert found.count() == 2 * nas_feeds.ENTRIES_PER_PART + 1
    assert [row[0] for row in found.select("AVG_DELAY_MIN").distinct().collect()] == [5]
