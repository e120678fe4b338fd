"""TCX and GPX files; all values made up."""

import datetime

import pytest

from lapwise.sources.tables import list_files
from lapwise.sources.tracks import gpx_points, parse_tcx, read_gpx, read_tcx, tcx_laps, tcx_points

TCX = """<?xml version="1.0" encoding="UTF-8"?>
<TrainingCenterDatabase xmlns="urn:example:training" xmlns:ns3="urn:example:extension">
  <Activities>
    <Activity Sport="Running">
      <Id>2024-01-01T00:00:00.000Z</Id>
      <Lap StartTime="2024-01-01T00:00:00.000Z">
        <TotalTimeSeconds>61.5</TotalTimeSeconds><DistanceMeters>200.0</DistanceMeters>
        <MaximumSpeed>4.5</MaximumSpeed>
        <AverageHeartRateBpm><Value>120</Value></AverageHeartRateBpm>
        <MaximumHeartRateBpm><Value>150</Value></MaximumHeartRateBpm>
        <Track>
          <Trackpoint>
            <Time>2024-01-01T00:00:01.000Z</Time>
            <Position><LatitudeDegrees>1.5</LatitudeDegrees><LongitudeDegrees>-2.5</LongitudeDegrees></Position>
            <AltitudeMeters>10.5</AltitudeMeters>
            <HeartRateBpm><Value>100</Value></HeartRateBpm><Cadence>80</Cadence>
            <Extensions><ns3:TPX><ns3:Speed>3.25</ns3:Speed><ns3:RunCadence>77</ns3:RunCadence></ns3:TPX></Extensions>
          </Trackpoint>
          <Trackpoint><Time>2024-01-01T00:00:02.000Z</Time><AltitudeMeters>11</AltitudeMeters></Trackpoint>
        </Track>
        <Track><Trackpoint><Time>2024-01-01T00:00:03.000Z</Time>
          <Position><LatitudeDegrees>9</LatitudeDegrees><LongitudeDegrees>9</LongitudeDegrees></Position>
        </Trackpoint></Track>
      </Lap>%s
    </Activity>
    <Activity Sport="Biking"><Lap StartTime="2020-01-01T00:00:00.000Z"></Lap></Activity>
  </Activities>
</TrainingCenterDatabase>
"""
BARE_LAP = '<Lap StartTime="2024-01-01T00:10:00.000Z"></Lap>'
LAST_LAP = """<Lap StartTime="2024-01-01T00:20:00.000Z"><Track><Trackpoint>
  <Time>2024-01-01T00:20:01.000Z</Time>
  <Position><LatitudeDegrees>3</LatitudeDegrees><LongitudeDegrees>4</LongitudeDegrees></Position>
</Trackpoint></Track></Lap>"""

GPX = """<?xml version="1.0" encoding="UTF-8"?>
<gpx version="1.1" xmlns="urn:example:gpx" xmlns:ns3="urn:example:extension">
  <metadata><time>2024-01-01T00:00:00.000Z</time></metadata>
  <trk><name>a</name><type>running</type>
    <trkseg>
      <trkpt lat="1.5" lon="-2.5"><ele>10.5</ele><time>2024-01-01T00:00:01.000Z</time>
        <extensions><ns3:TrackPointExtension><ns3:hr>100</ns3:hr><ns3:cad>80</ns3:cad></ns3:TrackPointExtension></extensions>
      </trkpt>
      <trkpt lat="1.6" lon="-2.6"><ele>11.5</ele><time>2024-01-01T00:00:02.000Z</time>
        <extensions><ns3:TrackPointExtension><ns3:hr>101</ns3:hr></ns3:TrackPointExtension></extensions>
      </trkpt>
      <trkpt lat="1.7" lon="-2.7"></trkpt>
    </trkseg>
    <trkseg><trkpt lat="8" lon="8"></trkpt></trkseg>
  </trk>
  <trk><trkseg><trkpt lat="9" lon="9"></trkpt></trkseg></trk>
</gpx>
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("tracks")
    (path / "one.tcx").write_text(TCX % "")
    (path / "three.tcx").write_text(TCX % (BARE_LAP + LAST_LAP))
    (path / "a.gpx").write_text(GPX)
    (path / "note.txt").write_text("no track")
    return str(path)


def utc(*parts):
    return datetime.datetime(*parts, tzinfo=datetime.timezone.utc)


def test_tcx(spark, folder):
    activities = read_tcx(spark, folder)
    laps = tcx_laps(activities).orderBy("file", "number").collect()
    assert [(r["file"], r["number"], r["distance"]) for r in laps] == [
        ("one.tcx", 1, 200.0), ("three.tcx", 1, 200.0), ("three.tcx", 2, None), ("three.tcx", 3, None),
    ]
    first = laps[0]
    assert first["total_time"] == datetime.timedelta(seconds=61.5)
    assert (first["max_speed"], first["max_hr"], first["avg_hr"]) == (4.5, 150.0, 120.0)
    assert first["start_time"].astimezone(datetime.timezone.utc) == utc(2024, 1, 1)
    points = tcx_points(activities).orderBy("file", "lap").collect()
    assert [(r["file"], r["lap"], r["latitude"], r["longitude"]) for r in points] == [
        ("one.tcx", 1, 1.5, -2.5), ("three.tcx", 1, 1.5, -2.5), ("three.tcx", 3, 3.0, 4.0),
    ]
    p = points[0]
    assert (p["elevation"], p["heart_rate"], p["cadence"], p["speed"]) == (10.5, 100, 80, 3.25)
    assert p["time"].astimezone(datetime.timezone.utc) == utc(2024, 1, 1, 0, 0, 1)
    assert points[2]["cadence"] is None and points[2]["speed"] is None


def test_gpx(spark, folder):
    points = gpx_points(read_gpx(spark, folder)).orderBy("latitude").collect()
    assert [(r["latitude"], r["longitude"], r["elevation"], r["heart_rate"], r["cadence"]) for r in points] == [
        (1.5, -2.5, 10.5, 100, 80), (1.6, -2.6, 11.5, 101, None), (1.7, -2.7, None, None, None),
    ]
    assert points[0]["time"].astimezone(datetime.timezone.utc) == utc(2024, 1, 1, 0, 0, 1)


def test_listing(spark, folder):
    assert sorted(r["file"] for r in list_files(spark, folder, "*.tcx").collect()) == ["one.tcx", "three.tcx"]


@pytest.mark.parametrize("inside, speed", [
    ("<Extensions><ns3:TPX><ns3:RunCadence>7</ns3:RunCadence><ns3:Speed>3.25</ns3:Speed></ns3:TPX></Extensions>", 3.25),
    ("<Extensions><a><b c='1'><d><ns3:Speed unit='m'> 1.5 </ns3:Speed></d></b></a></Extensions>", 1.5),
    ("<ns3:Speed>2</ns3:Speed>", 2.0), ("<Extensions><Speed>0.5</Speed></Extensions>", 0.5),
    ("<Extensions><ns3:SpeedZone>4</ns3:SpeedZone></Extensions>", None), ("<Extensions/>", None), ("", None),
    ("<Extensions><ns3:Speed>fast</ns3:Speed></Extensions>", None), ("<Other><ns3:Speed>6</ns3:Speed></Other>", 6.0),
])
def test_speed_at_any_depth(spark, tmp_path, inside, speed):
    """From text and from files."""
    text = TCX.replace("<Extensions><ns3:TPX><ns3:Speed>3.25</ns3:Speed><ns3:RunCadence>77</ns3:RunCadence></ns3:TPX></Extensions>", inside) % ""
    (tmp_path / "one.tcx").write_text(text)
    docs = spark.createDataFrame([("one.tcx", text)], "file string, doc string")
    for activities in (read_tcx(spark, str(tmp_path)), parse_tcx(docs, "file", "doc")):
        points = tcx_points(activities).collect()
        assert [(r["speed"], r["heart_rate"], r["cadence"]) for r in points] == [(speed, 100, 80)]
