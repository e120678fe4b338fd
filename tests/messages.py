"""Hand-made decoded messages of three activities; positions in semicircles."""

RUN = "2024-03-01T08.00.00+00.00_101.fit"
SWIM = "2024-03-02T09.30.00_102.fit"
EMPTY = "2024-03-03T10.00.00_103.fit"

HALF = str(2**30)  # 90 degrees


def run():
    yield "file_id", {"serial_number": "123456789012", "time_created": None, "manufacturer": "acme", "type": "activity"}
    yield "workout_step", {"intensity": "warmup"}
    yield "workout_step", {"intensity": "active"}
    for d, hr in [("0.0", "90"), ("100.0", "100"), ("100.5", "110"), ("250.0", None), (None, "120")]:
        yield "record", {
            "position_lat": HALF, "position_long": HALF, "timestamp": f"2024-03-01 08:00:0{len(d or '')}", "distance": d,
            "heart_rate": hr, "fractional_cadence": "0.5",
        }
    yield "record", {"position_lat": None, "position_long": None, "timestamp": "2024-03-01 08:00:09", "distance": "260"}
    yield "record", {"distance": "270", "timestamp": "2024-03-01 08:00:10"}
    yield "record", {"position_lat": HALF, "position_long": HALF, "distance": "5", "fractional_cadence": "0.96"}
    yield "lap", {"total_distance": "100.0", "wkt_step_index": "0", "avg_power": "200"}
    yield "lap", {"total_distance": "100.0", "wkt_step_index": "1", "total_ascent": "22.5"}
    yield "event", {"event": "timer", "event_type": "start", "data": "0", "timestamp": "2024-03-01 08:00:00"}
    yield "session", {
        "sport": "running", "sub_sport": "street", "start_time": "2024-03-01 08:00:00", "total_distance": "200",
        "total_timer_time": "600.5", "start_position_lat": HALF, "start_position_long": HALF, "avg_speed": "nan",
    }
    yield "activity", {"timestamp": None, "num_sessions": "1", "local_timestamp": "2024-03-01 09:00:00", "type": "manual"}


def swim():
    yield "file_id", {"time_created": "not a time", "serial_number": "7"}
    for i, kind in enumerate(["active", "active", "idle", "active", None, "active"]):
        yield "length", {"message_index": str(i), "length_type": kind, "total_strokes": "12"}
    yield "session", {
        "sport": "swimming", "sub_sport": "lap_swimming", "start_time": "2024-03-02 09:30:00", "pool_length": "22.86",
        "pool_length_unit": "yards", "total_distance": "100", "total_timer_time": "60",
    }
    yield "session", {"sport": "running", "start_time": "2024-03-02 10:00:00", "total_distance": "50"}
    yield "activity", {"timestamp": "2024-03-02 09:30:00", "num_sessions": "2"}
    yield "activity", {"timestamp": "2024-03-02 09:31:00", "num_sessions": "9"}


def empty():
    yield "session", {"sport": "running"}


def frame(spark, files):
    from lapwise.schemas import MESSAGES

    rows = [(f, i, name, fields) for f, make in files.items() for i, (name, fields) in enumerate(make())]
    return spark.createDataFrame(rows, MESSAGES)


def connect_frame(spark):
    return frame(spark, {RUN: run, SWIM: swim, EMPTY: empty})


def watch_frame(spark):
    return frame(
        spark, {"2024-03-01-08-00-00.fit": run, "2024-03-02-09-30-00.fit": swim, "2099-01-01-00-00-00.fit": run}
    )
