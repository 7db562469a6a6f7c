"""Silver tables, marts, sources, sinks, checks and streams on small trees and golden cases."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pulselake.marts import gold
from pulselake.operators import relational as R
from pulselake.quality import catalog
from pulselake.quality import checks as Q
from pulselake.sources import files, sinks
from pulselake.streaming import ingest
from pulselake.tables import silver

D, T = dt.date, dt.datetime


def pay(spark, *bodies, dt_="2026-03-02"):
    rows = [(f"/b/s/c/dt={b[2] if len(b) > 2 else dt_}/c_{b[0]:013d}_ab.json", b[1] if isinstance(b[1], str) else json.dumps(b[1])) for b in bodies]
    return spark.createDataFrame(rows, files.PAYLOAD)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_sleep_tables(spark):
    dto = {"calendarDate": "2026-01-02", "sleepTimeSeconds": 3600, "sleepStartTimestampGMT": 1767312000000, "sleepScores": {"overall": {"value": 81}}}
    g = silver.sleep_garmin(pay(spark, (1, {"dailySleepDTO": dto | {"sleepTimeSeconds": 60}}), (2, {"dailySleepDTO": dto, "restingHeartRate": 48}), (3, {"x": 1}), (4, "{cut")))
    r = one(g)
    assert (r["night_date"], r["garmin_total_min"], r["garmin_rhr"], r["garmin_sleep_score"], r["garmin_start_gmt"]) == (D(2026, 1, 2), 60.0, 48, 81, T(2026, 1, 2))
    rec = {"id": "a", "start": "2026-01-01T22:00:00Z", "end": "2026-01-02T02:00:00Z", "updated_at": "1", "timezone_offset": "-05:00", "nap": False, "score": {"sleep_performance_percentage": 50.0, "stage_summary": {"total_awake_time_milli": 60000}}}
    recs = [rec, rec | {"updated_at": "2", "score": {"sleep_performance_percentage": 70.0}}, rec | {"id": "n", "nap": True, "timezone_offset": None}, rec | {"id": None}]
    w = silver.sleep_whoop(pay(spark, (1, {"records": recs}), (2, {"records": {}}), (3, {"records": None})))
    by = {r["whoop_sleep_id"]: r for r in w.collect()}
    assert set(by) == {"a", "n"} and by["a"]["night_date"] == D(2026, 1, 1) and by["a"]["whoop_performance_pct"] == 70.0 and by["n"]["night_date"] == D(2026, 1, 2) and by["n"]["is_nap"]
    u = silver.sleep_unified(g, w).orderBy("night_date").collect()
    assert [(r["night_date"], r["has_garmin"], r["has_whoop"]) for r in u] == [(D(2026, 1, 1), False, True), (D(2026, 1, 2), True, False)]
    assert "whoop_sleep_id" not in u[0].asDict() and "is_nap" not in u[0].asDict()


def test_whoop_records(spark):
    r = one(silver.recovery(pay(spark, (1, {"records": [{"cycle_id": 5, "sleep_id": "s", "created_at": "2026-01-02T10:00:00Z", "updated_at": "1", "score": {"recovery_score": 40.0}}, {"cycle_id": 5, "created_at": "2026-01-02T10:00:00Z", "updated_at": "2", "score": {"recovery_score": 55.0, "user_calibrating": True}}, {"x": 1}]}))))
    assert (r["cycle_id"], r["recovery_date"], r["recovery_score"], r["user_calibrating"]) == (5, D(2026, 1, 2), 55.0, True)
    r = one(silver.strain(pay(spark, (1, {"records": [{"id": 9, "start": "2026-01-02T02:00:00Z", "end": None, "timezone_offset": "-04:30", "updated_at": "1", "score": None, "score_state": "PENDING"}]}))))
    assert (r["strain_date"], r["day_strain"], r["score_state"], r["end_ts"]) == (D(2026, 1, 1), None, "PENDING", None)
    r = one(silver.whoop_workouts(pay(spark, (1, {"records": [{"id": "w", "start": "2026-01-02T12:00:00Z", "timezone_offset": "+01:00", "sport_id": "3.6", "updated_at": "1", "score": {"strain": 9.5}}]}))))
    assert (r["workout_id"], r["workout_date"], r["sport_id"], r["strain"], r["distance_m"]) == ("w", D(2026, 1, 2), 4, 9.5, None)


def test_garmin_tables(spark):
    act = {"activityId": 9007199254740993, "activityName": "run", "activityType": {"typeKey": "running"}, "startTimeLocal": "2026-01-02 07:00:00", "averageHR": 120, "hrTimeInZone_1": 5.5}
    w = silver.workouts(pay(spark, (1, [act, act | {"activityId": 2}]), (2, [act | {"activityName": "renamed"}]), (3, [])))
    by = {r["activity_id"]: r for r in w.collect()}
    assert set(by) == {9007199254740993, 2} and by[9007199254740993]["activity_name"] == "renamed" and by[2]["hr_z1_sec"] == 5.5 and by[2]["activity_date"] == D(2026, 1, 2)
    laps = silver.workout_splits(pay(spark, (1, {"activityId": 1, "lapDTOs": [{"lapIndex": 1, "distance": 10.0}, {"lapIndex": 2}]}), (2, {"activityId": 1, "lapDTOs": [{"lapIndex": 1, "distance": 12.0}]}), (3, {"activityId": 3, "lapDTOs": {}})))
    assert sorted((r["lap_index"], r["distance_m"]) for r in laps.collect()) == [(1, 12.0), (2, None)]
    r = one(silver.daily(pay(spark, (1, {"calendarDate": "2026-01-02", "totalSteps": 100}), (2, {"calendarDate": "2026-01-02", "totalSteps": "52.4", "averageStressLevel": -1, "maxStressLevel": 80, "floorsAscended": 3.5}), (3, {"calendarDate": "2026"}))))
    assert (r["total_steps"], r["avg_stress_level"], r["max_stress_level"], r["floors_ascended"]) == (52, None, 80, 3.5) and len(r) == 35
    r = one(silver.body(pay(spark, (1, {"dateWeightList": [{"samplePk": 4, "calendarDate": "2026-01-02", "timestampGMT": 1767312000000, "weight": 80500, "bmi": 24.1}]}), (2, {"dateWeightList": []}))))
    assert (r["sample_pk"], r["weight_kg"], r["measured_ts_utc"]) == (4, 80.5, T(2026, 1, 2))
    fit = silver.fitness(pay(spark, (1, [{"generic": {"vo2MaxValue": 48.0}}]), (2, [])), pay(spark, (1, '{"mostRecentTrainingStatus":{"latestTrainingStatusData":{"9":{"trainingStatus":7},"1":{"trainingStatus":2}}}}')), pay(spark, (1, {"time5K": 1500}, "2026-03-05")))
    by = {r["snapshot_date"]: r for r in fit.collect()}
    assert by[D(2026, 3, 2)]["vo2max_running"] == 48.0 and by[D(2026, 3, 2)]["training_status_code"] == 7 and by[D(2026, 3, 5)]["race_5k_sec"] == 1500


def test_glucose(spark):
    rows = [("2026-03-15T23:30-04:00", "100", 1), ("2026-03-15T08:47-04:00", "90", 1), ("2026-03-15T07:47-05:00", "90", 2), ("bad", "1", 1), ("2026-03-15T10:00", "", 1), ("2026-03-15T09:00+05:30", "88.4", 1)]
    df = spark.createDataFrame([(a, b, f"x_{c:013d}_y.csv") for a, b, c in rows], "ts string, mgdl string, filename string")
    by = {r["reading_ts_utc"]: r for r in silver.glucose(df).collect()}
    assert by[T(2026, 3, 16, 3, 30)]["tz_offset_minutes"] == -240
    assert by[T(2026, 3, 15, 12, 47)]["reading_ts_local"] == T(2026, 3, 15, 7, 47)
    assert by[T(2026, 3, 15, 3, 30)]["mgdl"] == 88 and None in by and len(by) == 4


def test_weather(spark):
    line = ["3", "20240701", "0200", "20240630", "2200", "v", "0", "0", "20.0", "20.1", "-9999.0", "19.9", "0.0", "100", "0", "1", "0", "1", "0", "C", "25.0", "0", "26.0", "3", "24.0", "0", "50", "0", "0.2", "-99.000"] + ["0.1"] * 3 + ["10.0"] * 5
    df = spark.createDataFrame([("x_0000000000001_y.txt", "\0\0" + "  ".join(line)), ("x_0000000000002_y.txt", "junk line")], "filename string, line string")
    r = one(silver.weather(df))
    assert (r["wbanno"], r["obs_ts_local"], r["obs_date_local"]) == ("3", T(2024, 6, 30, 22), D(2024, 6, 30))
    assert (r["air_temp_c"], r["air_temp_max_c"], r["solar_rad_wm2"], r["surface_temp_max_c"], r["soil_moisture_10"]) == (20.1, None, 100.0, None, None)
    winter = df.withColumn("line", F.replace("line", F.lit("20240701"), F.lit("20240101")))
    assert one(silver.weather(winter))["obs_ts_local"] == T(2023, 12, 31, 21)


def test_wellness_mart(spark):
    mk = lambda name, rows: spark.createDataFrame(rows, gold.WELLNESS_INPUTS[name])
    d = [D(2026, 1, k) for k in range(1, 6)]
    t = {
        "sleep": mk("sleep", [(d[0], 80, 400.0, 50, None, None), (d[2], None, 300.0, 51, 70.0, 90.0)]),
        "recovery": mk("recovery", [(101, d[1], T(2026, 1, 2, 6), 40.0, 50.0, 60.0, 97.0), (103, d[1], T(2026, 1, 2, 9), 66.0, 50.0, 60.0, 97.0)]),
        "strain": mk("strain", [(103, d[1], 10.0, 418.4, 70, 150)]),
        "workouts": mk("workouts", [(d[1], 1800.0, 5000.0, 300.0), (d[1], 600.0, 1000.0, 50.0)]),
        "glucose": mk("glucose", [(d[0], v) for v in (60, 100, 120, 200)]),
        "body": mk("body", [(D(2025, 12, 20), 80.0, 24.0, 15.0), (d[3], 81.0, 24.0, 15.0)]),
        "daily": mk("daily", [(d[4], 5000, 100.0, 4000.0, 3.0, 10, 20, 30, 90, 20)]),
    }
    m = gold.daily_wellness(t)
    rows = {r["day"]: r for r in m.collect()}
    assert list(sorted(rows)) == d and len(m.columns) == 45
    assert rows[d[1]]["recovery_score"] == 66.0 and abs(rows[d[1]]["strain_kilocalories"] - 100.0) < 1e-9
    assert (rows[d[1]]["workout_count"], rows[d[1]]["workout_total_min"], rows[d[0]]["workout_count"], rows[d[0]]["workout_total_min"]) == (2, 40.0, 0, None)
    assert [rows[d[0]][f"glucose_{k}"] for k in ("tir_pct", "pct_below", "pct_above")] == [50.0, 25.0, 25.0]
    assert [rows[x]["weight_kg"] for x in d] == [80.0, 80.0, 80.0, 81.0, 81.0]
    assert rows[d[4]]["intensity_minutes"] == 30 and rows[d[4]]["distance_km"] == 4.0 and not rows[d[0]]["has_daily"] and rows[d[0]]["has_weight"]
    assert gold.daily_wellness({"glucose": t["glucose"]}).count() == 1
    assert gold.daily_wellness({"body": t["body"]}).count() == 0
    assert all(r["passed"] for r in Q.table_checks(m, "daily_wellness").collect())


def test_weather_mart(spark):
    cols = "obs_date_local date, air_temp_c double, air_temp_max_c double, air_temp_min_c double, precip_mm double, solar_rad_wm2 double, surface_temp_max_c double, surface_temp_min_c double, rh_pct double, " + ", ".join(f"soil_{k}_{d} double" for k in ("temp", "moisture") for d in gold.DEPTHS)
    row = lambda day, mx, mn: (day, mx, mx, mn, 25.4, 5.0, mx, mn, 50.0, *[0.2] * 10)
    w = spark.createDataFrame([row(D(2026, 1, 1), 28.0, 12.0), row(D(2026, 1, 3), 5.0, -2.0), (D(2026, 1, 4), *[None] * 18), (None, *[1.0] * 18)], cols)
    m = gold.daily_weather(w)
    r = {x["day"].day: x for x in m.collect()}
    assert len(m.columns) == 25 and abs(r[1]["gdd50"] - 18) < 1e-9 and not r[1]["frost"] and abs(r[1]["precip_total_in"] - 1) < 1e-9
    assert r[3]["frost"] and not r[3]["hard_freeze"]
    assert (r[2]["gdd50"], r[2]["frost"], r[2]["hours_observed"], r[2]["has_weather"]) == (None, None, 0, False)
    assert (r[4]["gdd50"], r[4]["frost"], r[4]["hours_observed"]) == (0.0, None, 1)
    assert gold.daily_weather(w.limit(0)).count() == 0


def test_checks_fail_when_a_value_is_corrupted(spark):
    good = spark.createDataFrame([(D(2026, 1, 1), 50.0), (D(2026, 1, 2), None)], "night_date date, whoop_performance_pct double")
    assert all(r["passed"] for r in Q.table_checks(good, "sleep").collect())
    bad = good.union(spark.createDataFrame([(D(2026, 1, 2), 999.0), (None, 1.0)], good.schema))
    found = {r["check_name"]: r["found"] for r in Q.table_checks(bad, "sleep").collect()}
    assert found == {"sleep_repeated": 1, "sleep_null_keys": 1, "sleep_out_of_range": 1}
    assert Q.alerts(Q.table_checks(bad, "sleep")).count() == 3
    assert all(r["passed"] for r in Q.table_checks(good.limit(0), "sleep").collect())


def test_tree_sources_and_integrity(spark, tmp_path):
    root = str(tmp_path / "bronze")
    put = lambda coll, body, day, ms, **kw: sinks.capture(root, "src", coll, body, day=day, now_ms=ms, **({"ending": "json"} | kw))
    a = put("sleep", b'{"a":1}', "2026-01-01", 1_700_000_000_001)
    assert put("sleep", b'{"a":1}', "2026-01-01", 1_700_000_000_002) is None and put("sleep", b'{"a":1}', "2026-01-01", 1_700_000_000_003, dedupe=False)
    assert put("sleep", b"x", "2026-01-01", 1_700_000_000_004, meta={"http_status": 500}) is None
    b = put("sleep", b"[]\n\n", "2026-01-02", 1_700_000_000_005)
    p = files.payloads(spark, root, "src", "sleep")
    assert p.count() == 3 and p.where(F.col("filename").contains("meta")).count() == 0
    assert files.payloads(spark, root, "src", "none").count() == 0 and files.malformed(p).count() == 0
    put("csv", b"A,B\n1,2\n", "2026-01-01", 1_700_000_000_006, ending="csv")
    put("csv", b"B,A,C\n3,4,5\n", "2026-01-02", 1_700_000_000_007, ending="csv")
    rows = files.csv_rows(spark, root, "src", "csv", {"a": "A", "b": "B", "c": "C"})
    assert sorted((r["a"], r["b"], r["c"]) for r in rows.collect()) == [("1", "2", None), ("4", "3", "5")]
    put("txt", b"1 20260101 x\n\n1 20260102 y\n", "2026-01-01", 1_700_000_000_008, ending="txt")
    lines = files.text_lines(spark, root, "src", "txt")
    assert lines.count() == 2 and [r["line"] for r in files.rows_of_day(lines, "20260102").collect()] == ["1 20260102 y"]
    caps = files.captures(spark, root)
    assert caps.count() == 6 and Q.integrity(caps).count() == 0 and one(Q.inventory(caps).where("collection_name = 'sleep'"))["files"] == 3
    a.write_bytes(b'{"a":')
    next(b.parent.glob("*.meta.json")).unlink()
    assert {r["issue"] for r in Q.integrity(files.captures(spark, root)).collect()} == {"HASH_MISMATCH", "SIZE_MISMATCH", "NOT_JSON", "MISSING_SIDECAR"}
    same = spark.createDataFrame([("s", "c", "d", 1, "x"), ("s", "c", "d", 2, "x"), ("s", "c", "d", 3, "y")], "source_name string, collection_name string, dt string, fetched_ms long, content string")
    old = spark.createDataFrame([("s", "c", "d", 0, "y")], same.schema)
    assert sorted((r["fetched_ms"], r["content"]) for r in sinks.new_captures(same, old).collect()) == [(1, "x"), (3, "y")]
    again = spark.createDataFrame([("s", "c", "d", k, c) for k, c in enumerate("yxyyx", 1)], same.schema)
    assert sorted(r["fetched_ms"] for r in sinks.new_captures(again, old).collect()) == [2, 3, 5]
    assert sorted(r["fetched_ms"] for r in sinks.new_captures(again, old.limit(0)).collect()) == [1, 2, 3, 5]


def test_captures_never_raise_and_tell_endings(tmp_path):
    root = str(tmp_path)
    one_ = sinks.capture(root, "s", "c", b"a", day="2026-01-01", now_ms=1_700_000_000_001, meta={"content_type": "text/html", "stored_encoding": "gzip"})
    side = json.loads(next(one_.parent.glob("*.meta.json")).read_text())
    assert one_.name.endswith(".bin.gz") and (side["stored_encoding"], side["schema_version"], side["fetched_at"]) == ("gzip", "v1", "2023-11-14T22:13:20.001Z")
    assert sinks.capture(root, "s", "c", "text", day="2026-01-01") is None and sinks.capture(root, "s", "c", b"a", day="2026-01-01", meta={"content_type": "text/html"}) is None
    assert sinks.capture(root, "s", "c", b"b", day="2026-01-01", now_ms=1_700_000_000_002) and sinks.capture(root, "s", "c", b"a", day="2026-01-01", now_ms=1_700_000_000_003)  # A, B, A
    (one_.parent / "odd.meta.json").write_text("no json")
    assert sinks.capture(root, "s", "c", b"a", day="2026-01-01", now_ms=1_700_000_000_004) is None  # an odd name counts as the oldest
    (tmp_path / "blocked").write_text("a file, no folder")
    assert sinks.capture(str(tmp_path / "blocked"), "s", "c", b"a") is None
    assert sinks.capture_lines(root, "s", "l", [], "2026-01-01") is None and sinks.capture_lines(root, "s", "l", ["1 20260101 x"], "2026-01-01").read_bytes() == b"1 20260101 x\n"
    assert sinks.capture_parsed(root, "s", "p", []) is None
    kept = sinks.capture_parsed(root, "s", "p", {"a": 1, "myToken": 2}, day="2026-01-01", screen=True)
    assert kept.read_bytes() == b'{"a":1}' and json.loads(next(kept.parent.glob("*.meta.json")).read_text())["redacted_fields"] == ["myToken"]
    assert [sinks.ending_of(t) for t in ("application/json; charset=utf-8", "TEXT/CSV", "text/xml", "text/plain", None)] == ["json", "csv", "xml", "txt", "bin"]


def test_atomic_write(spark, tmp_path):
    dest = str(tmp_path / "silver" / "t.parquet")
    assert sinks.write_parquet_atomic(spark.range(7), dest) == 7
    assert sinks.write_parquet_atomic(spark.range(3), dest, str(tmp_path / "bronze")) == 3
    assert sinks.read_published(spark, dest).count() == 3
    reader = sinks.read_published(spark, dest)
    assert sinks.write_parquet_atomic(spark.range(5), dest) == 5 and reader.count() == 3 and sinks.read_published(spark, dest).count() == 5
    assert len([p for p in (tmp_path / "silver" / "t.parquet").iterdir() if p.is_dir()]) == 2
    assert sinks.read_published(spark, str(tmp_path / "none"), "a int").count() == 0
    with pytest.raises(ValueError):
        sinks.write_parquet_atomic(spark.range(1), str(tmp_path / "bronze" / "x"), str(tmp_path / "bronze"))
    assert files.parquet_or_empty(spark, str(tmp_path / "no"), "a int").count() == 0


def test_secrets_in_a_column(spark):
    df = spark.createDataFrame([(1, '{"a":{"apiKey":1,"b":[{"token":2,"c":3}]}}'), (2, '{"a":"token"}'), (3, "token no json"), (4, None)], "k int, j string")
    got = {r["k"]: (r["j"], r["redacted_fields"]) for r in sinks.screened(df, "j").collect()}
    assert got == {1: ('{"a":{"b":[{"c":3}]}}', ["a.apiKey", "a.b[0].token"]), 2: ('{"a":"token"}', []), 3: ("token no json", []), 4: (None, [])}


def test_secrets_and_bytes():
    kept, gone = sinks.screen_secrets({"a": [{"accessToken": 1, "b": 2}], "PASSWORD": "x", "next": {"session_id": 3}})
    assert kept == {"a": [{"b": 2}], "next": {}} and sorted(gone) == ["PASSWORD", "a[0].accessToken", "next.session_id"]
    assert sinks.json_bytes({"b": "é", "a": 1}) == '{"b":"é","a":1}'.encode()
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_baseline(tmp_path):
    p = str(tmp_path / "state" / "b.json")
    assert Q.read_baseline(p) == {}
    Q.write_baseline(p, {"s": ["a"]}, str(tmp_path / "bronze"))
    assert Q.read_baseline(p) == {"s": ["a"]}
    with pytest.raises(ValueError):
        Q.write_baseline(str(tmp_path / "bronze" / "b.json"), {}, str(tmp_path / "bronze"))


def test_streams(spark, tmp_path):
    src, out, chk = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "chk")
    src.mkdir()
    (src / "a.json").write_text('{"k":1,"v":1}')
    (src / "a.meta.json").write_text("{}")
    for n in (1, 1, 2):
        if n == 2:
            (src / "b.json").write_text('{"k":1,"v":2}')
        q = ingest.ingest_available(ingest.new_files(spark, str(src)), out, chk)
        q.awaitTermination(60)
        assert spark.read.parquet(out).count() == n
    dest = str(tmp_path / "latest")
    s = ingest.new_files(spark, str(src)).select(F.get_json_object("j", "$.k").alias("k"), F.get_json_object("j", "$.v").alias("v"))
    ingest.upsert_latest(s, dest, str(tmp_path / "chk2"), ["k"], ["v"]).awaitTermination(60)
    (src / "c.json").write_text('{"k":1,"v":0}')
    ingest.upsert_latest(s, dest, str(tmp_path / "chk2"), ["k"], ["v"]).awaitTermination(60)
    assert [tuple(r) for r in ingest.current_table(spark, dest).collect()] == [("1", "2")]
    for i in range(3):
        (src / f"d{i}.json").write_text(f'{{"k":"{i}","v":9}}')
        ingest.upsert_latest(s, dest, str(tmp_path / "chk2"), ["k"], ["v"]).awaitTermination(60)
    assert sorted(tuple(r) for r in ingest.current_table(spark, dest).collect()) == [("0", "9"), ("1", "9"), ("2", "9")]
    assert len(list((tmp_path / "latest").glob("manifest-*.json"))) == 2
    assert ingest.day_partitions(D(2026, 1, 1), D(2026, 1, 4), 1) == ["2026-01-01", "2026-01-02", "2026-01-03", "2026-01-04"] and ingest.trailing_partitions(["a", "b", "c"], 2) == ["b", "c"]


def test_asof_join(spark):
    left = spark.createDataFrame([(1, T(2024, 1, 1)), (1, T(2024, 5, 1)), (1, T(2023, 1, 1)), (2, T(2024, 5, 1)), (None, T(2024, 5, 1)), (1, None)], "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, T(2024, 1, 1), "a", 1), (1, T(2024, 1, 1), "b", 2), (1, T(2024, 2, 9), "c", 1), (None, T(2024, 1, 1), "z", 1), (1, None, "n", 1)], "k int, s timestamp_ntz, v string, tie int")
    got = sorted((tuple(r) for r in R.asof_join(left, right, "t", "s", ["k"], ["v"], tie="tie").collect()), key=str)
    assert got == sorted([(1, T(2024, 1, 1), "b"), (1, T(2024, 5, 1), "c"), (1, T(2023, 1, 1), None), (2, T(2024, 5, 1), None), (None, T(2024, 5, 1), None), (1, None, None)], key=str)


def test_small_relational(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (None, 1, "c"), (None, 2, "d")], "k int, o int, v string")
    assert sorted(r["v"] for r in R.dedup_latest(df, ["k"], ["o"]).collect()) == ["b", "d"]
    assert R.date_spine(spark.createDataFrame([(D(2024, 1, 2), D(2024, 1, 1))], "lo date, hi date"), "lo", "hi").count() == 0
    assert R.spread_sample(spark.range(11).withColumn("g", F.lit(1)), "g", ["id"], 3).orderBy("id").toPandas()["id"].tolist() == [0, 5, 10]
    many = spark.range(97).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), "id")
    for n in (1, 2, 5, 200):
        whole = R.spread_sample(many, "g", ["id"], n).collect()
        cut = R.spread_sample(many, "g", ["id"], n, F.floor(F.col("id") / 10)).collect()
        assert sorted(map(str, whole)) == sorted(map(str, cut)) and len(whole) == min(97, 3 * n if n < 30 else 97)


def test_sweep(spark):
    rows = [(g, k, f"f{k}.json", b, st) for g, bodies in (("good", [("[1]", 200)] * 9), ("bad", [("[1]", 200), ("{cut", 200), ("[1]", 503)]), ("none", [("[]", None)])) for k, (b, st) in enumerate(bodies)]
    df = spark.createDataFrame(rows, "stream string, k int, file_name string, j string, http_status int").withColumn("source", F.lit("s"))
    got = {r["stream"]: (r["seen"], r["state"]) for r in Q.sweep(df, ["source", "stream"], ["k"]).collect()}
    assert got == {"good": (5, "HEALTHY"), "bad": (3, "MIXED"), "none": (1, "NO_DATA")}


CONFIG = "source_name string, collection_name string, reader string, unnest_records boolean, event_date_source string, event_date_field string, cadence_hours double, grace_hours double, cadence_days int, expected_empty boolean"
PAYLOADS = "source_name string, collection_name string, dt string, fetched_ms long, file_name string, j string, http_status int, issues int"


def test_configured_checks(spark):
    stream = lambda c, reader, source="partition", field=None, empty=False: ("s", c, reader, c == "pages", source, field, 24.0, 2.0, 1, empty)
    config = spark.createDataFrame([stream("pages", "json", "payload", "score.start"), stream("table", "csv", "payload", "Day"), stream("lines", "txt"), stream("sparse", "json", empty=True), stream("bad", "json"), stream("rotten", "json"), stream("void", "json", "none")], CONFIG)
    row = lambda c, dt, ms, end, j, status=200, issues=0: ("s", c, dt, ms, f"f_{ms}.{end}", j, status, issues)
    payloads = spark.createDataFrame(
        [
            row("pages", "2026-01-05", 5, "json", '{"records":[{"id":1,"score":{"start":"2026-01-01T10:00:00Z"}},{"id":2,"score":{"start":"2026-01-04"}},{"score":null}]}'), row("pages", "2026-01-06", 6, "json", '{"records":[]}'), row("pages", "2026-01-07", 7, "json", "{cut"),
            row("table", "2026-01-05", 5, "csv", 'A,Day,dt\n"x, y",2026-01-01,1\n\n2,01/02/2026,3\n'), row("lines", "2026-01-01", 1, "txt", ""), row("lines", "2026-01-04", 4, "txt", "\n 1 20260101  x\n"),
            row("sparse", "2026-01-01", 1, "json", "[]"), row("bad", "2026-01-01", 1, "json", "[1]", 503), row("rotten", "2026-01-01", 1, "json", "[1]", 200, 1),
        ],
        PAYLOADS,
    )
    days = {(r["collection_name"], r["day"].isoformat()) for r in Q.event_dates(payloads, config).collect()}
    assert days == {("pages", "2026-01-01"), ("pages", "2026-01-04"), ("table", "2026-01-01"), ("table", "2026-01-02"), ("lines", "2026-01-01"), ("lines", "2026-01-04"), ("sparse", "2026-01-01"), ("bad", "2026-01-01"), ("rotten", "2026-01-01")}
    gaps = {r["collection_name"]: (r["passed"], r["missing"]) for r in Q.event_completeness(payloads, config).collect()}
    assert gaps["pages"] == (False, 2) and gaps["table"] == (True, 0) and gaps["lines"] == (False, 2)
    sigs = {r["collection_name"]: r["signature"] for r in Q.signatures(payloads, config).collect()}
    assert sigs == {"pages": ["id", "score"], "table": ["A", "Day"], "lines": ["fields=3"]}
    health = {r["collection_name"]: (r["state"], r["passed"], r["severity"]) for r in Q.content_health(payloads, config).collect()}
    assert health == {"pages": ("ERRORS", False, "WARN"), "table": ("DATA", True, "WARN"), "lines": ("EMPTY", False, "WARN"), "sparse": ("EXPECTED_EMPTY", True, "WARN"), "bad": ("ERRORS", False, "WARN"), "rotten": ("CORRUPT", False, "ERROR"), "void": ("NO_PAYLOADS", True, "WARN")}
    base = spark.createDataFrame([("s", "table", "csv", ["A", "Old"])], "source_name string, collection_name string, reader string, signature array<string>")
    ran = {r["check_name"]: (r["passed"], r["found"]) for r in Q.run_checks(payloads, config, base, 3_600_000 * 24).collect()}
    assert ran["s_table_csv_schema"] == (False, 2) and ran["s_pages_json_schema"] == (True, 0) and ran["s_lines_txt_completeness"] == (False, 2) and "s_void_json_completeness" not in ran and ran["s_rotten_json_content_health"][0] is False and ran["s_sparse_json_freshness"][0]
    only = config.withColumn("enabled_checks", F.array(F.lit("content")))
    assert Q.run_checks(payloads, only, base, 0).count() == 7 and Q.run_checks(payloads.limit(0), config, base, 0).count() > 0
    with pytest.raises(ValueError):
        Q.run_checks(payloads, config, base, 0, ("colour",))


def test_join_sanity_and_details(spark):
    nights = spark.createDataFrame([(D(2025, 12, 17), True, False), (D(2025, 12, 18), True, False), (D(2026, 1, 1), False, False)], "night_date date, has_garmin boolean, has_whoop boolean")
    assert tuple(one(Q.join_sanity(nights)))[1:] == (False, "WARN", 1, 1) and tuple(one(Q.join_sanity(nights.limit(0))))[1:] == (True, "WARN", 0, 0)
    assert [r["night_date"].day for r in Q.first_details(nights, ["night_date"], 2).collect()] == [17, 18]


def test_verifier(spark, tmp_path):
    root, report = str(tmp_path / "bronze"), str(tmp_path / "report")
    sinks.capture(root, "s", "c", b'{"a":1}', day="2026-01-01", meta={"content_type": "application/json"})
    kept = sinks.capture(root, "s", "c", b'{"a":2}', day="2026-01-04", meta={"content_type": "application/json", "redacted_fields": ["x"]})
    assert Q.verify_tree(files.captures(spark, root), report) == 0
    assert spark.read.json(f"{report}/gaps").collect()[0]["missing"] == 2 and spark.read.json(f"{report}/inventory").collect()[0]["files"] == 2
    kept.write_bytes(b"")
    assert Q.verify_tree(files.captures(spark, root), report, 2) == 1
    assert {r["issue"] for r in spark.read.json(f"{report}/findings").collect()} == {"ZERO_BYTES", "HASH_MISMATCH", "SIZE_MISMATCH"}


def test_trailing_count(spark):
    rows = [("a", T(2024, 1, 1, 23, 59, 30)), ("a", T(2024, 1, 2, 0, 0, 20)), ("a", T(2024, 1, 2, 0, 0, 30)), ("a", T(2024, 1, 2, 0, 0, 31)), (None, T(2024, 1, 2)), ("a", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    want = [1, 2, 3, 3, 1, 0]
    for size in (60, 3600, 86_400):
        assert {(r["k"], r["ts"]): r["n"] for r in R.trailing_count(df, ["k"], "ts", 60, bucket_seconds=size).collect()} == dict(zip(rows, want))


def test_catalog(spark):
    entries = [("sleep", "get_sleep", "daily"), ("weight", "get_weight", "range"), ("hill", "get_hill", "weekly"), ("badges", "get_badges", "static"), ("goals", "get_goals", "static_goals"), ("gear", "get_gear", "per_profile"), ("device", "get_device", "per_device"), ("solar", "get_solar", "per_device_range"), ("odd", "get_odd", "unknown")]
    cat = spark.createDataFrame([(n, m, k, n) for n, m, k in entries], "name string, method string, kind string, collection string")
    devices = spark.createDataFrame([(1,), (2,), (2,)], "device_id long")
    got = sorted((r["name"], *r["arguments"]) for r in catalog.calls(cat, ["2026-01-01", "2026-01-02"], devices, "p9").collect())
    assert got == sorted([("sleep", "2026-01-01"), ("sleep", "2026-01-02"), ("weight", "2026-01-01", "2026-01-02"), ("hill", "2026-01-02", "1"), ("badges",), *[("goals", x) for x in ("active", "past", "future")], ("gear", "p9"), ("device", "1"), ("device", "2"), ("solar", "1", "2026-01-01", "2026-01-02"), ("solar", "2", "2026-01-01", "2026-01-02")])
    assert {r["name"] for r in catalog.calls(cat, [], devices.limit(0), "p9").collect()} == {"badges", "goals", "gear"}
    methods = spark.createDataFrame([(m,) for m in ("get_sleep", "get_new", "download_activity", "set_goal", "login", "get_stats", "_get_x", "get_full_name")], "method string")
    assert {r["method"] for r in catalog.uncatalogued(methods, cat).collect()} == {"get_new", "download_activity"}
    assert catalog.forbidden(cat).count() == 0 and {r["method"] for r in catalog.forbidden(methods).collect()} == {"set_goal", "login", "get_full_name"}
    conf = {r["collection"]: (r["severity"], r["expected_empty"]) for r in catalog.check_config(cat, ["sleep"], ["sleep", "hill"]).collect()}
    assert conf["sleep"] == ("ERROR", False) and conf["hill"] == ("WARN", True) and conf["gear"] == ("WARN", False)
    allow = spark.createDataFrame([("sleep",), ("gear",)], "name string")
    deny = spark.createDataFrame([("gear",)], "name string")
    assert [r["name"] for r in Q.select_allowed(cat, "name", allow, deny).collect()] == ["sleep"] and Q.select_allowed(cat, "name", allow.limit(0), deny).count() == 8
    pages = spark.createDataFrame([("a", "t1"), ("a", "t1"), ("a", None), ("a", None), ("b", "t1")], "stream string, next_token string")
    assert [tuple(r) for r in catalog.stuck_cursors(pages, ["stream"]).collect()] == [("a", "t1", 2)]
    runs = spark.createDataFrame([("QUEUED",)] * 3 + [("DONE",)], "status string")
    assert tuple(one(catalog.queue_too_deep(runs, 2))) == (3, False) and one(catalog.queue_too_deep(runs))["passed"]
