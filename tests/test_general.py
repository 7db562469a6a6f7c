"""The general data problems: small cases with known results, and brute force."""

import datetime as dt
import json
import operator
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.plans import general
from pulselake.operators import drift, instants, intervals, message_index, outliers, rolling, shredding

US, UK = "en-US", "en-GB"


def norms(spark, rows, kind, zone=True):
    df = spark.createDataFrame([(i, t, loc, z) for i, (t, loc, z) in enumerate(rows)], "row_id long, t string, locale string, tz string").withColumn("day", F.lit("clash"))
    us = F.col("locale") == US
    if kind == "day":
        got = instants.normalise_days(df, "row_id", "t", "f", us, F.col("tz") if zone else None)
    else:
        got = instants.normalise_instants(df, "row_id", "t", "f", us, F.col("tz"))
    found = {r["row_id"]: r["norm"] for r in got.collect()}
    return [found.get(i) for i in range(len(rows))]


def test_days(spark):
    rows = [
        ("2024-02-30", US, None), ("2024-02-29", US, None), ("20240229", US, None), ("2024/2/9", US, None), ("2024-060", US, None), ("2023-366", US, None), ("3/4/2024", US, None), ("3/4/2024", UK, None), ("3/4/2024", None, None), ("04/01/21", UK, None), ("29.02.2024", "de-DE", None),
        ("31.06.", UK, None), ("Tue, 09 Aug 2022", UK, None), ("9 Aug 2022", UK, None), ("Aug 9, 2022", UK, None), ("2022-08-09T00:00:00.0", UK, None), ("2022-08-09T02:00:00Z", UK, "America/New_York"), ("1660010400000", UK, "America/New_York"), ("1660010400", UK, None), ("", UK, None), (None, UK, None), ("n/a", UK, None), ("2022-08-09T23:00:00-05:00", UK, "Europe/Berlin"), ("x" * 20000, UK, None),
    ]
    assert norms(spark, rows, "day") == [
        None, None, "2024-02-29", "2024-02-09", "2024-02-29", None, "2024-03-04", "2024-04-03", "2024-04-03", "2021-01-04", "2024-02-29",
        None, "2022-08-09", "2022-08-09", "2022-08-09", "2022-08-09", "2022-08-08", "2022-08-08", "2022-08-09", None, None, None, "2022-08-10", None,
    ]


def test_instants(spark):
    rows = [
        ("2022-03-17T06:34:21.689Z", US, None), ("1647839471565", US, None), ("1647085055", US, None), ("1651064307898759", US, None), ("1.647480838670E12", US, None), ("2022-04-19 04:51:00", US, None), ("2022-04-19 04:51:00", US, "America/New_York"), ("20220326T114246Z", US, "Asia/Kolkata"), ("04/26/2022 11:53 PM", US, None), ("25/03/2022 07:26:57", UK, None),
        ("Tue, 09 Aug 2022 06:43:28 -0730", UK, None), ("2022-07-07T07:32:10-04:00[America/New_York]", US, "Asia/Kolkata"), ("Apr 13, 2022 12:02:12 AM", US, None), ("29.3.2022 08:08", "de-DE", "Europe/Berlin"), ("2022-06-19 19:30:38 GMT", US, "Europe/Berlin"), ("2023-13-45T99:00:00Z", US, None), ("0000-00-00 00:00:00", US, None), ("NaT", US, None),
        ("2022-11-06 01:30:00", US, "America/New_York"), ("2022-03-13 02:30:00", US, "America/New_York"), ("2022-05-13T05:08", US, "Not/AZone"), ("2022-05-26T11:34:30.520999Z", US, None),
    ]
    assert norms(spark, rows, "instant") == [
        None, "2022-03-21T05:11:11.565Z", "2022-03-12T11:37:35.000Z", "2022-04-27T12:58:27.898Z", "2022-03-17T01:33:58.670Z", "2022-04-19T04:51:00.000Z", "2022-04-19T08:51:00.000Z", "2022-03-26T11:42:46.000Z", "2022-04-26T23:53:00.000Z", "2022-03-25T07:26:57.000Z",
        "2022-08-09T14:13:28.000Z", "2022-07-07T11:32:10.000Z", "2022-04-13T00:02:12.000Z", "2022-03-29T06:08:00.000Z", "2022-06-19T19:30:38.000Z", None, None, None,
        "2022-11-06T05:30:00.000Z", None, "2022-05-13T05:08:00.000Z", "2022-05-26T11:34:30.520Z",
    ]


def test_zone_history(spark):
    zones = spark.createDataFrame([("Europe/Berlin",), ("America/New_York",)], "zone string")
    rows = [(1, m, dt.datetime(2024, m, 5, h), z) for m, z in ((1, 1), (2, 1), (3, -5)) for h in range(24)]
    df = spark.createDataFrame([(e, m, t, (t + dt.timedelta(hours=z)).date()) for e, m, t, z in rows], "e long, m int, ts timestamp_ntz, day date")
    bad = F.to_date(F.convert_timezone(F.lit("UTC"), F.col("zone"), F.col("ts"))) != F.col("day")
    got = instants.estimate_zone_history(instants.count_zone_violations(df, "e", F.col("m"), zones, bad)).orderBy("period").collect()
    assert [r["zone"] for r in got] == ["Europe/Berlin", "Europe/Berlin", "America/New_York"] and all(r["bad"] == 0 for r in got)
    assert instants.best_history(np.array([[0.0, 1], [1, 0], [0, 1]]), 3.0) == [0, 0, 0]


def test_estimated_zones_against_the_stations(spark):
    """The estimate knows no station: it must still show the station's own offset for nearly all rows and logger-months."""
    d = "/root/testdata/sf0.1"
    loggers = general.weather_with_station(spark, d, "logger_no").where("__tz IS NOT NULL").groupBy("logger_no").agg(F.mode("__tz").alias("tz"))
    noon = F.make_timestamp_ntz(F.floor(F.col("month_no") / 12).cast("int") + 1970, F.col("month_no").cast("int") % 12 + 1, F.lit(15), F.lit(12), F.lit(0), F.lit(0))
    same = F.coalesce(F.convert_timezone(F.lit("UTC"), F.col("zone"), noon) == F.convert_timezone(F.lit("UTC"), F.col("tz"), noon), F.lit(False))
    r = general.p1_zone_history(spark, d).join(loggers, "logger_no").agg(F.avg(same.cast("int")).alias("months"), (F.sum(F.when(same, F.col("seen"))) / F.sum("seen")).alias("rows")).first()
    assert r["rows"] >= 0.99 and r["months"] >= 0.95, r


def test_shredding_to_any_depth(spark):
    """Four levels, two groups side by side, empty and missing parts: the flat tables against a plain walk."""
    L, R_ = shredding.Leaf, shredding.Repeated
    tree = R_("a", ("as",), (L("id", ("id",)),), (R_("b", ("bs",), (L("x", ("x",)),), (R_("c", ("cs",), (L("id", ("id",)),), (R_("d", ("ds",), (L("v", ("v",)),)),), key="id"),)), R_("e", ("es",), (L("id", ("id",)),), key="id")), key="id")
    rnd = random.Random(4)
    some = lambda make, p: [make() for _ in range(rnd.randrange(4))] if rnd.random() < p else rnd.choice([None, []])
    name = lambda: rnd.choice([None, *"pqrstuv"])
    c = lambda: {"id": name(), "ds": some(lambda: {"v": rnd.randrange(5)}, 0.8)}
    docs = [{"as": some(lambda: {"id": name(), "bs": some(lambda: {"x": rnd.randrange(3), "cs": some(c, 0.7)}, 0.8), "es": some(lambda: {"id": name()}, 0.6)}, 0.9)} for _ in range(60)]
    want = []

    def walk(payload, node, value, parent):
        for k, child in enumerate(value.get(node.places[0]) or []):
            key = child["id"] if node.key else str(k)
            if key is not None:
                want.append((payload, node.name, parent, k, key))
                for g in node.groups:
                    walk(payload, g, child, key)

    for i, doc in enumerate(docs):
        walk(i, tree, doc, str(i))
    df = spark.createDataFrame([(i, "t", json.dumps(d)) for i, d in enumerate(docs)], "payload_id long, collection_name string, body string")
    got = [tuple(r)[:5] for r in shredding.flat_rows(df, {"t": tree}).collect()]
    assert sorted(got) == sorted(want) and {g[1] for g in got} == set("abcde")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-5, 9), min_size=1, max_size=40), st.integers(1, 9), st.sampled_from(["sum", "max", "min"]))
def test_two_stack_queue(values, window, how):
    got = rolling.trailing(np.array(values, float), window, 0, how).tolist()
    queue, seen = rolling.TwoStackQueue({"sum": operator.add, "max": max, "min": min}[how], rolling.COMBINERS[how][1]), []
    for i, v in enumerate(values):
        queue.push(v)
        if i >= window:
            queue.pop()
        seen.append(queue.total())
    assert seen == got
    fold = {"sum": sum, "max": max, "min": min}[how]
    assert got == [fold(values[max(0, i - window + 1) : i + 1]) for i in range(len(values))]


def test_rolling_totals(spark):
    day = lambda s: dt.date.fromisoformat(s)
    rows = [(1, 1, day("2024-01-30"), 10, 1), (2, 1, day("2024-02-02"), 5, 1), (3, 1, day("2024-02-02"), 7, 2), (4, 1, day("2024-05-01"), None, 1), (5, None, day("2024-05-01"), 9, 1), (6, 2, None, 9, 1)]
    df = spark.createDataFrame(rows, "row_id long, w long, day date, steps int, built int").withColumn("month", F.lit("clash"))
    out = rolling.rolling_totals(df, "w", "day", ["steps"], [7], [F.col("built"), F.col("row_id")]).orderBy("day").collect()
    assert len(out) == 93 and {r["entity"] for r in out} == {1}
    by = {r["day"]: r for r in out}
    assert by[day("2024-02-02")]["steps_7_total"] == 17 and by[day("2024-02-02")]["steps_7_avg"] == 17 / 4
    assert by[day("2024-02-06")]["steps_7_total"] == 7 and by[day("2024-03-15")]["steps_7_total"] == 0
    best = rolling.greatest_days(rolling.rolling_totals(df, "w", "day", ["steps"], [7], [F.col("built"), F.col("row_id")]), ["steps"], [7]).collect()
    assert {(r["day"].isoformat(), r["total"]) for r in best} == {("2024-01-30", 10.0), ("2024-01-31", 10.0)} | {(f"2024-02-0{k}", 17.0) for k in (2, 3, 4, 5)}
    assert rolling.rolling_totals(df.limit(0), "w", "day", ["steps"], [7], [F.col("built")]).count() == 0


def brute_periods(rows):
    out = []
    for e in sorted({r[0] for r in rows if r[0] is not None}):
        now = None
        found = []
        for _, b, f, k in sorted((r for r in rows if r[0] == e and r[1] is not None and r[2] is not None and r[2] > r[1]), key=lambda r: r[1:3]):
            if now and b <= now[1]:
                now[1], now[2] = max(now[1], f), now[2] and bool(k)
            else:
                now = [b, f, bool(k)]
                found.append(now)
        out += [(e, "nap" if k else "sleep", b, f) for b, f, k in found]
        out += [(e, "gap", x[1], y[0]) for x, y in zip(found, found[1:])]
    return sorted(out)


def test_intervals(spark):
    rnd, b = random.Random(5), intervals.BUCKET_MS
    rows = [(1, b - 10, b, True), (1, b, b + 5, True), (1, b + 5, 3 * b + 1, None), (2, 5, 4, True), (2, None, 9, True), (None, 1, 2, True), (3, 7, 9, True), (3, 7, 9, True)]
    for _ in range(400):
        s = rnd.randrange(0, 6 * b)
        rows.append((rnd.choice([4, 4, 4, 5]), s, s + rnd.choice([b // 50, b // 9, 2 * b]) * rnd.randrange(1, 3) // rnd.choice([1, 90]), rnd.random() < 0.6))
    df = spark.createDataFrame(rows, "entity long, begin_ms long, finish_ms long, is_kind boolean").repartition(5)
    got = sorted(tuple(r) for r in intervals.periods_and_gaps(df, "nap", "sleep").collect())
    assert got == brute_periods(rows)
    assert intervals.periods_and_gaps(df.limit(0), "nap", "sleep").count() == 0


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_message_index(spark, batches):
    rnd = random.Random(batches)
    rows = [(i, rnd.choice(["hot"] * 3 + [f"id{rnd.randrange(40)}"] * 5 + [None]), rnd.choice([rnd.randrange(50), None]), rnd.randrange(90)) for i in range(700)]
    df = spark.createDataFrame(rows, "row_id long, ident string, fetched_ms long, batch_id long").repartition(6)
    named = df.select("row_id", "fetched_ms", "batch_id", *message_index.identity_hashes(F.col("ident")))
    got = sorted(r["row_id"] for r in message_index.surplus_deliveries(named, "t", "batch_id", batches=batches, ids_per_prefix=5).collect())
    best = {}
    for i, k, f, _ in rows:
        if k is not None:
            rank = (f if f is not None else -(2**62), -i)
            if k not in best or rank > best[k][0]:
                best[k] = (rank, i)
    keep = {i for _, i in best.values()}
    assert got == sorted(i for i, k, _, _ in rows if k is not None and i not in keep)
    assert message_index.surplus_deliveries(named.limit(0), "e", "batch_id", batches=batches).count() == 0


def test_binary_search_with_equal_first_halves():
    h1, h2 = np.array([1, 1, 1, 5]), np.array([3, 7, 9, 2])
    assert message_index.search(h1, h2, np.array([1, 1, 5, 4]), np.array([9, 8, 2, 1])).tolist() == [2, -1, 3, -1]


def test_levels_rebuild_tables():
    s = shredding.Shredder(shredding.SLEEP_PAGE)
    pages = [{"records": [{"id": "a", "score": {"stage_summary": {"segments": [{"stage": "x"}, {"stage": None}]}}}, {"id": "b"}]}, {"records": []}, [{"id": "c", "score": {"stage_summary": {"segments": {"stage": "y"}}}}]]
    for p in pages:
        s.add(p)
    top, low = shredding.assemble(s.columns, ("sleep",)), shredding.assemble(s.columns, ("sleep", "segment"))
    assert top["id"].tolist() == ["a", "b", "c"] and top["record"].tolist() == [0, 0, 2] and top["position"].tolist() == [0, 1, 0]
    assert low["stage"].tolist() == ["x", None, "y"] and [top["id"][p] for p in low["parent"]] == ["a", "a", "c"] and low["position"].tolist() == [0, 1, 0]


def test_links(spark):
    page = {"data": {"records": {"id": "s1", "score": {"performance": {"percentage": 5}, "stage_summary": {"segments": [{"stage": "a"}, {"stage": "b"}]}}}}}
    status = {"mostRecentTrainingStatus": {"latestTrainingStatusData": {"7": {"trainingStatus": 0, "loadDays": {"calendarDate": "2024-01-01", "load": 1}}, "8": {"trainingStatus": None, "acuteTrainingLoadDTO": None}}}}
    lone = {"mostRecentTrainingStatus": {"latestTrainingStatusData": {"deviceId": 9, "trainingStatus": "2"}}}
    bodies = [("sleep", json.dumps(json.dumps(page))), ("sleep", '{"records":[{"id":"x"'), ("sleep", None), ("sleep", '{"records":[{"id":null,"score":{"sleep_performance_percentage":1}}]}'), ("training_status", json.dumps(status)), ("training_status", json.dumps(lone)), ("other", "{}"), ("sleep", "")]
    df = spark.createDataFrame([(i, c, b, "k") for i, (c, b) in enumerate(bodies)], "payload_id long, collection_name string, body string, row_key string")
    got = sorted(tuple(r) for r in shredding.links(df).collect())
    assert got == sorted([(0, "sleep", "0", "s1"), (0, "scored_sleep", "0", "s1"), (0, "segment", "s1", "0"), (0, "segment", "s1", "1"), (4, "device", "4", "7"), (4, "device", "4", "8"), (4, "coded_device", "4", "7"), (4, "load_day", "7", "2024-01-01"), (5, "device", "5", "9"), (5, "coded_device", "5", "9")])


def files_of(bodies):
    return [(i, 1, 100 + i * drift.CHUNK_MS // 2, n, None, b) for i, (n, b) in enumerate(bodies)]


def test_schema_changes(spark):
    nd = lambda *rows: "\n".join(json.dumps(r) for r in rows)
    d = [f"2024-01-0{k}" for k in range(1, 8)]
    bodies = [
        ("a.json", nd(*[{"calendarDate": x, "score": 50 + i, "rhr": 40, "flag": None} for i, x in enumerate(d[:4])])),
        ("b.json", nd(*[{"calendarDate": x, "points": 50 + i, "rhr": 40, "flag": None} for i, x in enumerate(d) if 1 < i < 6])),
        ("c.csv", "calendarDate;points;rhr;flag\n" + "\n".join(f"{x};{50 + i}.5;;true" for i, x in enumerate(d) if i > 3)),
        ("d.txt", "# calendarDate  points  rhr  flag\n2024-01-06 55.5 - -\n2024-01-07 56.5 61.5 7"),
    ]
    df = spark.createDataFrame(files_of(bodies), "file_id long, feed_id long, fetched_ms long, file_name string, reader string, body string")
    got = sorted(tuple(r)[1:] for r in drift.schema_changes(df).collect())
    assert got == sorted([(1, "renamed", "score", "points"), (2, "reader", "json", "csv"), (2, "retyped", "points", "points"), (3, "reader", "csv", "txt"), (3, "retyped", "rhr", "rhr"), (3, "retyped", "flag", "flag")])
    assert drift.schema_changes(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, 1, None, None, None, None), (2, 1, 5, "x.json", None, "{oops"), (3, None, 5, "x.json", None, "[]")], df.schema)
    assert drift.schema_changes(odd).count() == 0


FILES = "file_id long, feed_id long, fetched_ms long, file_name string, reader string, body string"


def nights_of(**f):
    return "\n".join(json.dumps({"calendarDate": f"2024-01-0{k + 1}"} | {n: v[k] for n, v in f.items()}) for k in range(3))


def test_files_are_routed_by_their_feeds_version(spark):
    rows = [
        (1, 1, 1, "a.json", None, nights_of(score=[1, 2, 3], void=[None] * 3)), (2, 1, 2, "b.json", None, nights_of(points=[1, 2, 3])), (3, 1, 3, "c.json", None, nights_of(points=[1.5, 2.5, 3.5], rhr=[60, 61, 62])),
        (4, 2, 1, "d.json", None, nights_of(score=[7, 8, 9], points=[4, 5, 6])),  # both names side by side: two fields
        (5, 3, 1, "e.json", None, nights_of(rhr=[70, 71, 72])), (6, 3, 2, "f.json", None, nights_of(pulse=[70, 71, 72])), (7, 4, 1, "g.json", None, nights_of(pulse=[80, 81, 82])),
    ]
    got = drift.routed_table(spark.createDataFrame(rows, FILES)).collect()
    at = {(r["file_id"], r["night"][-1]): r for r in got}
    assert len(got) == 7 * 3 and set(got[0].asDict()) == {"feed_id", "file_id", "version", "fingerprint", "night", "score", "points", "pulse", "void", "uncast"}
    assert [at[i, "1"]["points"] for i in (1, 2, 3, 4)] == [1.0, 1.0, 1.5, 4.0] and at[4, "1"]["score"] == 7 and at[1, "1"]["score"] is None
    assert [at[i, "2"]["pulse"] for i in (2, 3, 5, 6, 7)] == [None, 61, 71, 71, 81] and at[1, "1"]["void"] is None
    assert [at[i, "1"]["version"] for i in range(1, 8)] == [0, 1, 2, 0, 0, 1, 0] and len({r["fingerprint"] for r in got}) == 6
    assert at[6, "1"]["fingerprint"] == at[7, "1"]["fingerprint"]


def test_values_are_cast_to_one_declared_type(spark):
    rows = [
        (1, 1, 1, "a.json", None, nights_of(score=[50, 51, 52], ok=[True, False, True], note=["a", "b", "c"])),
        (2, 1, 2, "b.json", None, nights_of(score=["50", "51", "odd"], ok=[1, 0, 7], note=[1, 2, {"value": 3}])),
        (3, 1, 3, "c.json", None, nights_of(score=[{"value": 60, "unit": "u"}, {"value": 61}, {"other": 1}], ok=[True, True, False], note=["x", None, "z"])),
        (4, 1, 4, "d.csv", None, "calendarDate,score,ok\n2024-01-01,50/u,true\n2024-01-02,51.25,false\n2024-01-03,,true\n"),
        (5, 1, 5, "e.json", None, nights_of(score=[1, 2, 3])), (6, 1, 6, "f.json", None, nights_of(score=[1, 2, 3])),
        (7, None, 1, "g.json", None, "[]"), (8, 2, 1, "h.json", None, "{oops"), (9, 2, 2, None, None, None),
    ]
    table = drift.routed_table(spark.createDataFrame(rows, FILES))
    assert dict(table.dtypes) | {"score": "bigint", "ok": "boolean", "note": "string"} == dict(table.dtypes)
    got = {(r["file_id"], r["night"][-1]): (r["score"], r["ok"], r["note"], r["uncast"]) for r in table.collect()}
    assert len(got) == 6 * 3
    assert got[2, "1"] == (50, True, "1.0", 0) and got[2, "3"] == (None, None, '{"value": 3}', 2)
    assert got[3, "1"] == (60, True, "x", 0) and got[3, "3"] == (None, False, "z", 1)
    assert got[4, "1"] == (50, True, None, 0) and got[4, "2"] == (None, False, None, 1)  # 51.25 is text here, as 50/u stands beside it, and no whole number
    assert drift.routed_table(spark.createDataFrame([], FILES)).columns == ["feed_id", "file_id", "version", "fingerprint", "night", "uncast"]


def test_chunking_of_feeds_changes_nothing(spark):
    files = spark.read.parquet("/root/testdata/sf0.001/capture_files.parquet")
    made, known = [], {}
    rows = sorted(files.collect(), key=lambda r: (r["feed_id"], r["fetched_ms"], r["file_id"]))
    before = None
    for r in rows:
        s = drift.summarise(r["file_name"], r["reader"], r["body"])
        if before and before[0] == r["feed_id"]:
            changes, known = drift.steps(before[1], s, known)
            made += [(r["feed_id"], r["file_id"], *c) for c in changes]
        else:
            known = {n: k for n, k in s.fields.items() if k}
        before = (r["feed_id"], s)
    assert sorted(tuple(r) for r in drift.schema_changes(files).collect()) == sorted(made)


LIM = {"t": outliers.Limits(-75.0, 85.0, excursions=True), "r": outliers.Limits(0.0, 1500.0, fence=(0.2, 0.15), idle=0.0)}


def test_false_readings(spark):
    rnd, n = random.Random(1), 24 * 40
    temp = [15 + 8 * np.sin(h / 24 * 6.28) + rnd.uniform(-0.5, 0.5) for h in range(n)]
    rad = [max(0.0, round(700 * np.sin((h % 24 - 6) / 12 * 3.14) * rnd.uniform(0.5, 1))) if 6 < h % 24 < 18 else 0.0 for h in range(n)]
    want = set()
    for at, size in ((100, 1), (300, 3), (n - 200, 2)):
        for k in range(size):
            temp[at + k] += 35
            want.add((at + k, "t"))
    temp[500], rad[400] = -9999.0, 65535.0
    want |= {(500, "t"), (400, "r")}
    for k in range(600, 640):
        temp[k] = 21.5
        want.add((k, "t"))
    rad[24 * 30 + 2] = 600.0
    want.add((24 * 30 + 2, "r"))
    for k in range(760, 900):  # weather that changes and stays
        temp[k] += 12
    base = 24 * 19_000
    rows = [(h, 1, base + h, float(temp[h]), float(rad[h])) for h in range(n) if h not in (50, 51, 52)] + [(5000, 1, base + 500, -9999.0, 3.0), (6000, None, base, 300.0, -1.0), (6001, 1, None, None, -1.0), (6002, 2, base, None, None)]
    want |= {(5000, "t"), (6000, "t"), (6000, "r"), (6001, "r")}
    df = spark.createDataFrame(rows, "row_id long, source long, hour long, t double, r double").repartition(3)
    got = {tuple(r) for r in outliers.find_false_readings(df, LIM).collect()}
    assert got == want
    assert outliers.find_false_readings(df.limit(0), LIM).count() == 0
    scaled = df.withColumns({"t": F.col("t") * 9 / 5 + 32, "r": F.col("r") * 3})  # limits go with the source, not with a unit
    other = {"t": outliers.Limits(-103.0, 185.0, excursions=True), "r": outliers.Limits(0.0, 4500.0, fence=(0.2, 0.15), idle=0.0)}
    assert {tuple(r) for r in outliers.find_false_readings(scaled, other).collect()} == want


def test_a_sensor_stuck_for_months(spark):
    rows = [(h, 7, 24 * 19_000 + h, 20.0 + (h * 7) % 11 if h < 1000 or h >= 5000 else 4.5, 0.0) for h in range(6000)]
    df = spark.createDataFrame(rows, "row_id long, source long, hour long, t double, r double")
    assert {r["row_id"] for r in outliers.find_false_readings(df, LIM).collect()} == set(range(1000, 5000))


def test_coarse_resolution_is_no_standstill():
    v = np.repeat(np.arange(60) % 7 * 0.005, 7)
    assert not outliers.standstills(v, None, True).any()
    stuck = np.concatenate((v, np.full(60, 0.9), v))
    assert outliers.standstills(stuck, None, True).sum() == 60
    assert outliers.standstills(np.full(900, 0.3), None, True).all() and not outliers.standstills(np.full(900, 0.3), None, False).any()
