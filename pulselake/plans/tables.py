"""The silver and gold tables, run on payloads made of the given tables' rows, each with SQL for the same rows.

The given tables have no raw captures of most collections. Their rows are
rendered as such captures (JSON, CSV values, fixed-column lines), so a table's
whole path from text to typed, deduplicated record is checked on all rows and
all columns. A table's columns are declared once as ``(column, JSON path,
expression, kind)``: the expression makes both the JSON value and the SQL one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import millis_of_ntz
from ..marts import gold
from ..tables import silver
from .general import LOCAL_DAY_SQL, table, weather_days

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
PAGE = 400  # records of a rendered page

INT, LONG, REAL, TEXT, BOOL, MINUTES, MILLI_MINUTES, KILO, TIME, INSTANT, EPOCH, DAY = "int", "long", "real", "text", "bool", "minutes", "milli minutes", "kilo", "time", "instant", "epoch", "day"
Spec = list[tuple[str, str, str, str]]


def query(sql: str) -> Callable:
    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


def sql_columns(spec: Spec) -> str:
    """The columns of a spec as SQL, typed as the table types them."""
    made = {
        INT: "CAST({e} AS INTEGER)", LONG: "CAST({e} AS BIGINT)", REAL: "CAST({e} AS DOUBLE)", TEXT: "CAST({e} AS VARCHAR)", BOOL: "coalesce({e}, false)", MINUTES: "CAST({e} AS DOUBLE) / 60.0::DOUBLE", MILLI_MINUTES: "CAST({e} AS DOUBLE) / 60000.0::DOUBLE",
        KILO: "CAST({e} AS DOUBLE) / 1000.0::DOUBLE", TIME: "date_trunc('second', {e})", INSTANT: "date_trunc('millisecond', {e})", EPOCH: "date_trunc('millisecond', {e})", DAY: "CAST({e} AS DATE)",
    }
    return ", ".join(f"{made[kind].format(e=f'({e})')} AS {name}" for name, _, e, kind in spec)


def rendered(spec: Spec, **more: Column) -> Column:
    """A JSON object of a spec's values at their paths."""
    tree: dict = {}
    for _, path, e, kind in spec:
        c = F.expr(e)
        c = {TIME: lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"), INSTANT: iso, EPOCH: millis_of_ntz, DAY: lambda c: F.date_format(c, "yyyy-MM-dd"), REAL: lambda c: c.cast("double")}.get(kind, lambda c: c)(c)
        *up, leaf = path.split(".")
        at = tree
        for k in up:
            at = at.setdefault(k, {})
        at[leaf] = c
    tree |= more

    def st(x: dict) -> Column:
        return F.struct(*[(st(v) if isinstance(v, dict) else v).alias(k) for k, v in x.items()])

    return st(tree)


def captured(df: DataFrame, body: Column, ms: Column, day: Column | None = None) -> DataFrame:
    """``(filename, j)`` as captures of a collection would be named."""
    name = F.concat(F.lit("/bronze/s/c/dt="), F.lit("2026-01-01") if day is None else day.cast("string"), F.lit("/c_"), F.lpad(ms.cast("string"), 13, "0"), F.lit("_ab.json"))
    return df.select(name.alias("filename"), body.alias("j"))


def pages(df: DataFrame, number: str, record: Column, ms: Column, key: str | None = "records") -> DataFrame:
    """Records as pages of ``PAGE`` rows by a running number: as many pages as the rows need."""
    made = df.groupBy(F.floor(F.col(number) / PAGE).alias("__page")).agg(F.collect_list(record).alias("r"), F.max(ms).alias("__ms"))
    return captured(made, F.to_json(F.struct(F.col("r").alias(key))) if key else F.to_json("r"), F.col("__ms"))


def iso(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def every(n: int, value: str, key: str) -> str:
    """The value but for each ``n``-th key, where it is missing."""
    return f"CASE WHEN {key} % {n} <> 0 THEN {value} END"


NIGHT = "o_orderdate + INTERVAL 9496 DAY"  # the days of the orders, moved to those of the sleeps
_NEWEST_ORDER = f"SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY CAST({NIGHT} AS DATE) ORDER BY o_orderkey DESC) = 1"

_DTO = "dailySleepDTO"
SLEEP_GARMIN: Spec = [
    ("night_date", f"{_DTO}.calendarDate", NIGHT, DAY),
    ("garmin_sleep_score", f"{_DTO}.sleepScores.overall.value", every(9, "o_custkey % 100", "o_orderkey"), INT),
    *[(f"garmin_{n}_min", f"{_DTO}.{k}Seconds", every(7 + i, f"o_orderkey % {5000 + i}", "o_custkey"), MINUTES) for i, (n, k) in enumerate({"total": "sleepTime", "deep": "deepSleep", "light": "lightSleep", "rem": "remSleep", "awake": "awakeSleep"}.items())],
    ("garmin_avg_stress", f"{_DTO}.avgSleepStress", "o_totalprice / 4096", REAL),
    ("garmin_resp_avg", f"{_DTO}.averageRespirationValue", every(5, "o_totalprice / 8192", "o_orderkey"), REAL),
    ("garmin_spo2_avg", f"{_DTO}.averageSpO2Value", "o_custkey % 30 + 70", REAL),
    ("garmin_rhr", "restingHeartRate", "40 + o_custkey % 30", INT),
    ("garmin_start_gmt", f"{_DTO}.sleepStartTimestampGMT", NIGHT, TIME),
    ("garmin_end_gmt", f"{_DTO}.sleepEndTimestampGMT", f"{NIGHT} + INTERVAL 7 HOUR", EPOCH),
]


@query(f"SELECT {sql_columns(SLEEP_GARMIN)} FROM ({_NEWEST_ORDER})")
def table_sleep_garmin(s: SparkSession, d: str) -> DataFrame:
    return silver.sleep_garmin(captured(table(s, d, "orders"), F.to_json(rendered(SLEEP_GARMIN)), F.col("o_orderkey")))


_STAGE = "score.stage_summary."
SLEEP_WHOOP: Spec = [
    ("whoop_sleep_id", "id", "whoop_sleep_id", TEXT),
    ("is_nap", "nap", "is_nap", BOOL),
    *[(f"whoop_{k}_pct", f"score.sleep_{k}_percentage", f"whoop_{k}_pct", REAL) for k in ("performance", "efficiency", "consistency")],
    ("whoop_resp_rate", "score.respiratory_rate", "whoop_resp_rate", REAL),
    *[(f"whoop_{n}_min", f"{_STAGE}total_{k}_time_milli", f"CAST(round(whoop_{n}_min * 60000) AS BIGINT)", MILLI_MINUTES) for n, k in (("deep", "slow_wave_sleep"), ("rem", "rem_sleep"), ("light", "light_sleep"), ("awake", "awake"))],
    ("whoop_disturbances", f"{_STAGE}disturbance_count", "whoop_disturbances", INT),
    ("whoop_cycle_id", "cycle_id", "whoop_cycle_id", LONG),
    ("whoop_start", "start", "whoop_start", INSTANT),
    ("whoop_end", "end", "whoop_end", INSTANT),
]
_SLEEP = f"SELECT CAST(whoop_end - INTERVAL 270 MINUTE AS DATE) AS night_date, {sql_columns(SLEEP_WHOOP)} FROM silver_sleep_whoop WHERE whoop_end IS NOT NULL AND whoop_sleep_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY whoop_sleep_id ORDER BY updated_at || '#' || lpad(row_id::VARCHAR, 12, '0') DESC) = 1"


@query(_SLEEP)
def table_sleep_whoop(s: SparkSession, d: str) -> DataFrame:
    rec = rendered(SLEEP_WHOOP, updated_at=F.concat("updated_at", F.lit("#"), F.lpad(F.col("row_id").cast("string"), 12, "0")), timezone_offset=F.lit("-04:30"))
    return silver.sleep_whoop(pages(table(s, d, "silver_sleep_whoop"), "row_id", rec, F.col("fetched_ms")))


_G = ", ".join(n for n, *_ in SLEEP_GARMIN[1:])
_W = ", ".join(n for n, *_ in SLEEP_WHOOP[2:])


@query(f"""WITH n AS (SELECT * FROM ({_SLEEP}) WHERE NOT is_nap QUALIFY row_number() OVER (PARTITION BY night_date ORDER BY whoop_start DESC NULLS LAST, whoop_sleep_id DESC) = 1), g AS (SELECT {sql_columns(SLEEP_GARMIN)} FROM ({_NEWEST_ORDER}))
SELECT coalesce(g.night_date, n.night_date) AS night_date, {_G}, {_W}, g.night_date IS NOT NULL AS has_garmin, n.night_date IS NOT NULL AS has_whoop FROM g FULL OUTER JOIN n ON g.night_date = n.night_date""")
def table_sleep_unified(s: SparkSession, d: str) -> DataFrame:
    return silver.sleep_unified(table_sleep_garmin(s, d), table_sleep_whoop(s, d))


_SHIFT = "CASE WHEN event_id % 2 = 0 THEN -240 ELSE 330 END"


@query(f"""WITH e AS (SELECT date_trunc('minute', ts) AS reading_ts_utc, date_trunc('minute', ts + to_minutes({_SHIFT})) AS reading_ts_local, CAST({_SHIFT} AS INTEGER) AS tz_offset_minutes, CAST(round(value) AS INTEGER) AS mgdl, event_id FROM events)
SELECT reading_ts_utc, reading_ts_local, CAST(reading_ts_local AS DATE) AS reading_date, tz_offset_minutes, mgdl FROM e QUALIFY row_number() OVER (PARTITION BY reading_ts_utc ORDER BY event_id DESC) = 1""")
def table_glucose(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    shift = F.when(F.col("event_id") % 2 == 0, -240).otherwise(330)
    local = F.date_format(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), shift), "yyyy-MM-dd'T'HH:mm")
    rows = e.select(F.concat(local, F.when(shift < 0, "-04:00").otherwise("+05:30")).alias("ts"), F.col("value").cast("string").alias("mgdl"), F.concat(F.lit("g_"), F.lpad(F.col("event_id").cast("string"), 13, "0"), F.lit("_x.csv")).alias("filename"))
    return silver.glucose(rows)


_MADE = "TIMESTAMP '2021-03-01 23:30:00' + CAST(c_custkey % 900 AS INTEGER) * INTERVAL 1 DAY"
RECOVERY: Spec = [
    ("cycle_id", "cycle_id", "c_custkey", LONG),
    ("sleep_id", "sleep_id", every(6, "c_name", "c_custkey"), TEXT),
    ("recovery_date", "created_at", _MADE, DAY),
    ("created_at", "created_at", _MADE, INSTANT),
    *[(k, f"score.{k}", f"CASE WHEN c_custkey % {n} <> 0 THEN c_custkey % {m} END", REAL) for k, n, m in (("recovery_score", 13, 101), ("resting_heart_rate", 11, 90), ("hrv_rmssd_milli", 7, 210), ("spo2_percentage", 5, 100), ("skin_temp_celsius", 3, 40))],
    ("user_calibrating", "score.user_calibrating", "CASE WHEN c_custkey % 3 = 0 THEN true END", BOOL),
]


@query(f"SELECT {sql_columns(RECOVERY)} FROM customer")
def table_recovery(s: SparkSession, d: str) -> DataFrame:
    """Every cycle comes twice; the second, corrected delivery holds."""
    c = table(s, d, "customer")
    rec = lambda k, spec: rendered(spec, updated_at=F.lit(f"2025-12-0{k}"))
    first = pages(c, "c_custkey", rec(1, [(n, p, "CAST(-1 AS DOUBLE)" if kind == REAL else e, kind) for n, p, e, kind in RECOVERY]), F.lit(1))
    return silver.recovery(first.unionByName(pages(c, "c_custkey", rec(2, RECOVERY), F.lit(2))))


STRAIN: Spec = [
    ("cycle_id", "id", "o_orderkey", LONG),
    ("start_ts", "start", NIGHT, INSTANT),
    ("end_ts", "end", f"CASE WHEN o_orderkey % 17 <> 0 THEN {NIGHT} + INTERVAL 20 HOUR END", INSTANT),
    ("day_strain", "score.strain", "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 32768 END", REAL),
    ("kilojoules", "score.kilojoule", every(5, "o_custkey % 20000", "o_orderkey"), REAL),
    ("avg_heart_rate", "score.average_heart_rate", every(4, "60 + o_custkey % 70", "o_orderkey"), INT),
    ("max_heart_rate", "score.max_heart_rate", "100 + o_custkey % 90", INT),
    ("score_state", "score_state", "o_orderstatus", TEXT),
]


@query(f"SELECT CAST({NIGHT} - INTERVAL 5 HOUR AS DATE) AS strain_date, {sql_columns(STRAIN)} FROM orders")
def table_strain(s: SparkSession, d: str) -> DataFrame:
    return silver.strain(pages(table(s, d, "orders"), "o_orderkey", rendered(STRAIN, timezone_offset=F.lit("-05:00"), updated_at=F.lit("1")), F.lit(1)))


WORKOUTS: Spec = [
    ("activity_id", "activityId", "o_orderkey", LONG),
    ("activity_name", "activityName", every(8, "o_orderpriority || ' run'", "o_orderkey"), TEXT),
    ("activity_type", "activityType.typeKey", "o_orderpriority", TEXT),
    ("activity_date", "startTimeLocal", NIGHT, DAY),
    ("start_time_local", "startTimeLocal", NIGHT, TIME),
    ("start_time_gmt", "startTimeGMT", f"{NIGHT} + INTERVAL 4 HOUR", TIME),
    *[(n, k, every(9 + i, f"o_orderkey % {4000 + i} + 0.25", "o_custkey"), REAL) for i, (n, k) in enumerate({"duration_sec": "duration", "moving_duration_sec": "movingDuration", "elapsed_duration_sec": "elapsedDuration", "distance_m": "distance", "calories": "calories"}.items())],
    ("avg_hr", "averageHR", every(7, "o_custkey % 200", "o_orderkey"), INT),
    ("max_hr", "maxHR", "o_custkey % 220", INT),
    *[(f"hr_z{z}_sec", f"hrTimeInZone_{z}", every(3 + z, f"o_custkey % {600 + z}", "o_orderkey"), REAL) for z in range(1, 6)],
    ("device_id", "deviceId", "o_custkey + 3000000000", LONG),
]


@query(f"SELECT {sql_columns(WORKOUTS)} FROM orders")
def table_workouts(s: SparkSession, d: str) -> DataFrame:
    w = [x for x in WORKOUTS if x[0] != "activity_date"]  # the day is read from the start
    return silver.workouts(pages(table(s, d, "orders"), "o_orderkey", rendered(w), F.lit(1), key=None))


SPLITS: Spec = [
    ("lap_index", "lapIndex", "l_linenumber", INT),
    ("lap_start_gmt", "startTimeGMT", "l_shipdate", TIME),
    *[(n, k, every(5 + i, f"l_extendedprice / {2**i}", "l_partkey"), REAL) for i, (n, k) in enumerate({"duration_sec": "duration", "moving_duration_sec": "movingDuration", "distance_m": "distance", "avg_speed_mps": "averageSpeed", "max_speed_mps": "maxSpeed"}.items())],
    ("avg_hr", "averageHR", "l_suppkey % 200", INT),
    ("max_hr", "maxHR", every(4, "l_partkey % 220", "l_suppkey"), INT),
    *[(n, k, every(6 + i, f"l_quantity / {2**i}", "l_suppkey"), REAL) for i, (n, k) in enumerate({"calories": "calories", "elevation_gain_m": "elevationGain", "elevation_loss_m": "elevationLoss"}.items())],
]
_LAPS = ["l_orderkey", "l_linenumber"]
_LAP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(f"SELECT l_orderkey AS activity_id, {sql_columns(SPLITS)} FROM lineitem QUALIFY row_number() OVER (PARTITION BY {', '.join(_LAPS)} ORDER BY {', '.join(c + ' DESC' for c in _LAP_ORDER)}) = 1")
def table_workout_splits(s: SparkSession, d: str) -> DataFrame:
    """Every activity comes twice; laps of the same number in one activity keep the greatest."""
    one = silver.dedup_latest(table(s, d, "lineitem").select(*_LAPS, *_LAP_ORDER), _LAPS, _LAP_ORDER)
    laps = one.groupBy("l_orderkey").agg(F.collect_list(rendered(SPLITS)).alias("laps"))
    twice = laps.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return silver.workout_splits(captured(twice, F.to_json(F.struct(F.col("l_orderkey").alias("activityId"), F.col("laps").alias("lapDTOs"))), F.col("k")))


WHOOP_WORKOUTS: Spec = [
    ("workout_id", "id", "event_type || event_id", TEXT),
    ("sport_name", "sport_name", "event_type", TEXT),
    ("sport_id", "sport_id", every(10, "event_id % 100", "event_id"), INT),
    ("start_ts", "start", "ts", INSTANT),
    ("end_ts", "end", "ts + INTERVAL 1 HOUR", INSTANT),
    ("strain", "score.strain", "value / 8", REAL),
    ("avg_heart_rate", "score.average_heart_rate", "event_id % 200", INT),
    ("max_heart_rate", "score.max_heart_rate", every(4, "event_id % 220", "event_id"), INT),
    *[(n, f"score.{k}", every(3 + i, f"value * {2**i}", "event_id"), REAL) for i, (n, k) in enumerate({"kilojoules": "kilojoule", "distance_m": "distance_meter", "altitude_gain_m": "altitude_gain_meter", "percent_recorded": "percent_recorded"}.items())],
    ("score_state", "score_state", "event_type", TEXT),
]


@query(f"SELECT CAST(ts + INTERVAL 2 HOUR AS DATE) AS workout_date, {sql_columns(WHOOP_WORKOUTS)} FROM events")
def table_whoop_workouts(s: SparkSession, d: str) -> DataFrame:
    return silver.whoop_workouts(pages(table(s, d, "events"), "event_id", rendered(WHOOP_WORKOUTS, timezone_offset=F.lit("+02:00"), updated_at=F.lit("1")), F.lit(1)))


DAILY: Spec = [
    ("activity_date", "calendarDate", NIGHT, DAY),
    *[(n, k, every(5 + i, f"(o_orderkey + {i}) % {900 + i}", "o_custkey"), INT) for i, (n, k) in enumerate(silver.DAILY_WHOLE.items())],
    *[(n, k, every(4 + i, f"(o_orderkey + {i}) % {9000 + i} + 0.5", "o_custkey"), REAL) for i, (n, k) in enumerate(silver.DAILY_REAL.items())],
]
_STRESS = {n: (k, f"o_custkey % {5 + i} - 2") for i, (n, k) in enumerate(silver.DAILY_STRESS.items())}
_DAILY = f"SELECT {sql_columns(DAILY)}, {', '.join(f'CAST(CASE WHEN {e} >= 0 THEN {e} END AS INTEGER) AS {n}' for n, (_, e) in _STRESS.items())} FROM ({_NEWEST_ORDER})"


@query(_DAILY)
def table_daily(s: SparkSession, d: str) -> DataFrame:
    body = F.to_json(rendered(DAILY, **{k: F.expr(e) for k, e in _STRESS.values()}))
    return silver.daily(captured(table(s, d, "orders"), body, F.col("o_orderkey")))


_WEIGHED = "TIMESTAMP '2021-03-02 06:15:30.250' + CAST(p_partkey % 900 AS INTEGER) * INTERVAL 1 DAY"
BODY: Spec = [
    ("sample_pk", "samplePk", "p_partkey", LONG),
    ("measured_date", "calendarDate", _WEIGHED, DAY),
    ("measured_ts_utc", "timestampGMT", _WEIGHED, EPOCH),
    ("weight_kg", "weight", "p_retailprice * 64", KILO),
    *[(n, k, every(3 + i, f"p_size + 0.{i + 1}25", "p_partkey"), REAL) for i, (n, k) in enumerate({"bmi": "bmi", "body_fat_pct": "bodyFat", "body_water_pct": "bodyWater"}.items())],
    ("bone_mass_kg", "boneMass", "p_size * 100", KILO),
    ("muscle_mass_kg", "muscleMass", every(4, "p_size * 1000", "p_partkey"), KILO),
    *[(n, k, every(5 + i, f"p_size + {i}", "p_partkey"), INT) for i, (n, k) in enumerate({"physique_rating": "physiqueRating", "visceral_fat": "visceralFat", "metabolic_age": "metabolicAge"}.items())],
    ("weight_delta_kg", "weightDelta", "p_size - 25", KILO),
    ("source_type", "sourceType", "p_brand", TEXT),
]


@query(f"SELECT {sql_columns(BODY)} FROM part")
def table_body(s: SparkSession, d: str) -> DataFrame:
    return silver.body(pages(table(s, d, "part"), "p_partkey", rendered(BODY), F.lit(1), key="dateWeightList"))


_OF = "SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_custkey % 4 = {k} QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1"
_RACES = {"race_5k_sec": "time5K", "race_10k_sec": "time10K", "race_half_marathon_sec": "timeHalfMarathon", "race_marathon_sec": "timeMarathon"}


@query(f"""WITH v AS ({_OF.format(k=0)}), t AS ({_OF.format(k=1)}), r AS ({_OF.format(k=2)}), d AS (SELECT d FROM v UNION SELECT d FROM t UNION SELECT d FROM r)
SELECT d.d AS snapshot_date, v.o_totalprice AS vo2max_running, CASE WHEN v.o_orderkey % 3 <> 0 THEN v.o_totalprice / 2 END AS vo2max_cycling, CAST(t.o_custkey % 9 AS INTEGER) AS training_status_code, CAST(t.o_orderkey % 1000 AS INTEGER) AS weekly_training_load, t.o_orderpriority AS training_status_phrase,
{', '.join(f'CAST(r.o_orderkey % 9000 + {i} AS INTEGER) AS {n}' for i, n in enumerate(_RACES))} FROM d LEFT JOIN v ON v.d = d.d LEFT JOIN t ON t.d = d.d LEFT JOIN r ON r.d = d.d""")
def table_fitness(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    key = F.col("o_orderkey")
    part = lambda k, body: captured(o.where(F.col("o_custkey") % 4 == k), body, key, F.to_date("o_orderdate"))
    vo2 = part(0, F.to_json(F.array(rendered([("", "generic.vo2MaxValue", "o_totalprice", REAL), ("", "cycling.vo2MaxValue", every(3, "o_totalprice / 2", "o_orderkey"), REAL)]))))
    later = captured(o.where(F.col("o_custkey") % 4 == 0), F.lit("[]"), key + 10**9, F.to_date("o_orderdate"))  # an empty later capture
    first = rendered([("", "trainingStatus", "o_custkey % 9", LONG), ("", "weeklyTrainingLoad", "o_orderkey % 1000", LONG), ("", "trainingStatusFeedbackPhrase", "o_orderpriority", TEXT)])
    second = F.struct(F.lit(-1).cast("bigint").alias("trainingStatus"), F.lit(-1).cast("bigint").alias("weeklyTrainingLoad"), F.lit("").alias("trainingStatusFeedbackPhrase"))
    status = part(1, F.to_json(F.struct(F.struct(F.create_map(F.lit("9"), first, F.lit("1"), second).alias("latestTrainingStatusData")).alias("mostRecentTrainingStatus"))))
    races = part(2, F.to_json(rendered([("", k, f"o_orderkey % 9000 + {i}", LONG) for i, k in enumerate(_RACES.values())])))
    return silver.fitness(vo2.unionByName(later), status, races)


def _flagged(name: str) -> str | None:
    """The quality flag written beside a gated measurement: for some rows not zero, for some unreadable."""
    every_nth = {"solar_rad_wm2": 7, "surface_temp_c": 5, "surface_temp_max_c": 6, "surface_temp_min_c": 9, "rh_pct": 8}.get(name)
    return every_nth and f"CASE WHEN row_id % {every_nth} = 0 THEN '3' WHEN row_id % 31 = 0 THEN 'x' ELSE '0' END"


def _measured(name: str, missing: tuple, flag: int | None) -> str:
    kept = f"CASE WHEN {name} NOT IN ({', '.join(map(str, missing))}) THEN {name} END"
    return f"CASE WHEN {_flagged(name)} = '0' THEN {kept} END AS {name}" if flag else f"{kept} AS {name}"


_LOCAL = "timezone('America/New_York', timezone('UTC', date_trunc('minute', obs_ts_utc)))"


@query(f"""SELECT date_trunc('minute', obs_ts_utc) AS obs_ts_utc, CAST(obs_ts_utc AS DATE) AS obs_date_utc, {_LOCAL} AS obs_ts_local, CAST({_LOCAL} AS DATE) AS obs_date_local, logger_no::VARCHAR AS wbanno, {', '.join(_measured(n, m, f) for n, _, m, f in silver.WEATHER_FIELDS)}
FROM silver_weather WHERE obs_ts_utc IS NOT NULL QUALIFY row_number() OVER (PARTITION BY logger_no, date_trunc('minute', obs_ts_utc) ORDER BY row_id DESC) = 1""")
def table_weather(s: SparkSession, d: str) -> DataFrame:
    """Every row as a line of its logger; one without an instant is written with an unreadable one, which the table leaves out."""
    f = [F.lit("0")] * 38
    f[0], f[1], f[2] = F.col("logger_no").cast("string"), F.coalesce(F.date_format("obs_ts_utc", "yyyyMMdd"), F.lit("-")), F.coalesce(F.date_format("obs_ts_utc", "HHmm"), F.lit("-"))
    for name, i, missing, flag in silver.WEATHER_FIELDS:
        f[i - 1] = F.coalesce(F.col(name).cast("string"), F.lit(str(missing[0])))
        if flag:
            f[flag - 1] = F.expr(_flagged(name))
    lines = table(s, d, "silver_weather").select(F.concat(F.lit("w_"), F.lpad(F.col("row_id").cast("string"), 13, "0"), F.lit("_x.txt")).alias("filename"), F.concat(F.lit("\0 "), F.concat_ws("  ", *f)).alias("line"))
    return silver.weather(lines, keys=["wbanno", "obs_ts_utc"])


def rounded(df: DataFrame, columns: list[str], places: int = 9) -> DataFrame:
    """Means and sums of doubles depend on the order of their parts in the last digits."""
    return df.withColumns({c: F.round(c, places) for c in columns})


_SUMS = ["workout_total_min", "workout_distance_km", "workout_calories", "strain_kilocalories", "glucose_mean", "glucose_std", "glucose_tir_pct", "glucose_pct_below", "glucose_pct_above", "weight_lb"]
_ONE = {"sleep": ("table_sleep_unified", "night_date"), "recovery": ("table_recovery", "recovery_date"), "workouts": ("table_workouts", "activity_date"), "glucose": ("table_glucose", "reading_date"), "strain": ("table_strain", "strain_date"), "daily": ("table_daily", "activity_date")}
_SHARE = "round(100.0::DOUBLE * count(*) FILTER (WHERE {c}) / count(*), 9)"
_R = lambda e, n: f"round({e}, 9) AS {n}"


@query(f"""WITH {', '.join(f'{n} AS ({SQL[q]})' for n, (q, _) in _ONE.items())}, body AS ({SQL['table_body']}),
ends AS ({' UNION ALL '.join(f'SELECT min({day}) AS lo, max({day}) AS hi FROM {n}' for n, (_, day) in _ONE.items())}), spine AS (SELECT CAST(unnest(generate_series(min(lo)::TIMESTAMP, max(hi)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
rec AS (SELECT * FROM recovery QUALIFY row_number() OVER (PARTITION BY recovery_date ORDER BY created_at DESC NULLS LAST, cycle_id DESC) = 1),
work AS (SELECT activity_date, count(*) AS n, sum(duration_sec) / 60.0 AS minutes, sum(distance_m) / 1000.0 AS km, sum(calories) AS calories FROM workouts GROUP BY 1),
glu AS (SELECT reading_date, count(*) AS n, avg(mgdl) AS mean, min(mgdl) AS lo, max(mgdl) AS hi, stddev_samp(mgdl) AS sd, {_SHARE.format(c='mgdl BETWEEN 70 AND 140')} AS tir, {_SHARE.format(c='mgdl < 70')} AS below, {_SHARE.format(c='mgdl > 140')} AS above FROM glucose WHERE mgdl IS NOT NULL GROUP BY 1),
weighed AS (SELECT measured_date, weight_kg, bmi, body_fat_pct FROM body QUALIFY row_number() OVER (PARTITION BY measured_date ORDER BY sample_pk DESC) = 1)
SELECT spine.day, garmin_sleep_score, garmin_total_min, garmin_rhr, whoop_performance_pct, whoop_efficiency_pct, recovery_score, rec.resting_heart_rate, hrv_rmssd_milli, spo2_percentage, day_strain, {_R('kilojoules / 4.184', 'strain_kilocalories')}, avg_heart_rate AS strain_avg_hr, strain.max_heart_rate AS strain_max_hr,
total_steps AS steps, active_kilocalories AS active_calories, total_distance_m / 1000.0 AS distance_km, floors_ascended AS floors, moderate_intensity_min + vigorous_intensity_min AS intensity_minutes, avg_stress_level AS avg_stress, body_battery_high, body_battery_low,
coalesce(work.n, 0) AS workout_count, {_R('work.minutes', 'workout_total_min')}, {_R('work.km', 'workout_distance_km')}, {_R('work.calories', 'workout_calories')}, glu.n AS glucose_readings, {_R('glu.mean', 'glucose_mean')}, glu.lo AS glucose_min, glu.hi AS glucose_max, {_R('glu.sd', 'glucose_std')}, glu.tir AS glucose_tir_pct, glu.below AS glucose_pct_below, glu.above AS glucose_pct_above,
weight_kg, {_R('weight_kg * 2.20462', 'weight_lb')}, bmi AS body_bmi, body_fat_pct, night_date IS NOT NULL AS has_sleep, rec.cycle_id IS NOT NULL AS has_recovery, strain.cycle_id IS NOT NULL AS has_strain, daily.activity_date IS NOT NULL AS has_daily, work.n IS NOT NULL AS has_workout, glu.n IS NOT NULL AS has_glucose, measured_date IS NOT NULL AS has_weight
FROM spine LEFT JOIN sleep ON night_date = spine.day LEFT JOIN rec ON recovery_date = spine.day LEFT JOIN strain ON strain.cycle_id = rec.cycle_id LEFT JOIN daily ON daily.activity_date = spine.day LEFT JOIN work ON work.activity_date = spine.day LEFT JOIN glu ON reading_date = spine.day ASOF LEFT JOIN weighed ON spine.day >= measured_date""")
def mart_daily_wellness(s: SparkSession, d: str) -> DataFrame:
    """All 45 columns, fed by all seven silver tables."""
    inputs = {n: QUERIES[q](s, d) for n, (q, _) in _ONE.items()}
    body = silver.dedup_latest(table_body(s, d), ["measured_date"], ["sample_pk"])
    return rounded(gold.daily_wellness(inputs | {"body": body}), _SUMS)


_F = lambda x: f"(({x}) * 9.0 / 5.0 + 32.0)"
_TOP, _LOW = _F("max(air_temp_max_c)"), _F("min(air_temp_min_c)")
_WEATHER = {
    "air_temp_max_f": _TOP, "air_temp_min_f": _LOW, "air_temp_avg_f": _F("avg(air_temp_c)"), "gdd50": f"greatest(0.0, ({_TOP} + {_LOW}) / 2.0 - 50)", "precip_total_in": "sum(precip_mm) / 25.4", "solar_rad_mean_wm2": "avg(solar_rad_wm2)", "solar_rad_max_wm2": "max(solar_rad_wm2)",
    "surface_temp_max_f": _F("max(surface_temp_max_c)"), "surface_temp_min_f": _F("min(surface_temp_min_c)"), "rh_mean_pct": "avg(rh_pct)", **{f"soil_temp_{x}_f_mean": _F(f"avg(soil_temp_{x})") for x in gold.DEPTHS}, **{f"soil_moisture_{x}_mean": f"avg(soil_moisture_{x})" for x in gold.DEPTHS},
}


@query(f"""WITH w AS ({LOCAL_DAY_SQL}), a AS (SELECT logger_no, day, {', '.join(f'round({e}, 9) AS {n}' for n, e in _WEATHER.items())}, {_LOW} <= 32 AS frost, {_LOW} <= 28 AS hard_freeze, count(*) AS hours FROM w JOIN silver_weather USING (row_id, logger_no) WHERE day IS NOT NULL GROUP BY 1, 2),
s AS (SELECT logger_no, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM a GROUP BY logger_no)
SELECT logger_no, day, {', '.join(_WEATHER)}, frost, hard_freeze, coalesce(hours, 0) AS hours_observed, hours IS NOT NULL AS has_weather FROM s LEFT JOIN a USING (logger_no, day)""")
def mart_daily_weather(s: SparkSession, d: str) -> DataFrame:
    """All 25 columns of every logger, over all rows whose local day can be read, however it is spelled."""
    w = weather_days(s, d, *dict.fromkeys(c for c, *_ in silver.WEATHER_FIELDS), "logger_no")
    return rounded(gold.daily_weather(w.withColumnRenamed("day", "obs_date_local"), ["logger_no"]), list(_WEATHER))
