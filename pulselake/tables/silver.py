"""The silver tables: typed, one row per logical record.

Each function takes the payload relation ``(filename, j)`` (or CSV rows, or
lines) and gives a lazy DataFrame; columns are declared as data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions.planning import where_computed
from ..operators.relational import dedup_latest, full_outer_sources

WHOLE, REAL, TEXT, LONG, DAY, TIME, FLAG, MINUTES, MILLI_MINUTES, KILO, EITHER, MILLIS, STRESS = "whole", "real", "text", "long", "day", "time", "flag", "minutes", "milli minutes", "kilo", "millis or text", "millis", "stress"


KINDS = {
    WHOLE: E.exact_int, REAL: lambda t: t.try_cast("double"), TEXT: lambda t: t, LONG: lambda t: E.exact_int(t, "bigint"), DAY: E.iso_date, TIME: E.ntz, FLAG: E.flag,
    MINUTES: lambda t: t.try_cast("double") / 60.0, MILLI_MINUTES: lambda t: t.try_cast("double") / 60000.0, KILO: lambda t: t.try_cast("double") / 1000.0, EITHER: E.millis_or_iso, MILLIS: E.millis_ntz, STRESS: lambda t: E.without(E.exact_int(t), -1, -2),
}
Spec = dict[str, tuple[str, str]]  # output column: path and kind


def _typed(df: DataFrame, json: str, spec: Spec, needed: list[str], more: dict[str, Callable] | None = None, keep: list[str] | None = None, also: list[str] | None = None) -> DataFrame:
    """The columns of a spec read from a JSON column in one pass, rows without one of the ``needed`` columns left out.

    ``more``: columns made by a function of the field getter, of the paths in
    ``also``; ``keep``: columns of ``df`` kept as they are.
    """
    parsed, get = E.with_fields(df, json, [p for p, _ in spec.values()] + (also or []))
    columns = {n: KINDS[kind](get(p)) for n, (p, kind) in spec.items()} | {n: f(get) for n, f in (more or {}).items()}
    typed = parsed.select(*[c.alias(n) for n, c in columns.items()], *(keep or []))
    return where_computed(typed, reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in needed]))


def _latest(df: DataFrame, keys: list[str], order: str, *helpers: str) -> DataFrame:
    return dedup_latest(df, keys, [order, "__file"]).drop(order, "__file", *helpers)


def _captures(payloads: DataFrame) -> DataFrame:
    return payloads.select("j", F.col("filename").alias("__file"), E.fetched_ms(F.col("filename")).alias("__fetched"))


def _records(payloads: DataFrame, array: Column) -> DataFrame:
    return payloads.select(F.col("filename").alias("__file"), E.fetched_ms(F.col("filename")).alias("__fetched"), F.explode(array).alias("a"))


_DTO = "dailySleepDTO"
SLEEP_GARMIN: Spec = {
    "night_date": (f"{_DTO}.calendarDate", DAY), "garmin_sleep_score": (f"{_DTO}.sleepScores.overall.value", WHOLE),
    **{f"garmin_{n}_min": (f"{_DTO}.{k}Seconds", MINUTES) for n, k in (("total", "sleepTime"), ("deep", "deepSleep"), ("light", "lightSleep"), ("rem", "remSleep"), ("awake", "awakeSleep"))},
    "garmin_avg_stress": (f"{_DTO}.avgSleepStress", REAL), "garmin_resp_avg": (f"{_DTO}.averageRespirationValue", REAL), "garmin_spo2_avg": (f"{_DTO}.averageSpO2Value", REAL), "garmin_rhr": ("restingHeartRate", WHOLE),
    "garmin_start_gmt": (f"{_DTO}.sleepStartTimestampGMT", EITHER), "garmin_end_gmt": (f"{_DTO}.sleepEndTimestampGMT", EITHER),
}


def sleep_garmin(payloads: DataFrame) -> DataFrame:
    return _latest(_typed(_captures(payloads), "j", SLEEP_GARMIN, ["night_date"], keep=["__fetched", "__file"]), ["night_date"], "__fetched")


def _local(start: str) -> Callable:
    """The local day of an instant by the record's own offset."""
    return lambda get: E.local_date(get(start), get("timezone_offset"))


_STAGE = "score.stage_summary."
SLEEP_WHOOP: Spec = {
    "whoop_sleep_id": ("id", TEXT), "is_nap": ("nap", FLAG), **{f"whoop_{k}_pct": (f"score.sleep_{k}_percentage", REAL) for k in ("performance", "efficiency", "consistency")}, "whoop_resp_rate": ("score.respiratory_rate", REAL),
    **{f"whoop_{n}_min": (f"{_STAGE}total_{k}_time_milli", MILLI_MINUTES) for n, k in (("deep", "slow_wave_sleep"), ("rem", "rem_sleep"), ("light", "light_sleep"), ("awake", "awake"))},
    "whoop_disturbances": (f"{_STAGE}disturbance_count", WHOLE), "whoop_cycle_id": ("cycle_id", LONG), "whoop_start": ("start", TIME), "whoop_end": ("end", TIME), "__updated": ("updated_at", TEXT),
}


def sleep_whoop(payloads: DataFrame) -> DataFrame:
    typed = _typed(_records(payloads, E.json_array(F.col("j"), "records")), "a", SLEEP_WHOOP, ["whoop_sleep_id", "night_date"], {"night_date": _local("end")}, ["__file"], ["timezone_offset"])
    return _latest(typed.select("night_date", *SLEEP_WHOOP, "__file"), ["whoop_sleep_id"], "__updated")


def sleep_unified(garmin: DataFrame, whoop: DataFrame) -> DataFrame:
    nights = dedup_latest(whoop.where(~F.col("is_nap")), ["night_date"], ["whoop_start", "whoop_sleep_id"]).drop("whoop_sleep_id", "is_nap")
    return full_outer_sources(garmin, nights, "night_date", "has_garmin", "has_whoop")


GLUCOSE_COLUMNS = {"ts": "Time of Glucose Reading [T=(local time) +/- (time zone offset)]", "mgdl": "Measurement(mg/dL)"}


def glucose(rows: DataFrame) -> DataFrame:
    ts = F.col("ts")
    local, shift = E.ntz(F.substring(ts, 1, 16)), E.offset_minutes(F.substring(ts, 17, 6))
    typed = rows.where(local.isNotNull()).select(
        E.shifted(local, -shift).alias("reading_ts_utc"), local.alias("reading_ts_local"), F.to_date(local).alias("reading_date"), shift.alias("tz_offset_minutes"), E.exact_int(F.col("mgdl")).alias("mgdl"), E.fetched_ms(F.col("filename")).alias("__fetched"), F.col("filename").alias("__file")
    )
    return _latest(typed, ["reading_ts_utc"], "__fetched")


RECOVERY: Spec = {
    "cycle_id": ("cycle_id", LONG), "sleep_id": ("sleep_id", TEXT), "recovery_date": ("created_at", DAY), "created_at": ("created_at", TIME),
    **{k: (f"score.{k}", REAL) for k in ("recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "spo2_percentage", "skin_temp_celsius")}, "user_calibrating": ("score.user_calibrating", FLAG), "__updated": ("updated_at", TEXT), "__key": ("cycle_id", TEXT),
}


def recovery(payloads: DataFrame) -> DataFrame:
    return _latest(_typed(_records(payloads, E.json_array(F.col("j"), "records")), "a", RECOVERY, ["__key"], keep=["__file"]), ["cycle_id"], "__updated", "__key")


STRAIN: Spec = {
    "cycle_id": ("id", LONG), "start_ts": ("start", TIME), "end_ts": ("end", TIME), "day_strain": ("score.strain", REAL), "kilojoules": ("score.kilojoule", REAL), "avg_heart_rate": ("score.average_heart_rate", WHOLE), "max_heart_rate": ("score.max_heart_rate", WHOLE), "score_state": ("score_state", TEXT), "__updated": ("updated_at", TEXT), "__key": ("id", TEXT),
}


def strain(payloads: DataFrame) -> DataFrame:
    typed = _typed(_records(payloads, E.json_array(F.col("j"), "records")), "a", STRAIN, ["__key"], {"strain_date": _local("start")}, ["__file"], ["timezone_offset"])
    return _latest(typed.select("cycle_id", "strain_date", *[c for c in STRAIN if c != "cycle_id"], "__file"), ["cycle_id"], "__updated", "__key")


WORKOUT: Spec = {
    "activity_id": ("activityId", LONG), "activity_name": ("activityName", TEXT), "activity_type": ("activityType.typeKey", TEXT), "activity_date": ("startTimeLocal", DAY), "start_time_local": ("startTimeLocal", TIME), "start_time_gmt": ("startTimeGMT", TIME),
    "duration_sec": ("duration", REAL), "moving_duration_sec": ("movingDuration", REAL), "elapsed_duration_sec": ("elapsedDuration", REAL), "distance_m": ("distance", REAL), "calories": ("calories", REAL), "avg_hr": ("averageHR", WHOLE), "max_hr": ("maxHR", WHOLE),
    **{f"hr_z{z}_sec": (f"hrTimeInZone_{z}", REAL) for z in range(1, 6)}, "device_id": ("deviceId", LONG), "__key": ("activityId", TEXT),
}


def workouts(payloads: DataFrame) -> DataFrame:
    return _latest(_typed(_records(payloads, E.json_array(F.col("j"))), "a", WORKOUT, ["__key"], keep=["__fetched", "__file"]), ["activity_id"], "__fetched", "__key")


LAP: Spec = {
    "lap_index": ("lapIndex", WHOLE), "lap_start_gmt": ("startTimeGMT", TIME), "duration_sec": ("duration", REAL), "moving_duration_sec": ("movingDuration", REAL), "distance_m": ("distance", REAL), "avg_speed_mps": ("averageSpeed", REAL), "max_speed_mps": ("maxSpeed", REAL),
    "avg_hr": ("averageHR", WHOLE), "max_hr": ("maxHR", WHOLE), "calories": ("calories", REAL), "elevation_gain_m": ("elevationGain", REAL), "elevation_loss_m": ("elevationLoss", REAL), "__key": ("lapIndex", TEXT),
}


def workout_splits(payloads: DataFrame) -> DataFrame:
    laps = payloads.select(F.col("filename").alias("__file"), E.fetched_ms(F.col("filename")).alias("__fetched"), E.json_int(F.col("j"), "activityId", "bigint").alias("activity_id"), F.explode(E.json_array(F.col("j"), "lapDTOs")).alias("a"))
    typed = _typed(laps, "a", LAP, ["activity_id", "__key"], keep=["activity_id", "__fetched", "__file"])
    return _latest(typed.select("activity_id", *LAP, "__fetched", "__file"), ["activity_id", "lap_index"], "__fetched", "__key")


WHOOP_WORKOUT: Spec = {
    "workout_id": ("id", TEXT), "sport_name": ("sport_name", TEXT), "sport_id": ("sport_id", WHOLE), "start_ts": ("start", TIME), "end_ts": ("end", TIME), "strain": ("score.strain", REAL), "avg_heart_rate": ("score.average_heart_rate", WHOLE), "max_heart_rate": ("score.max_heart_rate", WHOLE), "kilojoules": ("score.kilojoule", REAL),
    "distance_m": ("score.distance_meter", REAL), "altitude_gain_m": ("score.altitude_gain_meter", REAL), "percent_recorded": ("score.percent_recorded", REAL), "score_state": ("score_state", TEXT), "__updated": ("updated_at", TEXT),
}


def whoop_workouts(payloads: DataFrame) -> DataFrame:
    typed = _typed(_records(payloads, E.json_array(F.col("j"), "records")), "a", WHOOP_WORKOUT, ["workout_id"], {"workout_date": _local("start")}, ["__file"], ["timezone_offset"])
    return _latest(typed.select("workout_id", "workout_date", *[c for c in WHOOP_WORKOUT if c != "workout_id"], "__file"), ["workout_id"], "__updated")


# Output column and source key of the daily summary.
DAILY_WHOLE = {
    "total_steps": "totalSteps", "step_goal": "dailyStepGoal", "moderate_intensity_min": "moderateIntensityMinutes", "vigorous_intensity_min": "vigorousIntensityMinutes", "intensity_minutes_goal": "intensityMinutesGoal", "min_heart_rate": "minHeartRate", "max_heart_rate": "maxHeartRate", "resting_heart_rate": "restingHeartRate",
    "body_battery_high": "bodyBatteryHighestValue", "body_battery_low": "bodyBatteryLowestValue", "body_battery_charged": "bodyBatteryChargedValue", "body_battery_drained": "bodyBatteryDrainedValue", "avg_spo2": "averageSpo2", "lowest_spo2": "lowestSpo2", "rest_stress_duration": "restStressDuration", "low_stress_duration": "lowStressDuration",
    "medium_stress_duration": "mediumStressDuration", "high_stress_duration": "highStressDuration", "highly_active_seconds": "highlyActiveSeconds", "active_seconds": "activeSeconds", "sedentary_seconds": "sedentarySeconds", "sleeping_seconds": "sleepingSeconds",
}
DAILY_REAL = {
    "total_distance_m": "totalDistanceMeters", "total_kilocalories": "totalKilocalories", "active_kilocalories": "activeKilocalories", "bmr_kilocalories": "bmrKilocalories", "floors_ascended": "floorsAscended", "floors_descended": "floorsDescended",
    "avg7d_resting_heart_rate": "lastSevenDaysAvgRestingHeartRate", "avg_waking_respiration": "avgWakingRespirationValue", "highest_respiration": "highestRespirationValue", "lowest_respiration": "lowestRespirationValue",
}
DAILY_STRESS = {"avg_stress_level": "averageStressLevel", "max_stress_level": "maxStressLevel"}


DAILY: Spec = {"activity_date": ("calendarDate", DAY), **{n: (k, WHOLE) for n, k in DAILY_WHOLE.items()}, **{n: (k, REAL) for n, k in DAILY_REAL.items()}, **{n: (k, STRESS) for n, k in DAILY_STRESS.items()}}


def daily(payloads: DataFrame) -> DataFrame:
    return _latest(_typed(_captures(payloads), "j", DAILY, ["activity_date"], keep=["__fetched", "__file"]), ["activity_date"], "__fetched")


BODY: Spec = {
    "sample_pk": ("samplePk", LONG), "measured_date": ("calendarDate", DAY), "measured_ts_utc": ("timestampGMT", MILLIS), "weight_kg": ("weight", KILO), "bmi": ("bmi", REAL), "body_fat_pct": ("bodyFat", REAL), "body_water_pct": ("bodyWater", REAL), "bone_mass_kg": ("boneMass", KILO), "muscle_mass_kg": ("muscleMass", KILO),
    "physique_rating": ("physiqueRating", WHOLE), "visceral_fat": ("visceralFat", WHOLE), "metabolic_age": ("metabolicAge", WHOLE), "weight_delta_kg": ("weightDelta", KILO), "source_type": ("sourceType", TEXT), "__key": ("samplePk", TEXT),
}


def body(payloads: DataFrame) -> DataFrame:
    return _latest(_typed(_records(payloads, E.json_array(F.col("j"), "dateWeightList")), "a", BODY, ["__key"], keep=["__fetched", "__file"]), ["sample_pk"], "__fetched", "__key")


def _snapshots(payloads: DataFrame, *columns: Column, keep: Column | None = None) -> DataFrame:
    typed = payloads.select(E.partition_day(F.col("filename")).alias("snapshot_date"), *columns, E.fetched_ms(F.col("filename")).alias("__fetched"), F.col("filename").alias("__file")).where(F.col("snapshot_date").isNotNull())
    return _latest(typed if keep is None else typed.where(keep), ["snapshot_date"], "__fetched")


def fitness(max_metrics: DataFrame, training_status: DataFrame, race_predictions: DataFrame) -> DataFrame:
    """A row per snapshot day of any of the three; an empty later capture does not clobber VO2max."""
    j = F.col("j")
    vo2 = _snapshots(max_metrics, E.json_num(j, "$[0].generic.vo2MaxValue").alias("vo2max_running"), E.json_num(j, "$[0].cycling.vo2MaxValue").alias("vo2max_cycling"), keep=F.col("vo2max_running").isNotNull() | F.col("vo2max_cycling").isNotNull())
    device = E.first_map_value(E.json_str(j, "mostRecentTrainingStatus.latestTrainingStatusData"))
    status = _snapshots(training_status, E.json_int(device, "trainingStatus").alias("training_status_code"), E.json_int(device, "weeklyTrainingLoad").alias("weekly_training_load"), E.json_str(device, "trainingStatusFeedbackPhrase").alias("training_status_phrase"))
    races = _snapshots(race_predictions, *[E.json_int(j, f"time{k}").alias(f"race_{n}_sec") for n, k in (("5k", "5K"), ("10k", "10K"), ("half_marathon", "HalfMarathon"), ("marathon", "Marathon"))])
    days = vo2.select("snapshot_date").union(status.select("snapshot_date")).union(races.select("snapshot_date")).distinct()
    return days.join(vo2, "snapshot_date", "left").join(status, "snapshot_date", "left").join(races, "snapshot_date", "left")


# Measurement, 1-based field, missing-value sentinels, 1-based quality flag.
_T, _M, _S = (-9999.0, 99999.0), (-99.0,), (-99999.0,)
WEATHER_FIELDS = [
    ("air_temp_c", 10, _T, None), ("air_temp_max_c", 11, _T, None), ("air_temp_min_c", 12, _T, None), ("precip_mm", 13, _T, None), ("solar_rad_wm2", 14, _S, 15), ("surface_temp_c", 21, _T, 22), ("surface_temp_max_c", 23, _T, 24), ("surface_temp_min_c", 25, _T, 26), ("rh_pct", 27, _T, 28),
    *[(f"soil_moisture_{d}", 29 + i, _M, None) for i, d in enumerate((5, 10, 20, 50, 100))], *[(f"soil_temp_{d}", 34 + i, _T, None) for i, d in enumerate((5, 10, 20, 50, 100))],
]


def weather(lines: DataFrame, zone: str = "America/New_York", keys: list[str] | None = None) -> DataFrame:
    """One row per instant of a station's lines, or per ``keys`` where lines of several stations come together."""
    f = lambda i: F.get("f", F.lit(i - 1))
    split = lines.select("filename", F.split(F.trim(F.replace(F.col("line"), F.lit("\0"), F.lit(""))), r"\s+").alias("f"))
    utc = E.compact_ntz(f(2), f(3))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("obs_ts_utc"))
    measured = []
    for name, i, missing, flag in WEATHER_FIELDS:
        value = E.without(f(i).try_cast("double"), *missing)
        measured.append((value if flag is None else E.qc_gate(value, E.exact_int(f(flag)))).alias(name))
    typed = split.withColumn("obs_ts_utc", utc).where(F.col("obs_ts_utc").isNotNull()).select(
        "obs_ts_utc", F.to_date("obs_ts_utc").alias("obs_date_utc"), local.alias("obs_ts_local"), F.to_date(local).alias("obs_date_local"), f(1).alias("wbanno"), *measured, E.fetched_ms(F.col("filename")).alias("__fetched"), F.col("filename").alias("__file")
    )
    return _latest(typed, keys or ["obs_ts_utc"], "__fetched")
