"""Data-quality checks; every result is a row of one shape.

A result has check_name, passed, severity and found. Checks of one table
are computed in a single aggregation over it.
"""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import classify_payload, event_date, key_signature, payload_event_values, payload_signature
from ..operators.relational import date_gaps, dedup_latest, spread_sample

ERROR, WARN = "ERROR", "WARN"


def outside(name: str, low: float | None = None, high: float | None = None, below: float | None = None) -> Column:
    """True where a value that is not null is out of bounds (``below``: must be less than)."""
    c = F.col(name)
    tests = [t for t in (None if low is None else c < low, None if high is None else c > high, None if below is None else c >= below) if t is not None]
    return c.isNotNull() & reduce(lambda a, b: a | b, tests)


# Unique keys and bounds (low, high, below) of each table.
KEYS = {
    "sleep_garmin": ["night_date"], "sleep_whoop": ["whoop_sleep_id"], "sleep": ["night_date"], "glucose": ["reading_ts_utc"], "recovery": ["cycle_id"], "strain": ["cycle_id"], "workouts": ["activity_id"], "workout_splits": ["activity_id", "lap_index"],
    "whoop_workouts": ["workout_id"], "daily": ["activity_date"], "body": ["sample_pk"], "fitness": ["snapshot_date"], "weather": ["obs_ts_utc"], "daily_wellness": ["day"], "daily_weather": ["day"],
}
_PCT, _HR, _HR0, _NONNEG = (0, 100, None), (20, 240, None), (0, 240, None), (0, None, None)
_SOIL = [f"soil_{k}_{d}" for k in ("temp",) for d in (5, 10, 20, 50, 100)]
BOUNDS: dict[str, dict[str, tuple]] = {
    "sleep": {**{f"whoop_{k}_pct": _PCT for k in ("performance", "efficiency", "consistency")}, **{f"{s}_{k}_min": (0, None, 1440) for s in ("garmin", "whoop") for k in ("deep", "light", "rem", "awake")}, "garmin_total_min": (0, None, 1440)},
    "glucose": {"mgdl": (10, 600, None)},
    "recovery": {"recovery_score": _PCT, "resting_heart_rate": (20, 120, None), "hrv_rmssd_milli": (0, 500, None), "spo2_percentage": (50, 100, None), "skin_temp_celsius": (20, 45, None)},
    "strain": {"day_strain": (0, 21, None), "kilojoules": _NONNEG, "avg_heart_rate": _HR, "max_heart_rate": _HR},
    "workouts": {"duration_sec": (0, None, 604800), "distance_m": (0, None, 1_000_000), "calories": _NONNEG, "avg_hr": _HR0, "max_hr": _HR0},
    "workout_splits": {"duration_sec": _NONNEG, "distance_m": _NONNEG, "avg_speed_mps": _NONNEG, "avg_hr": _HR0, "max_hr": _HR0, "lap_index": _NONNEG},
    "whoop_workouts": {"strain": (0, 21, None), "avg_heart_rate": _HR, "max_heart_rate": _HR, "kilojoules": _NONNEG, "distance_m": _NONNEG},
    "daily": {"total_steps": (0, 200_000, None), "total_distance_m": _NONNEG, "active_kilocalories": (0, 30_000, None), "resting_heart_rate": (20, 150, None), "max_heart_rate": _HR, "avg_stress_level": _PCT, "avg_spo2": (50, 100, None), "body_battery_high": _PCT},
    "body": {"weight_kg": (20, 300, None), "bmi": (10, 80, None), "body_fat_pct": (0, 70, None), "body_water_pct": _PCT, "muscle_mass_kg": (0, 200, None)},
    "fitness": {"vo2max_running": (10, 90, None), "vo2max_cycling": (10, 90, None), "weekly_training_load": _NONNEG, **{f"race_{r}_sec": (1, None, None) for r in ("5k", "10k", "half_marathon", "marathon")}},
    "weather": {**{c: (-60, 60, None) for c in ("air_temp_c", "air_temp_max_c", "air_temp_min_c", "surface_temp_c", "surface_temp_max_c", "surface_temp_min_c", *_SOIL)}, **{f"soil_moisture_{d}": (0, 1, None) for d in (5, 10, 20, 50, 100)}, "rh_pct": _PCT, "precip_mm": _NONNEG, "solar_rad_wm2": (0, 2000, None)},
    "daily_wellness": {"glucose_tir_pct": _PCT, "glucose_mean": (10, 600, None), "recovery_score": _PCT, "workout_count": _NONNEG, "workout_total_min": _NONNEG, "day_strain": (0, 21, None), "strain_kilocalories": _NONNEG, "steps": (0, 200_000, None), "active_calories": _NONNEG, "avg_stress": _PCT, "weight_lb": (44, 660, None), "body_fat_pct": (0, 70, None)},
    "daily_weather": {**{c: (-60, 200, None) for c in ("air_temp_max_f", "air_temp_min_f", "air_temp_avg_f", "surface_temp_max_f", "surface_temp_min_f")}, **{f"soil_temp_{d}_f_mean": (-40, 140, None) for d in (5, 10, 20, 50, 100)}, **{f"soil_moisture_{d}_mean": (0, 1, None) for d in (5, 10, 20, 50, 100)}, "rh_mean_pct": _PCT, "precip_total_in": _NONNEG, "gdd50": _NONNEG, "solar_rad_mean_wm2": _NONNEG, "solar_rad_max_wm2": _NONNEG, "hours_observed": (0, 26, None)},
}


def table_checks(df: DataFrame, table: str, keys: list[str] | None = None, bounds: dict[str, tuple] | None = None) -> DataFrame:
    """Uniqueness, null keys and ranges of a table, in one pass; an empty table passes.

    Distinct keys are counted exactly through a pre-aggregation by key.
    """
    keys, bounds = keys or KEYS[table], BOUNDS.get(table, {}) if bounds is None else bounds
    bad = [outside(c, *b) for c, b in bounds.items() if c in df.columns]
    if table == "daily_weather" and {"air_temp_max_f", "air_temp_min_f"} <= set(df.columns):
        bad.append(F.coalesce(F.col("air_temp_max_f") < F.col("air_temp_min_f"), F.lit(False)))
    flag = reduce(lambda a, b: a | b, bad, F.lit(False))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.count_if(flag).alias("__bad")).withColumn("__null", null)
    total = per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("repeated"), F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), F.lit(0)).alias("null_keys"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("out_of_range"))
    named = F.array(*[F.struct(F.lit(f"{table}_{k}").alias("check_name"), (F.col(k) == 0).alias("passed"), F.lit(ERROR).alias("severity"), F.col(k).cast("bigint").alias("found"), F.lit(d).alias("description")) for k, d in (("repeated", "rows beyond one per key"), ("null_keys", "rows with a null key"), ("out_of_range", "rows with a value out of bounds"))])
    return total.select(F.explode(named).alias("r")).select("r.*")


def coverage(df: DataFrame, key: Column, source: DataFrame, source_key: Column, name: str) -> DataFrame:
    """Distinct keys of a table against those of its source; short of it is a warning."""
    have, want = df.agg(F.count_distinct(key).alias("have")), source.agg(F.count_distinct(source_key).alias("want"))
    missing = (F.col("want") - F.col("have")).cast("bigint")
    return have.crossJoin(want).select(F.lit(name).alias("check_name"), (missing <= 0).alias("passed"), F.lit(WARN).alias("severity"), missing.alias("found"), F.lit("keys of the source missing in the table").alias("description"))


def source_split(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of both sources, of the first only and of the second only, in one pass."""
    return df.agg(F.count_if(F.col(a) & F.col(b)).alias("both"), F.count_if(F.col(a) & ~F.col(b)).alias("only_first"), F.count_if(~F.col(a) & F.col(b)).alias("only_second"))


def freshness(captures: DataFrame, config: DataFrame, now_ms: int) -> DataFrame:
    """Per configured collection: newest capture within cadence and grace; none at all passes only where that is expected."""
    newest = captures.groupBy("source_name", "collection_name").agg(F.max("fetched_ms").alias("newest"), F.count(F.lit(1)).alias("n"))
    lag = (F.lit(now_ms) - F.col("newest")) / 3_600_000.0
    one = config.groupBy("source_name", "collection_name").agg(F.max("cadence_hours").alias("cadence_hours"), F.max("grace_hours").alias("grace_hours"), F.bool_or("expected_empty").alias("expected_empty"))
    rows = one.join(newest, ["source_name", "collection_name"], "left")
    ok = F.when(F.coalesce("n", F.lit(0)) == 0, F.col("expected_empty")).otherwise(lag <= F.col("cadence_hours") + F.col("grace_hours"))
    return rows.select("source_name", "collection_name", F.coalesce(ok, F.lit(False)).alias("passed"), F.lit(ERROR).alias("severity"), lag.alias("lag_hours"))


def completeness(dates: DataFrame, day: str, groups: list[str], cadence: int = 1) -> DataFrame:
    """Gaps beyond the cadence per group, with the days missing; groups of fewer than two days have none."""
    gaps = date_gaps(dates, day, groups, cadence)
    return gaps.groupBy(*groups).agg(F.count(F.lit(1)).alias("gaps"), F.sum("missing").cast("bigint").alias("missing"), F.max("missing").alias("longest")).withColumn("severity", F.lit(WARN))


def richest_signature(payloads: DataFrame, groups: list[str], newest_by: str, signature: Column | None = None) -> DataFrame:
    """Per group the key signature with most keys, the newest on ties."""
    sig = payloads.withColumn("__sig", key_signature(F.col("j")) if signature is None else signature)
    return sig.where(F.col("__sig").isNotNull()).groupBy(*groups).agg(F.max_by("__sig", F.struct(F.size("__sig"), F.col(newest_by))).alias("signature"))


def drift_between(now: DataFrame, baseline: DataFrame, groups: list[str]) -> DataFrame:
    """Keys added and removed against the baseline; a group without one passes and becomes it."""
    old = baseline.select(*groups, F.col("signature").alias("__old"))
    j = now.join(old, groups, "left")
    added, removed = F.array_except("signature", "__old"), F.array_except("__old", "signature")
    empty = F.array().cast("array<string>")
    j = j.select(*groups, "signature", F.coalesce(added, empty).alias("added"), F.coalesce(removed, empty).alias("removed"))
    return j.withColumn("passed", (F.size("added") == 0) & (F.size("removed") == 0)).withColumn("severity", F.lit(ERROR))


def read_baseline(path: str) -> dict[str, list[str]]:
    p = Path(path)
    return json.loads(p.read_text()) if p.exists() else {}


def write_baseline(path: str, signatures: dict[str, list[str]], raw_root: str | None = None) -> None:
    """Store signatures by rename; never inside the raw captures."""
    p = Path(path).resolve()
    if raw_root and Path(raw_root).resolve() in (p, *p.parents):
        raise ValueError("the baseline must lie outside the raw captures")
    p.parent.mkdir(parents=True, exist_ok=True)
    part = p.with_suffix(".part")
    part.write_text(json.dumps(signatures, sort_keys=True))
    part.replace(p)


def verdicts(payloads: DataFrame, groups: list[str]) -> DataFrame:
    """Histogram of payload classes; ``payloads`` has file_name, j and http_status."""
    return payloads.withColumn("verdict", classify_payload(F.col("file_name"), F.col("j"), F.col("http_status"))).groupBy(*groups, "verdict").agg(F.count(F.lit(1)).alias("n"))


# Which classes are data, absence of it, or an error; the check families; trailing partitions looked at.
DATA_CLASSES = ("DATA", "CSV_DATA", "TXT_DATA")
EMPTY_CLASSES = ("EMPTY_LIST", "EMPTY_OBJECT", "EMPTY_WRAPPER", "EMPTY_FILE")
ERROR_CLASSES = ("HTTP_ERROR", "ERROR_LIKE", "UNPARSEABLE")
FAMILIES = ("freshness", "completeness", "schema", "content")
RECENT = 14
STREAM = ["source_name", "collection_name"]


def with_reader(payloads: DataFrame) -> DataFrame:
    """Payloads with ``reader`` as the file's ending tells, or else as recorded, or json."""
    ending = F.regexp_extract(F.lower("file_name"), r"\.(json|csv|txt)$", 1)
    recorded = F.col("reader") if "reader" in payloads.columns else F.lit(None).cast("string")
    return payloads.withColumn("reader", F.coalesce(F.nullif(ending, F.lit("")), recorded, F.lit("json")))


def recent(payloads: DataFrame, n: int = RECENT, groups: list[str] | None = None) -> DataFrame:
    """Payloads of the ``n`` newest partitions of their stream: the window checks look at.

    Partitions are counted from the distinct days of a stream, never its rows.
    """
    groups = groups or STREAM
    days = payloads.where(F.col("dt").isNotNull()).select(*groups, "dt").distinct()
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("dt")))
    kept = days.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
    return payloads.join(kept, [*groups, "dt"], "left_semi")


def _configured(payloads: DataFrame, config: DataFrame) -> DataFrame:
    """Payloads beside the configuration of their stream and reader."""
    return with_reader(payloads).join(config, [*STREAM, "reader"])


def event_dates(payloads: DataFrame, config: DataFrame, n: int = RECENT) -> DataFrame:
    """``(source_name, collection_name, reader, day)``: the distinct days of events, of the trailing partitions.

    By configuration the day is that of the partition, or stands in the payload:
    in a field of each JSON record, or in a CSV column. Values that are no day,
    payloads that cannot be read and other sources of the day give none.
    """
    rows = _configured(recent(payloads, n), config)
    written = F.when(F.col("event_date_source") == "partition", F.array("dt")).when(F.col("event_date_source") == "payload", payload_event_values(F.col("j"), F.col("reader"), F.col("unnest_records"), F.col("event_date_field")))
    days = rows.select(*STREAM, "reader", F.explode(F.array_distinct(written)).alias("__v")).select(*STREAM, "reader", event_date(F.col("__v")).alias("day"))
    return days.where(F.col("day").isNotNull()).distinct()


def event_completeness(payloads: DataFrame, config: DataFrame, n: int = RECENT) -> DataFrame:
    """Gaps between successive event days beyond each stream's own cadence: count, missing days, longest; streams without a gap pass."""
    days = event_dates(payloads, config, n)
    by = Window.partitionBy(*STREAM, "reader").orderBy("day")
    gap = F.date_diff("day", F.lag("day").over(by))
    joined = days.withColumn("__gap", gap).join(config.select(*STREAM, "reader", "cadence_days"), [*STREAM, "reader"])
    wide = F.when(F.col("__gap") > F.col("cadence_days"), F.col("__gap") - 1)
    return joined.groupBy(*STREAM, "reader").agg(F.count(F.lit(1)).alias("days"), F.count(wide).alias("gaps"), F.coalesce(F.sum(wide), F.lit(0)).cast("bigint").alias("missing"), F.coalesce(F.max(wide), F.lit(0)).cast("bigint").alias("longest")).withColumn("passed", F.col("gaps") == 0)


def signatures(payloads: DataFrame, config: DataFrame, n: int = RECENT) -> DataFrame:
    """Per stream and reader the richest signature among the newest payload of each trailing partition, the newest on ties; empty ones tell nothing."""
    rows = _configured(recent(payloads, n), config)
    newest = dedup_latest(rows.select(*STREAM, "reader", "dt", "fetched_ms", "file_name", "unnest_records", "j"), [*STREAM, "reader", "dt"], ["fetched_ms", "file_name"])
    sig = newest.withColumn("__sig", payload_signature(F.col("j"), F.col("reader"), F.col("unnest_records"))).where(F.size("__sig") > 0)
    return sig.groupBy(*STREAM, "reader").agg(F.max_by("__sig", F.struct(F.size("__sig"), F.col("dt"))).alias("signature"))


def content_health(payloads: DataFrame, config: DataFrame, n_samples: int = 5, n: int = RECENT) -> DataFrame:
    """Verdict on an even spread of a stream's recent payloads.

    ``payloads`` has source_name, collection_name, dt, file_name, fetched_ms, j,
    http_status and ``issues`` (integrity findings per payload). Integrity
    outranks all else and is an error; error-like or unreadable payloads warn;
    empty ones warn unless the stream may be empty; no payload at all passes, as
    freshness tells absence.
    """
    rows = with_reader(recent(payloads, n)).withColumn("__group", F.struct(*STREAM, "reader"))
    sample = spread_sample(rows, "__group", ["dt", "fetched_ms", "file_name"], n_samples, F.datediff(F.col("dt").cast("date"), F.lit("1970-01-01").cast("date")))
    verdict = classify_payload(F.col("file_name"), F.col("j"), F.col("http_status"))
    share = lambda *kinds: F.count_if(F.col("verdict").isin(*kinds))
    seen = sample.withColumn("verdict", verdict).groupBy(*STREAM, "reader").agg(F.count(F.lit(1)).alias("seen"), share(*DATA_CLASSES).alias("data"), share(*EMPTY_CLASSES).alias("empty"), share(*ERROR_CLASSES).alias("errors"), F.sum("issues").cast("bigint").alias("issues"))
    out = config.select(*STREAM, "reader", "expected_empty").join(seen, [*STREAM, "reader"], "left").fillna(0, ["seen", "data", "empty", "errors", "issues"])
    state = F.when(F.col("seen") == 0, "NO_PAYLOADS").when(F.col("issues") > 0, "CORRUPT").when(F.col("errors") > 0, "ERRORS").when((F.col("empty") > 0) & ~F.col("expected_empty"), "EMPTY").when(F.col("empty") > 0, "EXPECTED_EMPTY").otherwise("DATA")
    return out.withColumn("state", state).withColumn("passed", F.col("state").isin("NO_PAYLOADS", "EXPECTED_EMPTY", "DATA")).withColumn("severity", F.when(F.col("state") == "CORRUPT", ERROR).otherwise(WARN))


def sweep(payloads: DataFrame, groups: list[str], order: list[str], n: int = 5, bucket: Column | None = None) -> DataFrame:
    """State of each stream by an even spread of ``n`` payloads: HEALTHY, MIXED or NO_DATA."""
    v = verdicts(spread_sample(payloads.withColumn("__group", F.struct(*groups)), "__group", order, n, bucket), groups)
    good = F.coalesce(F.sum(F.when(F.col("verdict").isin(*DATA_CLASSES), F.col("n"))), F.lit(0)).cast("bigint").alias("good")
    return v.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("seen"), good).withColumn("state", F.when(F.col("good") == 0, "NO_DATA").when(F.col("good") == F.col("seen"), "HEALTHY").otherwise("MIXED"))


def run_checks(payloads: DataFrame, config: DataFrame, baseline: DataFrame, now_ms: int, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """The checks of every configured stream as rows ``(check_name, passed, severity, found)``; none materialises a table.

    ``config`` may have ``enabled_checks`` (an array of families); a stream
    whose event day is told by nothing has no completeness check.
    """
    unknown = set(families) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}")
    named = lambda family: F.concat_ws("_", *STREAM, "reader", F.lit(family)).alias("check_name")
    row = lambda family, found, severity=WARN: [named(family), "passed", (F.lit(severity) if severity in (ERROR, WARN) else F.col(severity)).alias("severity"), found.cast("bigint").alias("found")]
    wants = lambda family: config.where(F.array_contains("enabled_checks", family)) if "enabled_checks" in config.columns else config
    parts = []
    if "freshness" in families:
        fresh = freshness(payloads, wants("freshness"), now_ms).join(wants("freshness").select(*STREAM, "reader"), STREAM)
        parts.append(fresh.select(*row("freshness", F.ceil("lag_hours"), ERROR)))
    if "completeness" in families:
        timed = wants("completeness").where(F.col("event_date_source") != "none")
        whole = timed.select(*STREAM, "reader").join(event_completeness(payloads, timed), [*STREAM, "reader"], "left").fillna(True, ["passed"]).fillna(0, ["missing"])
        parts.append(whole.select(*row("completeness", F.col("missing"))))
    if "schema" in families:
        drift = drift_between(signatures(payloads, wants("schema")), baseline, [*STREAM, "reader"])
        parts.append(drift.select(*row("schema", F.size("added") + F.size("removed"), ERROR)))
    if "content" in families:
        parts.append(content_health(payloads, wants("content")).select(*row("content_health", F.col("issues") + F.col("errors") + F.col("empty"), "severity")))
    return reduce(DataFrame.unionByName, parts)


def first_details(df: DataFrame, by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` findings in order, for a message: a top-k, its size is the feature."""
    return df.orderBy(*by).limit(n)


def join_sanity(nights: DataFrame, since: str = "2025-12-18") -> DataFrame:
    """Nights of neither source (they fail the check), and nights from ``since`` on that only one source has (a hint)."""
    lone = (F.col("night_date") >= F.lit(since).cast("date")) & (F.col("has_garmin") != F.col("has_whoop"))
    got = nights.agg(F.count_if(~(F.col("has_garmin") | F.col("has_whoop"))).alias("found"), F.count_if(lone).alias("single_source"))
    return got.select(F.lit("sleep_join_sanity").alias("check_name"), (F.col("found") == 0).alias("passed"), F.lit(WARN).alias("severity"), "found", "single_source")


# What kind of fault each finding is.
KINDS = {"HASH_MISMATCH": "INTEGRITY", "ZERO_BYTES": "VALIDITY", "NOT_JSON": "VALIDITY", "MISSING_SIDECAR": "CONSISTENCY", "NO_HASH": "CONSISTENCY", "SIZE_MISMATCH": "CONSISTENCY", "REDACTED": "INFORMATION"}


def integrity(captures: DataFrame) -> DataFrame:
    """``(path, source_name, collection_name, dt, issue, kind)`` of captures whose bytes do not agree with their sidecar, that lack one, are empty or no JSON; a redaction is information only."""
    text = F.col("content").cast("string")
    as_json = F.coalesce(F.lower("stored_encoding") == "identity", F.lit(True)) & (F.endswith("path", F.lit(".json")) | F.coalesce(F.contains(F.lower("content_type"), F.lit("json")), F.lit(False)))
    redacted = F.size("redacted_fields") > 0 if "redacted_fields" in captures.columns else F.lit(False)
    issue = F.array_compact(
        F.array(
            F.when(~F.col("has_sidecar"), "MISSING_SIDECAR"),
            F.when(F.octet_length("content") == 0, "ZERO_BYTES"),
            F.when(F.col("sha256").isNotNull() & (F.col("sha256") != F.sha2("content", 256)), "HASH_MISMATCH"),
            F.when(F.col("has_sidecar") & F.col("sha256").isNull(), "NO_HASH"),
            F.when(F.col("byte_size").isNotNull() & (F.col("byte_size") != F.octet_length("content")), "SIZE_MISMATCH"),
            F.when(as_json & (F.octet_length("content") > 0) & F.json_object_keys(text).isNull() & F.json_array_length(text).isNull(), "NOT_JSON"),
            F.when(redacted, "REDACTED"),
        )
    )
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return captures.select("path", *STREAM, "dt", F.explode(issue).alias("issue")).withColumn("kind", F.try_element_at(kinds, "issue"))


def verify_tree(captures: DataFrame, report: str, max_gap: int = 0) -> int:
    """Write the inventory, the findings and the gaps of all streams below ``report``; 1 if any finding is more than information, else 0.

    The report is three tables of JSON lines; findings may be as many as files
    and are never gathered on the driver. A gap is more than ``max_gap`` absent
    days between two partitions.
    """
    inventory(captures).write.mode("overwrite").json(f"{report}/inventory")
    found = integrity(captures)
    found.write.mode("overwrite").json(f"{report}/findings")
    date_gaps(captures, "dt", STREAM, max_gap + 1).write.mode("overwrite").json(f"{report}/gaps")
    return 0 if found.where(F.col("kind") != "INFORMATION").isEmpty() else 1


def inventory(captures: DataFrame) -> DataFrame:
    """Files, bytes and span of each stream."""
    return captures.groupBy("source_name", "collection_name").agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("content")).alias("bytes"), F.min("dt").alias("first_day"), F.max("dt").alias("last_day"))


def alerts(results: DataFrame) -> DataFrame:
    """Failing results of severity ERROR."""
    return results.where(~F.col("passed") & (F.col("severity") == ERROR))


def select_allowed(df: DataFrame, name: str, allow: DataFrame | None, deny: DataFrame | None) -> DataFrame:
    """Rows whose name is allowed (no or an empty list allows all) and not denied."""
    out = df
    if deny is not None:
        out = out.join(deny.select(name).distinct(), name, "left_anti")
    if allow is not None and not allow.isEmpty():
        out = out.join(allow.select(name).distinct(), name, "left_semi")
    return out
