"""Queries of the general data problems (p1 to p7) on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import clean_station, iso_day, millis_of_ntz, valid_zone
from ..operators import drift, instants, intervals, message_index, outliers, rolling, shredding


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def stations_of(spark: SparkSession, d: str) -> DataFrame:
    """Clean id, zone and date order of each station.

    Joined without a hint: the list has a few dozen rows, and Spark broadcasts
    it by its measured size, or shuffles should it ever be large.
    """
    s = table(spark, d, "stations").select(F.col("wbanno").alias("__station"), F.col("tz_name").alias("__tz"), (F.col("date_order") == "MDY").alias("__mdy"))
    return s.dropDuplicates(["__station"])


def weather_with_station(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    w = table(spark, d, "silver_weather").select("wbanno", *columns)
    return w.join(stations_of(spark, d), clean_station(w["wbanno"]) == F.col("__station"), "left")


def weather_days(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Weather rows with ``day``: the calendar day their local day denotes, null where it cannot be read."""
    w = weather_with_station(spark, d, *columns, "obs_date_local")
    w = instants.add_day(w, "day", F.col("obs_date_local"), F.col("__mdy"), F.col("__tz")).withColumn("__fence", F.spark_partition_id())
    return w.select(F.when(F.col("__fence") >= 0, F.col("day")).alias("day"), *columns)  # filters on the day stay above its parsing


# The same in SQL: the station id with stray characters and lost zeros mended, then every spelling of a day or instant.
_STATION_SQL = "CASE WHEN regexp_replace(regexp_replace(wbanno, '\\.0*\\s*$', ''), '\\D', '', 'g') <> '' THEN lpad(regexp_replace(regexp_replace(wbanno, '\\.0*\\s*$', ''), '\\D', '', 'g'), CAST(greatest(5, length(regexp_replace(regexp_replace(wbanno, '\\.0*\\s*$', ''), '\\D', '', 'g'))) AS INTEGER), '0') END"
_AT_SQL = "CASE WHEN regexp_full_match(t, '\\d{13}') THEN epoch_ms(CAST(t AS BIGINT)) WHEN regexp_full_match(t, '\\d{10}') THEN epoch_ms(CAST(t AS BIGINT) * 1000) WHEN regexp_matches(t, '^\\d{4}-\\d\\d-\\d\\dT.*(Z|[+-]\\d\\d:\\d\\d)$') THEN timezone('UTC', TRY_CAST(t AS TIMESTAMPTZ)) END"
_DAY_SQL = """CASE WHEN regexp_full_match(t, '\\d{4}-\\d\\d-\\d\\d') THEN TRY_CAST(t AS DATE) WHEN moment IS NOT NULL THEN CAST(timezone(coalesce(tz_name, 'UTC'), timezone('UTC', moment)) AS DATE) WHEN regexp_full_match(t, '\\d{8}') THEN CAST(try_strptime(t, '%Y%m%d') AS DATE)
WHEN regexp_full_match(t, '\\d\\d/\\d\\d/\\d{4}') THEN CAST(CASE WHEN mdy THEN try_strptime(t, '%m/%d/%Y') ELSE try_strptime(t, '%d/%m/%Y') END AS DATE) WHEN regexp_full_match(t, '\\d\\d/\\d\\d/\\d\\d') THEN CAST(CASE WHEN mdy THEN try_strptime(t, '%m/%d/%y') ELSE try_strptime(t, '%d/%m/%y') END AS DATE)
WHEN regexp_full_match(t, '\\d{4}/\\d\\d/\\d\\d') THEN CAST(try_strptime(t, '%Y/%m/%d') AS DATE) WHEN regexp_full_match(t, '\\d{4}-\\d\\d-\\d\\d[T ]\\d\\d:\\d\\d:\\d\\d') THEN TRY_CAST(substr(t, 1, 10) AS DATE) WHEN regexp_full_match(t, '\\d{4}-\\d{3}') THEN CAST(try_strptime(t, '%Y-%j') AS DATE)
ELSE CAST(coalesce(try_strptime(t, '%a, %d %b %Y'), try_strptime(t, '%b %d, %Y'), try_strptime(t, '%d %b %Y')) AS DATE) END"""
LOCAL_DAY_SQL = f"""SELECT row_id, logger_no, station, obs_seq, fetched_ms, obs_date_local, {_DAY_SQL} AS day FROM (SELECT *, {_AT_SQL} AS moment FROM (SELECT w.row_id, w.logger_no, w.obs_seq, w.fetched_ms, w.obs_date_local, trim(w.obs_date_local) AS t, {_STATION_SQL} AS station, tz_name, date_order = 'MDY' AS mdy
FROM silver_weather w LEFT JOIN stations s ON s.wbanno = {_STATION_SQL.replace('wbanno', 'w.wbanno')}))""".replace(f"{_STATION_SQL} AS station", f"{_STATION_SQL.replace('wbanno', 'w.wbanno')} AS station")


def us_locale() -> Column:
    return F.col("locale") == "en-US"


def ingestion_month() -> Column:
    """Months since 1970 of the time a row was fetched: every row has it, whatever its own clock says."""
    at = F.timestamp_add("MICROSECOND", F.col("fetched_ms") * 1000, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.year(at) * 12 + F.month(at) - 1


def logger_zone_history(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """The zone of each logger's clock per month, from rows that have both an instant and a plain local day.

    ``rows`` has ``logger_no, obs_ts_utc, obs_date_local, obs_seq, fetched_ms``.
    A row tells an offset: from its instant to the hour its local day and place
    in it make. Rows are counted per logger, month, UTC day and offset before
    any zone is tried, and a zone is violated by those it puts into another hour
    of that day (on the two days a year the clock changes the true zone is too),
    and by rows fetched before they were observed.
    """
    zones = table(spark, d, "stations").select(valid_zone(F.col("tz_name")).alias("zone")).where(F.col("zone").isNotNull()).distinct()
    known = rows.where(F.col("obs_ts_utc").isNotNull() & F.col("obs_seq").isNotNull() & F.col("obs_date_local").rlike(instants.NORMAL_DAY)).withColumn("__day", F.col("obs_date_local").try_cast("date")).where(F.col("__day").isNotNull())
    shift = F.timestamp_diff("MINUTE", F.col("obs_ts_utc"), F.col("__day").cast("timestamp_ntz")) + F.col("obs_seq") * 60
    early = F.coalesce(millis_of_ntz(F.col("obs_ts_utc")) > F.col("fetched_ms"), F.lit(False))
    counted = known.groupBy("logger_no", ingestion_month().alias("__month"), F.to_date("obs_ts_utc").alias("__on"), F.when(~early, shift).alias("__shift")).agg(F.count(F.lit(1)).alias("__n"))
    noon = F.col("__on").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR")
    has = F.timestamp_diff("MINUTE", noon, F.convert_timezone(F.lit("UTC"), F.col("zone"), noon))
    evidence = instants.count_zone_violations(counted, "logger_no", F.col("__month"), zones, ~F.coalesce((has - F.col("__shift")).between(0, 59), F.lit(False)), F.col("__n"))
    return instants.estimate_zone_history(evidence)


def p1_zone_history(spark: SparkSession, d: str) -> DataFrame:
    """Estimated zone of every logger per month, with the rows seen and those that violate it."""
    rows = table(spark, d, "silver_weather").select("logger_no", "obs_ts_utc", "obs_date_local", "obs_seq", "fetched_ms")
    return logger_zone_history(spark, d, rows).select(F.col("entity").alias("logger_no"), F.col("period").alias("month_no"), "zone", "seen", "bad")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every day or instant of the three text fields that is not yet in normal form.

    The zone of a clock is the declared one (an end's ``tz_name``, or UTC as
    TESTDATA.md says; a station's). Where a weather row's station is not listed,
    its logger's estimated history stands in.
    """
    sleep = table(spark, d, "silver_sleep").select("row_id", "night_date", "garmin_end_gmt", "tz_name", "locale")
    weather = weather_with_station(spark, d, "row_id", "obs_date_local", "logger_no", "obs_ts_utc", "obs_seq", "fetched_ms")
    nights = instants.normalise_days(sleep, "row_id", "night_date", "silver_sleep.night_date", us_locale())
    ends = instants.normalise_instants(sleep, "row_id", "garmin_end_gmt", "silver_sleep.garmin_end_gmt", us_locale(), F.col("tz_name"))
    days = instants.normalise_days(weather.where(F.col("__station").isNotNull()), "row_id", "obs_date_local", "silver_weather.obs_date_local", F.col("__mdy"), F.col("__tz"))
    lost = weather.where(F.col("__station").isNull())
    history = logger_zone_history(spark, d, lost).select(F.col("entity").alias("__logger"), F.col("period").alias("__month"), F.col("zone").alias("__zone"))
    placed = lost.join(history, (lost["logger_no"] == F.col("__logger")) & (ingestion_month() == F.col("__month")), "left")
    lost_days = instants.normalise_days(placed, "row_id", "obs_date_local", "silver_weather.obs_date_local", F.lit(None).cast("boolean"), F.col("__zone"))
    return nights.unionByName(ends).unionByName(days).unionByName(lost_days)


ACTIVITY, WINDOWS = ["steps", "workout_total_min"], [7, 30]


def p2_rolling_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals and averages of both activity fields over 7 and 30 days, per wearer and calendar day."""
    g = table(spark, d, "gold_daily_wellness").select("row_id", "wearer_id", "day", "built_at", *ACTIVITY)
    return rolling.rolling_totals(g, "wearer_id", "day", ACTIVITY, WINDOWS, [F.col("built_at"), F.col("row_id")])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Per wearer, month, field and window the days with the greatest total."""
    best = rolling.greatest_days(p2_rolling_totals(spark, d), ACTIVITY, WINDOWS)
    return best.select(F.col("entity").alias("wearer_id"), iso_day(F.col("day")).alias("day_iso"), "field_name", "window_days")


WEATHER_LIMITS = {
    # Physical bounds: no global radiation below zero or above the sun's own; no ground colder or hotter than ever measured; a share of volume.
    "solar_rad_wm2": outliers.Limits(0.0, 1500.0, fence=(0.2, 0.15), idle=0.0),
    "surface_temp_max_c": outliers.Limits(-75.0, 85.0, excursions=True),
    "soil_moisture_5": outliers.Limits(0.0, 1.0, excursions=True),
}


def observation_hours(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Weather rows with ``hour``: whole hours since 1970, from the instant or else the local day, its count of hours and the station's zone."""
    w = weather_with_station(spark, d, "obs_ts_utc", "obs_date_local", "obs_seq", *columns)
    w = instants.add_day(w, "__day", F.when(F.col("obs_ts_utc").isNull(), F.col("obs_date_local")), F.col("__mdy"), F.col("__tz"))
    midnight = F.convert_timezone(F.coalesce(valid_zone(F.col("__tz")), F.lit("UTC")), F.lit("UTC"), F.col("__day").cast("timestamp_ntz"))
    begun = F.ceil(millis_of_ntz(midnight) / 3_600_000) + F.col("obs_seq")
    return w.select(F.coalesce(F.floor(millis_of_ntz(F.col("obs_ts_utc")) / 3_600_000), begun).cast("long").alias("hour"), *columns)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """False readings of three weather fields, judged by what the logger normally shows."""
    rows = observation_hours(spark, d, "row_id", "logger_no", *WEATHER_LIMITS)
    return outliers.find_false_readings(rows.withColumnRenamed("logger_no", "source"), WEATHER_LIMITS)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every parent-child link of the readable payloads."""
    return shredding.links(table(spark, d, "bronze_payloads"))


def p4_tables(spark: SparkSession, d: str) -> DataFrame:
    """All rows of the flat tables shredded from the payloads, with their leaves."""
    return shredding.flat_rows(table(spark, d, "bronze_payloads"))


def clean_uuid(text: Column) -> Column:
    """32 lower-case hex digits of a UUID however spelled; null if it is none."""
    digits = F.regexp_replace(F.lower(F.regexp_replace(F.trim(text), r"^(?i)urn:uuid:", "")), r"[{}\s-]", "")
    return F.when(digits.rlike("^[0-9a-f]{32}$"), digits)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Surplus deliveries of sleeps and of hourly weather messages."""
    sleep = table(spark, d, "silver_sleep_whoop").select("row_id", "fetched_ms", "batch_id", *message_index.identity_hashes(clean_uuid(F.col("whoop_sleep_id"))))
    weather = weather_with_station(spark, d, "row_id", "fetched_ms", "batch_id", "logger_no", "obs_seq", "obs_date_local")
    weather = instants.add_day(weather, "__day", F.col("obs_date_local"), F.col("__mdy"), F.col("__tz"))
    station = F.coalesce(F.col("__station"), clean_station(F.col("wbanno")))
    weather = weather.select("row_id", "fetched_ms", "batch_id", *message_index.identity_hashes(station, F.col("logger_no"), F.datediff("__day", F.lit("2000-01-01").cast("date")), F.col("obs_seq")))
    found = []
    for name, messages in (("silver_sleep_whoop", sleep), ("silver_weather", weather)):
        found.append(message_index.surplus_deliveries(messages, name, "batch_id").select(F.lit(name).alias("table_name"), "row_id"))
    return found[0].unionByName(found[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of schema from one file of a feed to the next."""
    return drift.schema_changes(table(spark, d, "capture_files"))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    """All export files read into one consistent table: each by its feed's version, with defaults and one type per field."""
    return drift.routed_table(table(spark, d, "capture_files"))


def sleep_intervals(spark: SparkSession, d: str) -> DataFrame:
    """All rows of both sleep tables as ``(entity, begin_ms, finish_ms, is_kind)``, a nap being the kind."""
    garmin = table(spark, d, "silver_sleep").select("wearer_id", "garmin_start_gmt", "garmin_end_gmt", "tz_name", "locale").where(F.col("garmin_start_gmt").isNotNull())
    garmin = instants.add_instant(garmin, "__end", F.col("garmin_end_gmt"), us_locale(), F.col("tz_name")).withColumn("__fence", F.spark_partition_id())
    whoop = table(spark, d, "silver_sleep_whoop").select(F.col("wearer_id").alias("entity"), millis_of_ntz(F.col("whoop_start")).alias("begin_ms"), millis_of_ntz(F.col("whoop_end")).alias("finish_ms"), F.col("is_nap").alias("is_kind"))
    return garmin.select(F.col("wearer_id").alias("entity"), millis_of_ntz(F.col("garmin_start_gmt")).alias("begin_ms"), F.when(F.col("__fence") >= 0, millis_of_ntz(F.col("__end"))).alias("finish_ms"), F.lit(False).alias("is_kind")).unionByName(whoop)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods of sleep and the gaps between them, per wearer."""
    merged = intervals.periods_and_gaps(sleep_intervals(spark, d), "nap", "sleep")
    return merged.select(F.col("entity").alias("wearer_id"), "period_kind", F.col("begin_ms").alias("begin_utc_ms"), F.col("finish_ms").alias("finish_utc_ms"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_zone_history, p2_found, p2_rolling_totals, p3_found, p4_found, p4_tables, p5_found, p6_found, p6_table, p7_found)}


_LATEST = "SELECT wearer_id, day, steps, workout_total_min FROM gold_daily_wellness WHERE wearer_id IS NOT NULL AND day IS NOT NULL QUALIFY row_number() OVER (PARTITION BY wearer_id, day ORDER BY built_at DESC NULLS LAST, row_id DESC) = 1"
_DAYS = f"""WITH latest AS ({_LATEST}), spine AS (SELECT wearer_id, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM latest GROUP BY wearer_id),
filled AS (SELECT wearer_id, day, coalesce(steps, 0)::DOUBLE AS steps, coalesce(workout_total_min, 0.0) AS workout_total_min FROM spine LEFT JOIN latest USING (wearer_id, day)),
totals AS (SELECT wearer_id, day, {', '.join(f'sum({v}) OVER (PARTITION BY wearer_id ORDER BY day ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS {v}_{w}_total' for v in ACTIVITY for w in WINDOWS)},
row_number() OVER (PARTITION BY wearer_id ORDER BY day) AS k FROM filled)"""


# Sleeps as SQL reads them: the end's instant, or its wall clock by the row's zone, the earlier of two and none that the clock leaves out.
_END_T = "regexp_replace(regexp_replace(regexp_replace(trim(garmin_end_gmt), '\\[[^\\]]*\\]$', ''), ' ?(GMT|UTC)$', 'Z'), '^(\\d{4}-.*[+-]\\d\\d)(\\d\\d)$', '\\1:\\2')"
_END_AT = """CASE WHEN regexp_full_match(t, '\\d{13}') THEN make_timestamp(CAST(t AS BIGINT) * 1000) WHEN regexp_full_match(t, '\\d{10}') THEN make_timestamp(CAST(t AS BIGINT) * 1000000) WHEN regexp_full_match(t, '\\d{16}') THEN make_timestamp(CAST(t AS BIGINT)) WHEN regexp_full_match(t, '\\d\\.\\d+E\\d+') THEN make_timestamp(CAST(CAST(t AS DOUBLE) AS BIGINT) * 1000)
WHEN regexp_matches(t, '^\\d{4}-\\d\\d-\\d\\d[T ].*(Z|[+-]\\d\\d:\\d\\d)$') THEN timezone('UTC', TRY_CAST(t AS TIMESTAMPTZ)) WHEN regexp_full_match(t, '\\d{8}T\\d{6}Z') THEN try_strptime(t, '%Y%m%dT%H%M%SZ') WHEN regexp_matches(t, '^[A-Z][a-z]{2}, .*[+-]\\d{4}$') THEN timezone('UTC', try_strptime(t, '%a, %d %b %Y %H:%M:%S %z')) END"""
_END_WALL = """CASE WHEN regexp_matches(t, '^\\d{4}-\\d\\d-\\d\\d[T ]\\d\\d:\\d\\d(:\\d\\d)?$') THEN coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y-%m-%dT%H:%M:%S'), try_strptime(t, '%Y-%m-%dT%H:%M')) WHEN regexp_matches(t, '^\\d\\d/') THEN CASE WHEN us THEN coalesce(try_strptime(t, '%m/%d/%Y %H:%M:%S'), try_strptime(t, '%m/%d/%Y %I:%M %p')) ELSE coalesce(try_strptime(t, '%d/%m/%Y %H:%M:%S'), try_strptime(t, '%d/%m/%Y %I:%M %p')) END
WHEN regexp_matches(t, '^\\d{1,2}\\.\\d{1,2}\\.\\d{4} ') THEN CASE WHEN us THEN try_strptime(t, '%m.%d.%Y %H:%M') ELSE try_strptime(t, '%d.%m.%Y %H:%M') END WHEN regexp_matches(t, '^[A-Z][a-z]{2} \\d') THEN try_strptime(t, '%b %d, %Y %I:%M:%S %p') END"""
_SLEEPS = f"""SELECT wearer_id, epoch_us(garmin_start_gmt) // 1000 AS b, epoch_us(coalesce(moment, CASE WHEN timezone(zone, timezone('UTC', late - INTERVAL 1 HOUR)) = wall THEN late - INTERVAL 1 HOUR WHEN timezone(zone, timezone('UTC', late)) = wall THEN late END)) // 1000 AS f, false AS nap
FROM (SELECT *, timezone('UTC', timezone(zone, wall)) AS late FROM (SELECT *, {_END_AT} AS moment, {_END_WALL} AS wall, coalesce(tz_name, 'UTC') AS zone FROM (SELECT *, {_END_T} AS t, coalesce(locale = 'en-US', false) AS us FROM silver_sleep)))
UNION ALL SELECT wearer_id, epoch_us(whoop_start) // 1000, epoch_us(whoop_end) // 1000, coalesce(is_nap, false) FROM silver_sleep_whoop"""
_P7 = f"""WITH i AS (SELECT wearer_id, b, f, bool_and(nap) AS nap FROM ({_SLEEPS}) WHERE wearer_id IS NOT NULL AND f > b GROUP BY 1, 2, 3), m AS (SELECT *, max(f) OVER (PARTITION BY wearer_id ORDER BY b, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR b > reach THEN 1 ELSE 0 END) OVER (PARTITION BY wearer_id ORDER BY b, f ROWS UNBOUNDED PRECEDING) AS k FROM m),
p AS (SELECT wearer_id, min(b) AS b, max(f) AS f, bool_and(nap) AS nap FROM g GROUP BY wearer_id, k), n AS (SELECT *, lead(b) OVER (PARTITION BY wearer_id ORDER BY b) AS nb FROM p)
SELECT wearer_id, CASE WHEN nap THEN 'nap' ELSE 'sleep' END AS period_kind, b AS begin_utc_ms, f AS finish_utc_ms FROM p UNION ALL SELECT wearer_id, 'gap', f, nb FROM n WHERE nb IS NOT NULL"""

_UUID_SQL = "regexp_replace(lower(regexp_replace(trim(whoop_sleep_id), '^(?i)urn:uuid:', '')), '[{}\\s-]', '', 'g')"
_SURPLUS = "QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY fetched_ms DESC NULLS LAST, row_id) > 1"
_P5 = f"""SELECT 'silver_sleep_whoop' AS table_name, row_id FROM (SELECT row_id, fetched_ms, {_UUID_SQL} AS u FROM silver_sleep_whoop) WHERE regexp_full_match(u, '[0-9a-f]{{32}}') {_SURPLUS.format(k='u')}
UNION ALL SELECT 'silver_weather', row_id FROM ({LOCAL_DAY_SQL}) WHERE station IS NOT NULL AND logger_no IS NOT NULL AND day IS NOT NULL AND obs_seq IS NOT NULL {_SURPLUS.format(k='station, logger_no, day, obs_seq')}"""

_JSON_LIST = "CASE json_type({x}) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) WHEN 'OBJECT' THEN [{x}] END"
_READABLE = "SELECT payload_id, CASE WHEN json_type(body) = 'VARCHAR' THEN TRY_CAST(body::JSON->>'$' AS JSON) ELSE body::JSON END AS b FROM bronze_payloads WHERE collection_name = '{c}' AND json_valid(body)"
_P4 = f"""WITH pages AS ({_READABLE.format(c='sleep')}), recs AS (SELECT payload_id, unnest(CASE WHEN json_type(b) = 'ARRAY' THEN CAST(b AS JSON[]) WHEN json_type(b, '$.id') IS NOT NULL AND json_type(b, '$.records') IS NULL THEN [b] ELSE coalesce({_JSON_LIST.format(x="json_extract(b, '$.records')")}, {_JSON_LIST.format(x="json_extract(b, '$.data.records')")}) END) AS a FROM pages),
r AS (SELECT payload_id, a, a->>'$.id' AS id FROM recs WHERE a->>'$.id' IS NOT NULL), seg AS (SELECT payload_id, id, len({_JSON_LIST.format(x="json_extract(a, '$.score.stage_summary.segments')")}) AS n FROM r),
stat AS (SELECT payload_id, coalesce(json_extract(b, '$.mostRecentTrainingStatus.latestTrainingStatusData'), json_extract(b, '$.latestTrainingStatusData')) AS d FROM ({_READABLE.format(c='training_status')})),
dev AS (SELECT payload_id, CASE WHEN json_type(d) = 'ARRAY' THEN list_transform(CAST(d AS JSON[]), lambda x: {{'k': NULL::VARCHAR, 'v': x}}) WHEN json_type(d) = 'OBJECT' AND len(list_intersect(json_keys(d), ['deviceId', 'trainingStatus', 'loadDays', 'acuteTrainingLoadDTO', 'calendarDate'])) > 0 THEN [{{'k': NULL::VARCHAR, 'v': d}}] WHEN json_type(d) = 'OBJECT' THEN list_transform(json_keys(d), lambda x: {{'k': x, 'v': json_extract(d, '$."' || x || '"')}}) END AS l FROM stat),
dv AS (SELECT payload_id, u.v AS v, coalesce(u.v->>'$.deviceId', u.k) AS id FROM (SELECT payload_id, unnest(l) AS u FROM dev)), dk AS (SELECT * FROM dv WHERE id IS NOT NULL AND json_type(v) = 'OBJECT'),
days AS (SELECT payload_id, id, unnest(coalesce({_JSON_LIST.format(x="json_extract(v, '$.acuteTrainingLoadDTO.loadDays')")}, {_JSON_LIST.format(x="json_extract(v, '$.loadDays')")})) AS y FROM dk)
SELECT DISTINCT * FROM (SELECT payload_id, 'sleep' AS link_kind, payload_id::VARCHAR AS parent_key, id AS child_key FROM r UNION ALL SELECT payload_id, 'scored_sleep', payload_id::VARCHAR, id FROM r WHERE coalesce(a->>'$.score.sleep_performance_percentage', a->>'$.score.performance.percentage') IS NOT NULL
UNION ALL SELECT payload_id, 'segment', id, unnest(generate_series(0, n - 1))::VARCHAR FROM seg WHERE n > 0 UNION ALL SELECT payload_id, 'device', payload_id::VARCHAR, id FROM dk UNION ALL SELECT payload_id, 'coded_device', payload_id::VARCHAR, id FROM dk WHERE v->>'$.trainingStatus' IS NOT NULL UNION ALL SELECT payload_id, 'load_day', id, y->>'$.calendarDate' FROM days WHERE y->>'$.calendarDate' IS NOT NULL)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the others are tested against brute force."""
    best = " UNION ALL ".join(
        f"SELECT wearer_id, strftime(day, '%Y-%m-%d') AS day_iso, '{v}' AS field_name, {w} AS window_days FROM totals WHERE {v}_{w}_total > 0 QUALIFY {v}_{w}_total = max({v}_{w}_total) OVER (PARTITION BY wearer_id, date_trunc('month', day))" for v in ACTIVITY for w in WINDOWS
    )
    wide = ", ".join(f"{v}_{w}_total, {v}_{w}_total / least(k, {w}) AS {v}_{w}_avg" for v in ACTIVITY for w in WINDOWS)
    return {"p4_found": _P4, "p5_found": _P5, "p7_found": _P7, "p2_found": f"{_DAYS} {best}", "p2_rolling_totals": f"{_DAYS} SELECT wearer_id AS entity, day, CAST(date_trunc('month', day) AS DATE) AS month, {wide} FROM totals"}
