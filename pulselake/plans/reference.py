"""One query per relational operator on the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..marts import gold
from ..operators import relational as R
from ..quality import checks as Q
from ..sources import files
from .general import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def r4(c: Column | str) -> Column:
    """Four decimals: sums of doubles depend on the order of their parts."""
    return F.round(c, 4)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def day_of(ts: str = "ts") -> Column:
    return F.to_date(ts).alias("day")


SQL_K = "json_extract_string(props, '$.k')"


# Latest record per key


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedup_latest_event_per_user(s: SparkSession, d: str) -> DataFrame:
    return R.dedup_latest(table(s, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedup_latest_composite_key(s: SparkSession, d: str) -> DataFrame:
    return R.dedup_latest(table(s, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_id, value FROM events WHERE value > 50 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedup_value_bearing_first(s: SparkSession, d: str) -> DataFrame:
    return R.dedup_latest(table(s, d, "events").where(F.col("value") > 50), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


_LI = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _LI)}) = 1")
def dedup_lineitem_tiebreak(s: SparkSession, d: str) -> DataFrame:
    return R.dedup_latest(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], _LI).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


# JSON


@query(f"SELECT event_id, TRY_CAST({SQL_K} AS DOUBLE) AS k FROM events")
def json_extract_num(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", E.json_num(F.col("props"), "k").alias("k"))


@query("SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.none.at.all')) AS present FROM events GROUP BY event_type")
def json_extract_missing(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(E.json_str(F.col("props"), "none.at.all")).alias("present"))


@query("SELECT event_id, CAST(sign(value) * floor(abs(value) + 0.5) AS INTEGER) AS whole, CAST(event_id // 4 + CASE WHEN event_id % 4 >= 2 THEN 1 ELSE 0 END AS INTEGER) AS quarter FROM events")
def json_int_rounding(s: SparkSession, d: str) -> DataFrame:
    """Fractions of every kind, exact halves among them, round away from zero."""
    e = table(s, d, "events")
    return e.select("event_id", E.json_int(F.to_json(F.struct("value")), "value").alias("whole"), E.json_int(F.to_json(F.struct((F.col("event_id") / 4).alias("q"))), "q").alias("quarter"))


@query("SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'true' WHEN event_id % 3 = 1 THEN 'false' END AS BOOLEAN), false) AS flag FROM events")
def json_bool_default(s: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("event_id") % 3 == 0, True).when(F.col("event_id") % 3 == 1, False)
    return table(s, d, "events").select("event_id", E.json_bool(F.to_json(F.struct(flag.alias("f"))), "f").alias("flag"))


@query("SELECT o_custkey, o_orderkey FROM orders")
def json_array_explode(s: SparkSession, d: str) -> DataFrame:
    per = table(s, d, "orders").groupBy("o_custkey", F.col("o_orderkey") % 16).agg(F.to_json(F.collect_list("o_orderkey")).alias("j"))
    return R.explode_records(per, E.json_array(F.col("j")), "a").select("o_custkey", E.exact_int(F.col("a"), "bigint").alias("o_orderkey"))


@query("SELECT payload_id, a->>'$.id' AS id FROM (SELECT payload_id, unnest(CAST(body AS JSON[])) AS a FROM bronze_payloads WHERE json_valid(body) AND json_type(body) = 'ARRAY')")
def json_array_explode_guarded(s: SparkSession, d: str) -> DataFrame:
    """Elements of payloads that are an array; objects, strings and broken bodies give none."""
    p = table(s, d, "bronze_payloads").select("payload_id", "body")
    return R.explode_records(p, E.json_array(F.when(F.json_array_length("body").isNotNull(), F.col("body"))), "a").select("payload_id", E.json_str(F.col("a"), "id").alias("id"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def json_child_with_parent_id(s: SparkSession, d: str) -> DataFrame:
    laps = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.struct(F.col("l_orderkey").alias("id"), F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"))).alias("laps"))).alias("j"))
    a = F.col("a")
    return laps.select(E.json_int(F.col("j"), "id", "bigint").alias("l_orderkey"), F.explode(E.json_array(F.col("j"), "laps")).alias("a")).select("l_orderkey", E.json_int(a, "n").alias("l_linenumber"), E.json_num(a, "q").alias("l_quantity"))


@query("SELECT event_id, CAST(event_id AS VARCHAR) AS first_value FROM events")
def json_first_dynamic_key(s: SparkSession, d: str) -> DataFrame:
    j = F.concat(F.lit('{"z'), F.col("event_id") % 7, F.lit('":'), F.col("event_id"), F.lit(',"a":1}'))
    return table(s, d, "events").select("event_id", E.first_map_value(j).alias("first_value"))


@query("SELECT array_to_string(list_sort(json_keys(props)), ',') AS signature, count(*) AS n FROM events GROUP BY 1")
def json_keys_signature(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy(F.array_join(E.key_signature(F.col("props")), ",").alias("signature")).agg(F.count(F.lit(1)).alias("n"))


def _classified_bodies() -> list[tuple[str, str]]:
    """Bodies and what they are, with every key that tells data, paging or an error."""
    made = [("[]", "EMPTY_LIST"), ("[1]", "DATA"), ("{}", "EMPTY_OBJECT"), ("", "EMPTY_FILE"), ("null", "EMPTY_FILE"), ('{"a":', "UNPARSEABLE"), ("  ", "UNPARSEABLE"), ("12.5", "DATA"), ("true", "DATA"), ('"text"', "DATA"), ('{"message":"x","status_code":500}', "DATA"), ('{"total":0}', "DATA")]
    for k in ("records", "data", "items", "results", "activities"):
        made += [(f'{{"{k}":[]}}', "EMPTY_WRAPPER"), (f'{{"{k}":[],"user":1}}', "DATA"), (f'{{"{k}":[],"total":0}}', "DATA"), (f'{{"{k}":[1],"error":"x"}}', "DATA"), (f'{{"{k}":null}}', "DATA")]
        made += [(f'{{"{k}":[],"{p}":null}}', "EMPTY_WRAPPER") for p in ("next_token", "nextToken", "next", "paging")]
    for k in ("error", "errors", "fault", "exception"):
        made += [(f'{{"{k}":"x"}}', "ERROR_LIKE"), (f'{{"{k.upper()}":"x","records":[]}}', "ERROR_LIKE"), (f'{{"{k}s_of":"x"}}', "DATA")]
    return made


_CASES = _classified_bodies()


@query(f"SELECT event_id, (CAST({[v for _, v in _CASES]} AS VARCHAR[]))[CAST(event_id % {len(_CASES)} AS INTEGER) + 1] AS verdict FROM events")
def payload_classify(s: SparkSession, d: str) -> DataFrame:
    body = F.get(F.array(*[F.lit(b) for b, _ in _CASES]), (F.col("event_id") % len(_CASES)).cast("int"))
    return table(s, d, "events").select("event_id", body.alias("j")).select("event_id", E.classify_json(F.col("j")).alias("verdict"))


_CLASS_SQL = f"""CASE WHEN coalesce(body, '') = '' OR trim(body) = 'null' THEN 'EMPTY_FILE' WHEN NOT json_valid(body) THEN 'UNPARSEABLE' WHEN json_type(body) = 'ARRAY' THEN CASE WHEN json_array_length(body) = 0 THEN 'EMPTY_LIST' ELSE 'DATA' END WHEN json_type(body) <> 'OBJECT' THEN 'DATA'
WHEN len(json_keys(body)) = 0 THEN 'EMPTY_OBJECT' WHEN {' OR '.join(f"(json_type(body, '$.{k}') = 'ARRAY' AND json_array_length(body, '$.{k}') = 0 AND len(list_filter(json_keys(body), lambda x: x NOT IN ('{k}', 'next_token', 'nextToken', 'next', 'paging'))) = 0)" for k in E.DATA_KEYS)} THEN 'EMPTY_WRAPPER'
WHEN len(list_filter(json_keys(body), lambda x: lower(x) IN ('error', 'errors', 'fault', 'exception'))) > 0 AND NOT ({' OR '.join(f"coalesce(json_type(body, '$.{k}') = 'ARRAY' AND json_array_length(body, '$.{k}') > 0, false)" for k in E.DATA_KEYS)}) THEN 'ERROR_LIKE' ELSE 'DATA' END"""


@query(f"SELECT source_name, collection_name, {_CLASS_SQL} AS verdict, count(*) AS n FROM bronze_payloads GROUP BY ALL")
def verdict_histogram(s: SparkSession, d: str) -> DataFrame:
    return Q.verdicts(_payloads(s, d), Q.STREAM)


def _payloads(s: SparkSession, d: str) -> DataFrame:
    """The raw captures as checks read them; nothing is known of their transport or bytes."""
    p = table(s, d, "bronze_payloads")
    return p.select("payload_id", *Q.STREAM, "dt", "fetched_ms", "file_name", F.col("body").alias("j"), F.lit(None).cast("int").alias("http_status"), F.lit(0).alias("issues"))


# Text


@query("SELECT payload_id, TRY_CAST(regexp_extract(file_name, '_([0-9]{13})_', 1) AS BIGINT) AS ms FROM bronze_payloads")
def regexp_extract_token(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_payloads").select("payload_id", E.fetched_ms(F.col("file_name")).alias("ms"))


@query("SELECT doc_id, len(regexp_split_to_array(trim(text, ' '), '\\s+')) AS n_fields, regexp_split_to_array(trim(text, ' '), '\\s+')[3] AS third FROM documents")
def whitespace_split_fields(s: SparkSession, d: str) -> DataFrame:
    f = F.split(F.trim("text"), r"\s+")
    return table(s, d, "documents").select("doc_id", big(F.size(f)).alias("n_fields"), F.get(f, 2).alias("third"))


@query("SELECT row_id, CASE WHEN strlen(replace(wbanno, chr(0), '')) > 0 THEN trim(replace(wbanno, chr(0), '')) END AS station FROM silver_weather")
def nul_strip(s: SparkSession, d: str) -> DataFrame:
    bare = F.replace(F.col("wbanno"), F.lit("\0"), F.lit(""))
    return table(s, d, "silver_weather").select("row_id", F.when(F.length(bare) > 0, F.trim(bare)).alias("station"))


# Time


@query("SELECT event_id, CAST(ts + to_minutes(CASE event_id % 3 WHEN 0 THEN -270 WHEN 1 THEN 330 ELSE 0 END) AS DATE) AS local_day FROM events")
def local_date_from_offset(s: SparkSession, d: str) -> DataFrame:
    offset = F.when(F.col("event_id") % 3 == 0, "-04:30").when(F.col("event_id") % 3 == 1, "+05:30")
    return table(s, d, "events").select("event_id", E.local_date(F.col("ts").cast("string"), offset).alias("local_day"))


@query("SELECT event_id, date_trunc('minute', ts) AS utc, -240 AS shift FROM events")
def utc_instant_from_local(s: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.date_format(E.shifted(F.col("ts"), F.lit(-240)), "yyyy-MM-dd'T'HH:mm"), F.lit("-04:00"))
    local, shift = E.ntz(F.substring(text, 1, 16)), E.offset_minutes(F.substring(text, 17, 6))
    return table(s, d, "events").select("event_id", E.shifted(local, -shift).alias("utc"), shift.alias("shift"))


@query("SELECT o_orderkey, timezone('America/New_York', timezone('UTC', o_orderdate + INTERVAL 6 HOUR)) AS local_ts FROM orders")
def tz_convert_dst(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), E.shifted(F.col("o_orderdate"), F.lit(360))).alias("local_ts"))


@query("SELECT event_id, date_trunc('second', ts) AS at FROM events")
def epoch_ms_or_iso(s: SparkSession, d: str) -> DataFrame:
    second = F.date_trunc("second", F.col("ts"))
    ms = (F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), second.cast("timestamp_ntz")) * 1000).cast("string")
    text = F.when(F.col("event_id") % 2 == 0, ms).otherwise(F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss"))
    return table(s, d, "events").select("event_id", E.millis_or_iso(text).alias("at"))


@query("SELECT event_id, date_trunc('minute', ts) AS at FROM events")
def strptime_compact(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", E.compact_ntz(F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmm")).alias("at"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_parse_multi_format(s: SparkSession, d: str) -> DataFrame:
    o, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(o, "yyyy-MM-dd")).when(k == 1, F.date_format(o, "MM/dd/yyyy")).when(k == 2, F.date_format(o, "MM-dd-yyyy")).otherwise(F.date_format(o, "yyyy/MM/dd"))
    return table(s, d, "orders").select("o_orderkey", E.event_date(text).alias("day"))


# Arithmetic and conditions


@query("SELECT event_id, value / 60.0 AS minutes, value / 1000.0 AS kilo, value / 4.184 AS kcal, value * 2.20462 AS lb FROM events")
def unit_scaling(s: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return table(s, d, "events").select("event_id", (v / 60.0).alias("minutes"), (v / 1000.0).alias("kilo"), (v / gold.KJ_PER_KCAL).alias("kcal"), (v * gold.LB_PER_KG).alias("lb"))


@query("SELECT event_id, value * 9.0 / 5.0 + 32.0 AS f FROM events")
def celsius_to_fahrenheit(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", E.fahrenheit(F.col("value")).alias("f"))


@query("SELECT l_discount, count(nullif(nullif(l_discount, 0.0), 0.05)) AS kept, count(*) AS n FROM lineitem GROUP BY l_discount")
def sentinel_to_null(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").groupBy("l_discount").agg(F.count(E.without(F.col("l_discount"), 0.0, 0.05)).alias("kept"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, count(CASE WHEN CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END = 0 THEN l_tax END) AS kept FROM lineitem GROUP BY l_returnflag")
def qc_flag_gate(s: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1)
    return table(s, d, "lineitem").groupBy("l_returnflag").agg(F.count(E.qc_gate(F.col("l_tax"), flag)).alias("kept"))


@query("SELECT c_custkey, least(c_acctbal, NULL, 500.0) AS lo, greatest(c_acctbal, NULL, 500.0) AS hi FROM customer")
def least_greatest_null_skip(s: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("double")
    return table(s, d, "customer").select("c_custkey", F.least("c_acctbal", none, F.lit(500.0)).alias("lo"), F.greatest("c_acctbal", none, F.lit(500.0)).alias("hi"))


@query("SELECT c_custkey, greatest(0.0, c_acctbal - 100.0) AS above FROM customer")
def clamp_zero(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").select("c_custkey", F.greatest(F.lit(0.0), F.col("c_acctbal") - 100.0).alias("above"))


# Spines and joins

_SPINE = "(SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT CAST(min({t}) AS DATE)::TIMESTAMP AS lo, CAST(max({t}) AS DATE)::TIMESTAMP AS hi FROM {n}))"


def _spine(df: DataFrame, ts: str) -> DataFrame:
    return R.date_spine(df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi")), "lo", "hi")


@query(f"SELECT day FROM {_SPINE.format(t='ts', n='events')}")
def date_spine_events(s: SparkSession, d: str) -> DataFrame:
    return _spine(table(s, d, "events"), "ts")


@query(f"SELECT day FROM {_SPINE.format(t='o_orderdate', n='orders')}")
def date_spine_orders(s: SparkSession, d: str) -> DataFrame:
    return _spine(table(s, d, "orders"), "o_orderdate")


@query(f"SELECT s.day, coalesce(a.n, 0) AS n_orders, a.total AS total, a.day IS NOT NULL AS has_orders FROM {_SPINE.format(t='o_orderdate', n='orders')} s LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) a USING (day)")
def spine_left_join_daily_agg(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    a = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return _spine(o, "o_orderdate").join(a, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"), "total", F.col("n").isNotNull().alias("has_orders"))


@query("""WITH t AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), d AS (SELECT user_id FROM t WHERE event_type='view' UNION SELECT user_id FROM t WHERE event_type='click' UNION SELECT user_id FROM t WHERE event_type='purchase')
SELECT d.user_id, v.n AS views, c.n AS clicks, p.n AS purchases FROM d LEFT JOIN t v ON v.user_id=d.user_id AND v.event_type='view' LEFT JOIN t c ON c.user_id=d.user_id AND c.event_type='click' LEFT JOIN t p ON p.user_id=d.user_id AND p.event_type='purchase'""")
def union_distinct_spine_multi_join(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    part = {k: t.where(F.col("event_type") == k).select("user_id", F.col("n").alias(a)) for k, a in (("view", "views"), ("click", "clicks"), ("purchase", "purchases"))}
    out = part["view"].select("user_id").union(part["click"].select("user_id")).union(part["purchase"].select("user_id")).distinct()
    for p in part.values():
        out = out.join(p, "user_id", "left")
    return out


_TWO = "(SELECT user_id, count(*) AS signups FROM events WHERE event_type='signup' GROUP BY 1) a FULL OUTER JOIN (SELECT user_id, count(*) AS purchases FROM events WHERE event_type='purchase' GROUP BY 1) b ON a.user_id=b.user_id"


def _two_sources(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    a = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.count(F.lit(1)).alias("signups"))
    b = e.where(F.col("event_type") == "purchase").groupBy("user_id").agg(F.count(F.lit(1)).alias("purchases"))
    return R.full_outer_sources(a, b, "user_id", "has_signups", "has_purchases")


@query(f"SELECT coalesce(a.user_id, b.user_id) AS user_id, signups, purchases, a.user_id IS NOT NULL AS has_signups, b.user_id IS NOT NULL AS has_purchases FROM {_TWO}")
def full_outer_two_sources(s: SparkSession, d: str) -> DataFrame:
    return _two_sources(s, d)


@query(f"SELECT count(*) FILTER (WHERE a.user_id IS NOT NULL AND b.user_id IS NOT NULL) AS both, count(*) FILTER (WHERE b.user_id IS NULL) AS only_first, count(*) FILTER (WHERE a.user_id IS NULL) AS only_second FROM {_TWO}")
def coverage_split(s: SparkSession, d: str) -> DataFrame:
    return Q.source_split(_two_sources(s, d), "has_signups", "has_purchases")


_LARGE = "SELECT CAST(o_orderdate AS DATE) AS big_day, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1"


@query(f"SELECT s.day, b.o_orderkey, b.o_totalprice FROM {_SPINE.format(t='o_orderdate', n='orders')} s ASOF LEFT JOIN ({_LARGE}) b ON s.day >= b.big_day")
def asof_carry_forward_global(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    large = o.where(F.col("o_totalprice") > 400000).select(F.to_date("o_orderdate").alias("big_day"), "o_orderkey", "o_totalprice")
    return R.asof_join(_spine(o, "o_orderdate"), large, "day", "big_day", [], ["o_orderkey", "o_totalprice"], tie="o_orderkey")


@query("SELECT p.event_id, s.event_id AS signup_id, s.value AS signup_value FROM (SELECT * FROM events WHERE event_type='purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type='signup') s ON p.user_id = s.user_id AND p.ts >= s.ts")
def asof_carry_forward_keyed(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    right = e.where(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("signup_id"), F.col("value").alias("signup_value"))
    return R.asof_join(e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts"), right, "ts", "at", ["user_id"], ["signup_id", "signup_value"], tie="signup_id").select("event_id", "signup_id", "signup_value")


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c.c_nationkey")
def chained_left_join(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "customer").where(F.col("c_acctbal") > 0)
    o = table(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM content_labels)")
def anti_join_new_keys(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id").join(table(s, d, "content_labels").select("doc_id").distinct(), "doc_id", "left_anti")


# Aggregates


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value) / 60.0, 4) AS minutes, round(avg(value), 4) AS mean, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1")
def daily_group_agg(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy(day_of()).agg(F.count(F.lit(1)).alias("n"), r4(F.sum("value") / 60.0).alias("minutes"), r4(F.avg("value")).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@query("SELECT CAST(ts AS DATE) AS day, event_type, round(stddev_samp(value), 4) AS sd FROM events GROUP BY 1, 2")
def stddev_samp_daily(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy(day_of(), "event_type").agg(r4(F.stddev_samp("value")).alias("sd"))


@query("SELECT CAST(ts AS DATE) AS day, round(100.0 * count(*) FILTER (WHERE value BETWEEN 70 AND 140) / count(*), 4) AS tir, round(100.0 * count(*) FILTER (WHERE value < 70) / count(*), 4) AS below, round(100.0 * count(*) FILTER (WHERE value > 140) / count(*), 4) AS above FROM events GROUP BY 1")
def filtered_agg_time_in_range(s: SparkSession, d: str) -> DataFrame:
    v, n = F.col("value"), F.count(F.lit(1))
    share = lambda c: r4(F.lit(100.0).cast("double") * F.count_if(c) / n)
    return table(s, d, "events").groupBy(day_of()).agg(share(v.between(70, 140)).alias("tir"), share(v < 70).alias("below"), share(v > 140).alias("above"))


@query("SELECT CAST(ts AS DATE) AS day, max(value) AS hi, min(value) AS lo, greatest(0.0, (max(value) + min(value)) / 2.0 - 50.0) AS degree_days, min(value) <= 1.0 AS frost FROM events GROUP BY 1")
def per_day_extremes_flags(s: SparkSession, d: str) -> DataFrame:
    hi, lo = F.max("value"), F.min("value")
    return table(s, d, "events").groupBy(day_of()).agg(hi.alias("hi"), lo.alias("lo"), F.greatest(F.lit(0.0), (hi + lo) / 2.0 - 50.0).alias("degree_days"), (lo <= 1.0).alias("frost"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(f"SELECT l_returnflag, {', '.join(f'round(avg({c}), 4) AS {c}_mean' for c in _NUM)} FROM lineitem GROUP BY l_returnflag")
def dynamic_multi_column_avg(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").groupBy("l_returnflag").agg(*[r4(F.avg(c)).alias(f"{c}_mean") for c in _NUM])


@query("SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT user_id || '-' || CAST(ts AS DATE)) AS user_days FROM events GROUP BY event_type")
def count_distinct_expr(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("event_type").agg(F.count_distinct(F.to_date("ts")).alias("days"), F.count_distinct(F.concat("user_id", F.lit("-"), F.to_date("ts").cast("string"))).alias("user_days"))


@query("SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem")
def count_distinct_struct(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").agg(F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("n"))


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY len(regexp_split_to_array(trim(text, ' '), '\\s+')) DESC, doc_id DESC) = 1")
def argmax_richest_signature(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy("source").agg(F.max_by("doc_id", F.struct(F.size(F.split(F.trim("text"), r"\s+")), F.col("doc_id"))).alias("doc_id"))


# Gaps, samples, hashes


@query("SELECT o_orderpriority, before, after, date_diff('day', before, after) - 1 AS missing FROM (SELECT o_orderpriority, day AS after, lag(day) OVER (PARTITION BY o_orderpriority ORDER BY day) AS before FROM (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders)) WHERE date_diff('day', before, after) > 1")
def gap_detection(s: SparkSession, d: str) -> DataFrame:
    return R.date_gaps(table(s, d, "orders"), "o_orderdate", ["o_orderpriority"]).withColumn("missing", big("missing"))


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events ORDER BY day DESC LIMIT 8")
def trailing_n_partitions(s: SparkSession, d: str) -> DataFrame:
    return R.trailing_n(table(s, d, "events").select(day_of()), "day", 8)


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY source) AS n FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)) WHERE n <= 5 OR k IN (SELECT CAST(floor(i * (n - 1) / 4.0) AS BIGINT) FROM (VALUES (0), (1), (2), (3), (4)) t(i))")
def spread_sample(s: SparkSession, d: str) -> DataFrame:
    return R.spread_sample(table(s, d, "documents").select("source", "doc_id"), "source", ["doc_id"], 5, F.floor(F.col("doc_id") / 1000))


@query("SELECT sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_hash_dedup(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


# Checks

_NOW = 1_767_225_600_000


@query(f"""SELECT source_name, collection_name, CASE WHEN n IS NULL THEN expected_empty ELSE ({_NOW} - newest) / 3600000.0 <= cadence_hours + grace_hours END AS passed, 'ERROR' AS severity, ({_NOW} - newest) / 3600000.0 AS lag_hours
FROM (SELECT source_name, collection_name, max(cadence_hours) AS cadence_hours, max(grace_hours) AS grace_hours, bool_or(expected_empty) AS expected_empty FROM collection_check_config GROUP BY 1, 2) LEFT JOIN (SELECT source_name, collection_name, max(fetched_ms) AS newest, count(*) AS n FROM bronze_payloads GROUP BY 1, 2) USING (source_name, collection_name)""")
def freshness_lag(s: SparkSession, d: str) -> DataFrame:
    return Q.freshness(table(s, d, "bronze_payloads"), table(s, d, "collection_check_config"), _NOW)


@query("SELECT collection_name, count(*) AS gaps, CAST(sum(missing) AS BIGINT) AS missing, max(missing) AS longest, 'WARN' AS severity FROM (SELECT collection_name, date_diff('day', lag(day) OVER (PARTITION BY collection_name ORDER BY day), day) - 1 AS missing FROM (SELECT DISTINCT collection_name, CAST(dt AS DATE) AS day FROM bronze_payloads)) WHERE missing >= 1 GROUP BY 1")
def completeness_gaps(s: SparkSession, d: str) -> DataFrame:
    g = Q.completeness(table(s, d, "bronze_payloads").select("collection_name", F.col("dt").cast("date").alias("day")), "day", ["collection_name"])
    return g.withColumn("longest", big("longest"))


_SPLIT = "2023-01-01"  # captures before it are the baseline
_RICHEST = "SELECT collection_name, list_sort(json_keys(body)) AS sig FROM bronze_payloads WHERE json_valid(body) AND json_type(body) = 'OBJECT' AND dt {op} '{d}' QUALIFY row_number() OVER (PARTITION BY collection_name ORDER BY len(json_keys(body)) DESC, payload_id DESC) = 1"


@query(f"""SELECT collection_name, coalesce(list_sort(list_filter(n.sig, lambda x: NOT list_contains(o.sig, x))), []) AS added, coalesce(list_sort(list_filter(o.sig, lambda x: NOT list_contains(n.sig, x))), []) AS removed, coalesce(list_sort(o.sig) = list_sort(n.sig), true) AS passed
FROM ({_RICHEST.format(op='>=', d=_SPLIT)}) n LEFT JOIN ({_RICHEST.format(op='<', d=_SPLIT)}) o USING (collection_name)""")
def schema_drift_added_removed(s: SparkSession, d: str) -> DataFrame:
    """The richest signature of the newer captures against that of the older ones."""
    p = _payloads(s, d)
    p = p.where(F.json_object_keys("j").isNotNull())
    now, then = (Q.richest_signature(p.where(part), ["collection_name"], "payload_id") for part in (F.col("dt") >= _SPLIT, F.col("dt") < _SPLIT))
    return Q.drift_between(now, then, ["collection_name"]).select("collection_name", F.array_sort("added").alias("added"), F.array_sort("removed").alias("removed"), "passed")


_RECENT = "SELECT p.*, coalesce(nullif(regexp_extract(lower(file_name), '\\.(json|csv|txt)$', 1), ''), 'json') AS rd FROM bronze_payloads p SEMI JOIN (SELECT source_name, collection_name, dt FROM (SELECT DISTINCT source_name, collection_name, dt FROM bronze_payloads) QUALIFY row_number() OVER (PARTITION BY source_name, collection_name ORDER BY dt DESC) <= 14) USING (source_name, collection_name, dt)"
_CONFIGURED = f"SELECT r.*, c.* EXCLUDE (source_name, collection_name) FROM ({_RECENT}) r JOIN collection_check_config c ON c.source_name = r.source_name AND c.collection_name = r.collection_name AND c.reader = r.rd"
_VALUE_SQL = "CASE event_date_source WHEN 'partition' THEN [dt] WHEN 'payload' THEN CASE WHEN NOT json_valid(body) THEN [] WHEN unnest_records AND json_type(body) = 'OBJECT' THEN CASE WHEN json_type(body, '$.records') = 'ARRAY' THEN list_transform(CAST(json_extract(body, '$.records') AS JSON[]), lambda x: x->>('$.' || event_date_field)) ELSE [] END WHEN json_type(body) = 'ARRAY' THEN list_transform(CAST(body AS JSON[]), lambda x: x->>('$.' || event_date_field)) WHEN json_type(body) = 'OBJECT' THEN [body->>('$.' || event_date_field)] ELSE [] END END"
_EVENT_DAYS = f"SELECT DISTINCT source_name, collection_name, reader, TRY_CAST(substr(v, 1, 10) AS DATE) AS day FROM (SELECT source_name, collection_name, reader, unnest({_VALUE_SQL}) AS v FROM ({_CONFIGURED})) WHERE TRY_CAST(substr(v, 1, 10) AS DATE) IS NOT NULL"


@query(_EVENT_DAYS)
def event_days(s: SparkSession, d: str) -> DataFrame:
    """The days events of the recent captures fall on, by each stream's own source of the day."""
    return Q.event_dates(_payloads(s, d), table(s, d, "collection_check_config"))


@query(f"""SELECT source_name, collection_name, reader, count(*) AS days, count(*) FILTER (WHERE gap > cadence_days) AS gaps, CAST(coalesce(sum(gap - 1) FILTER (WHERE gap > cadence_days), 0) AS BIGINT) AS missing, CAST(coalesce(max(gap - 1) FILTER (WHERE gap > cadence_days), 0) AS BIGINT) AS longest, count(*) FILTER (WHERE gap > cadence_days) = 0 AS passed
FROM (SELECT *, date_diff('day', lag(day) OVER (PARTITION BY source_name, collection_name, reader ORDER BY day), day) AS gap FROM ({_EVENT_DAYS})) JOIN collection_check_config USING (source_name, collection_name, reader) GROUP BY ALL""")
def event_completeness(s: SparkSession, d: str) -> DataFrame:
    """Gaps between event days beyond each stream's cadence."""
    return Q.event_completeness(_payloads(s, d), table(s, d, "collection_check_config"))


_SIG_SQL = "CASE WHEN NOT json_valid(body) THEN NULL WHEN unnest_records AND json_type(body) = 'OBJECT' THEN CASE WHEN json_type(body, '$.records[0]') = 'OBJECT' THEN json_keys(body, '$.records[0]') END WHEN json_type(body) = 'ARRAY' THEN CASE WHEN json_type(body, '$[0]') = 'OBJECT' THEN json_keys(body, '$[0]') END WHEN json_type(body) = 'OBJECT' THEN json_keys(body) END"


@query(f"""WITH newest AS (SELECT * FROM ({_CONFIGURED}) QUALIFY row_number() OVER (PARTITION BY source_name, collection_name, reader, dt ORDER BY fetched_ms DESC, file_name DESC) = 1), s AS (SELECT source_name, collection_name, reader, dt, list_sort({_SIG_SQL}) AS signature FROM newest)
SELECT source_name, collection_name, reader, signature FROM s WHERE len(signature) > 0 QUALIFY row_number() OVER (PARTITION BY source_name, collection_name, reader ORDER BY len(signature) DESC, dt DESC) = 1""")
def payload_signatures(s: SparkSession, d: str) -> DataFrame:
    """The richest signature of the newest capture of each recent day."""
    return Q.signatures(_payloads(s, d), table(s, d, "collection_check_config"))


_SAMPLED = f"SELECT * FROM (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY source_name, collection_name, rd) AS n FROM ({_RECENT}) WINDOW w AS (PARTITION BY source_name, collection_name, rd ORDER BY dt, fetched_ms, file_name)) WHERE n <= 5 OR k IN (SELECT CAST(floor(i * (n - 1) / 4.0) AS BIGINT) FROM (VALUES (0), (1), (2), (3), (4)) t(i))"
_HEALTH = f"""SELECT source_name, collection_name, c.reader, expected_empty, coalesce(seen, 0) AS seen, coalesce(data, 0) AS data, coalesce(empty, 0) AS empty, coalesce(errors, 0) AS errors, 0::BIGINT AS issues, CASE WHEN coalesce(seen, 0) = 0 THEN 'NO_PAYLOADS' WHEN errors > 0 THEN 'ERRORS' WHEN empty > 0 AND NOT expected_empty THEN 'EMPTY' WHEN empty > 0 THEN 'EXPECTED_EMPTY' ELSE 'DATA' END AS state
FROM collection_check_config c LEFT JOIN (SELECT source_name, collection_name, rd AS reader, count(*) AS seen, count(*) FILTER (WHERE verdict = 'DATA') AS data, count(*) FILTER (WHERE verdict LIKE 'EMPTY%') AS empty, count(*) FILTER (WHERE verdict IN ('ERROR_LIKE', 'UNPARSEABLE')) AS errors FROM (SELECT source_name, collection_name, rd, {_CLASS_SQL} AS verdict FROM ({_SAMPLED})) GROUP BY ALL) h USING (source_name, collection_name, reader)"""


@query(f"SELECT *, state IN ('NO_PAYLOADS', 'EXPECTED_EMPTY', 'DATA') AS passed, 'WARN' AS severity FROM ({_HEALTH})")
def content_health(s: SparkSession, d: str) -> DataFrame:
    """Verdict of every configured stream on an even spread of its recent captures."""
    return Q.content_health(_payloads(s, d), table(s, d, "collection_check_config"))


def checks_run(s: SparkSession, d: str) -> DataFrame:
    """All check families of every configured stream; the baseline is the first half of the captures."""
    p, config = _payloads(s, d), table(s, d, "collection_check_config")
    baseline = Q.signatures(p.where(F.col("dt") < _SPLIT), config)
    return Q.run_checks(p, config, baseline, _NOW)


QUERIES["checks_run"] = checks_run


@query("SELECT check_name, found = 0 AS passed, 'WARN' AS severity, found, single_source FROM (SELECT 'sleep_join_sanity' AS check_name, count(*) FILTER (WHERE NOT has_sleep AND NOT has_recovery) AS found, count(*) FILTER (WHERE day >= DATE '2023-01-01' AND has_sleep <> has_recovery) AS single_source FROM gold_daily_wellness)")
def join_sanity(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "gold_daily_wellness").select(F.col("day").alias("night_date"), F.col("has_sleep").alias("has_garmin"), F.col("has_recovery").alias("has_whoop"))
    return Q.join_sanity(g, "2023-01-01")


@query("SELECT row_id, day FROM gold_daily_wellness WHERE NOT has_sleep ORDER BY day, row_id LIMIT 5")
def first_details(s: SparkSession, d: str) -> DataFrame:
    return Q.first_details(table(s, d, "gold_daily_wellness").where(~F.col("has_sleep")).select("row_id", "day"), ["day", "row_id"], 5)


@query("SELECT 'lines_' || k AS check_name, found = 0 AS passed, 'ERROR' AS severity, found FROM (SELECT unnest(['repeated', 'null_keys', 'out_of_range']) AS k, unnest([(SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL), (SELECT count(*) FROM lineitem WHERE l_quantity > 45 OR l_quantity < 0)]) AS found)")
def uniqueness_check(s: SparkSession, d: str) -> DataFrame:
    return Q.table_checks(table(s, d, "lineitem"), "lines", ["l_orderkey", "l_linenumber"], {"l_quantity": (0, 45, None)}).drop("description")


@query("SELECT count(*) AS bad FROM silver_weather WHERE solar_rad_wm2 < 0 OR solar_rad_wm2 > 2000 OR soil_moisture_5 < 0 OR soil_moisture_5 > 1 OR surface_temp_max_c < -60 OR surface_temp_max_c > 60")
def range_check(s: SparkSession, d: str) -> DataFrame:
    b = {c: Q.BOUNDS["weather"][c] for c in ("solar_rad_wm2", "soil_moisture_5", "surface_temp_max_c")}
    flags = [Q.outside(c, *v) for c, v in b.items()]
    return table(s, d, "silver_weather").agg(F.count_if(flags[0] | flags[1] | flags[2]).alias("bad"))


@query("SELECT 'labelled' AS check_name, (SELECT count(DISTINCT doc_id) FROM documents) - (SELECT count(DISTINCT doc_id) FROM content_labels) <= 0 AS passed, 'WARN' AS severity, (SELECT count(DISTINCT doc_id) FROM documents) - (SELECT count(DISTINCT doc_id) FROM content_labels) AS found")
def coverage_check(s: SparkSession, d: str) -> DataFrame:
    return Q.coverage(table(s, d, "content_labels"), F.col("doc_id"), table(s, d, "documents"), F.col("doc_id"), "labelled").drop("description")


# Marts and tables on the domain's own rows

@query("SELECT wearer_id, day, row_id, steps FROM gold_daily_wellness QUALIFY row_number() OVER (PARTITION BY wearer_id, day ORDER BY built_at DESC NULLS LAST, row_id DESC) = 1")
def latest_wellness_build(s: SparkSession, d: str) -> DataFrame:
    return R.dedup_latest(table(s, d, "gold_daily_wellness").select("wearer_id", "day", "row_id", "steps", "built_at"), ["wearer_id", "day"], ["built_at", "row_id"]).drop("built_at")


_BODY_SQL = "SELECT payload_id, CASE WHEN json_valid(body) THEN CASE WHEN json_type(body) = 'VARCHAR' THEN TRY_CAST(body::JSON->>'$' AS JSON) ELSE body::JSON END END AS b FROM bronze_payloads WHERE collection_name = '{c}'"
_LIST_SQL = "CASE json_type({x}) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) WHEN 'OBJECT' THEN [{x}] END"
_SLEEPS_SQL = f"SELECT payload_id, unnest(CASE WHEN json_type(b) = 'ARRAY' THEN CAST(b AS JSON[]) ELSE coalesce({_LIST_SQL.format(x="json_extract(b, '$.records')")}, {_LIST_SQL.format(x="json_extract(b, '$.data.records')")}) END) AS a FROM ({_BODY_SQL.format(c='sleep')})"


@query(f"SELECT a->>'$.id' AS whoop_sleep_id, count(*) AS copies, count(a->>'$.score.sleep_performance_percentage') AS scored FROM ({_SLEEPS_SQL}) WHERE a->>'$.id' IS NOT NULL GROUP BY 1")
def bronze_sleep_records(s: SparkSession, d: str) -> DataFrame:
    """The sleeps of every readable page, whatever its shape: wrapped once more, bare, one level down, or a lone record."""
    p = table(s, d, "bronze_payloads").where(F.col("collection_name") == "sleep")
    a = F.col("a")
    r = p.select(F.explode(E.record_list(F.col("body"), "records", "data.records")).alias("a")).where(E.json_str(a, "id").isNotNull())
    return r.groupBy(E.json_str(a, "id").alias("whoop_sleep_id")).agg(F.count(F.lit(1)).alias("copies"), F.count(E.json_str(a, "score.sleep_performance_percentage")).alias("scored"))


# Lines, rates, late corrections


@query("SELECT 'E' || event_id || '  ' || strftime(ts, '%Y%m%d') || ' ' || event_type AS line FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def rows_for_date(s: SparkSession, d: str) -> DataFrame:
    """Lines of a fixed-column file whose second field is the day, as they were written."""
    e = table(s, d, "events")
    lines = e.select(F.concat(F.lit("E"), "event_id", F.lit("  "), F.date_format("ts", "yyyyMMdd"), F.lit(" "), "event_type").alias("line"))
    return files.rows_of_day(lines, "20240115")


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS n FROM events")
def sliding_count_60s(s: SparkSession, d: str) -> DataFrame:
    """Requests of the last 60 seconds at each request."""
    return R.trailing_count(table(s, d, "events").select("event_id", "event_type", "ts"), ["event_type"], "ts", 60, bucket_seconds=3600).select("event_id", "n")


_BATCHES = "SELECT user_id, CAST(ts AS DATE) AS day, event_id, value, 1 AS batch FROM events UNION ALL SELECT user_id, CAST(ts AS DATE), event_id, value + 1000, 2 FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 6 FROM events)"


@query(f"SELECT user_id, day, event_id, value, CAST(batch AS INTEGER) AS batch FROM ({_BATCHES}) QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY batch DESC, event_id DESC) = 1")
def trailing_recapture_merge(s: SparkSession, d: str) -> DataFrame:
    """A second batch fetches the last seven days again; its corrected records win, older days stay."""
    first = table(s, d, "events").select("user_id", day_of(), "event_id", "value", "ts")
    last = R.trailing_n(_spine(first, "ts"), "day", 7)
    again = first.join(last, "day", "left_semi").withColumn("value", F.col("value") + 1000)
    both = first.withColumn("batch", F.lit(1)).unionByName(again.withColumn("batch", F.lit(2))).drop("ts")
    return R.dedup_latest(both, ["user_id", "day"], ["batch", "event_id"])
