"""Reading days and instants written in many spellings, as Catalyst expressions.

``add_when`` reads a text column into four columns::

    day   date            the calendar day, when only a day is written
    wall  timestamp_ntz   the clock shown, when a time of day is written
    shift int             seconds east of UTC, when the text names an offset
    utc   timestamp_ntz   the instant, for epoch numbers and texts with an offset

Everything is null for null, empty and unreadable text and for days, months,
hours or offsets that do not exist (the 31st of June, 25 o'clock).
Nothing here needs Python: it is all inside whole-stage code generation.
"""

from __future__ import annotations

import functools
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .planning import apart

# Month abbreviations of the locales in use.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "mär": 3, "mai": 5, "okt": 10, "dez": 12, "ene": 1, "abr": 4, "ago": 8, "dic": 12, "fév": 2, "avr": 4, "aoû": 8, "déc": 12,
}

ZONE = r"(?i)\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})(?:\[[^\]]*\])?$"
CLOCK = r"(?i)[T ](\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AP]M)?$"


def _month_number(name: Column) -> Column:
    pairs = [x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(f"{v:02d}"))]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.substring(name, 1, 3)))


def _two(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_of_micros(us: Column) -> Column:
    """Epoch microseconds as a naive UTC timestamp."""
    return F.timestamp_add("MICROSECOND", us, _epoch())


def micros_of_ntz(ts: Column) -> Column:
    """A naive UTC timestamp as epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def millis_of_ntz(ts: Column) -> Column:
    """A naive UTC timestamp as epoch milliseconds, cut."""
    return F.timestamp_diff("MILLISECOND", _epoch(), ts)


def add_when(df: DataFrame, out: str, text: Column, month_first: Column) -> DataFrame:
    """Add the columns ``{out}_day``, ``{out}_wall``, ``{out}_shift`` and ``{out}_utc`` read from ``text``.

    Numeric days and months follow ``month_first`` (null counts as day first).
    The steps are separate projections on purpose: each is used several times
    and Catalyst keeps an expensive producer of several uses in its own node.
    """
    t = {k: f"__{out}_{k}" for k in ("p", "n", "s", "z", "b", "d", "h", "x")}
    c = {k: F.col(v) for k, v in t.items()}
    plain, spread, zone, bare = c["p"], c["s"], c["z"], c["b"]
    # no spelling of a day is shorter than 1.1.23
    df = df.withColumn(t["p"], apart(F.when(F.length(text) >= 6, F.trim(F.translate(text, "\u00a0\u202f", "  ")))))
    number = plain.rlike(r"^\d{9,19}$|^\d+\.\d+([Ee]\+?\d{1,2})?$|^\d+[Ee]\+?\d{1,2}$")
    exact = F.coalesce(plain.try_cast("decimal(38,9)"), plain.try_cast("double").try_cast("decimal(38,9)"))
    compact = F.regexp_replace(plain, r"^(\d{4})(\d{2})(\d{2})[T ](\d{2})(\d{2})(\d{2})?", "$1-$2-$3T$4:$5:$6")
    df = df.withColumn(t["n"], apart(F.when(number, exact))).withColumn(t["s"], F.when(number, F.lit(None)).when(plain.rlike(r"^\d{8}[T ]\d{4}"), F.regexp_replace(compact, r":(?=$|Z|[+-])", "")).otherwise(plain))
    timed = F.contains(spread, F.lit(":"))
    df = df.withColumn(t["z"], apart(F.when(timed, F.regexp_extract(spread, ZONE, 1)).otherwise("")))
    df = df.withColumn(t["b"], apart(F.when(timed & (zone != ""), F.regexp_replace(spread, ZONE, "")).otherwise(spread)))
    df = df.withColumn(t["d"], apart(F.when(timed, F.regexp_replace(bare, CLOCK, "")).otherwise(bare)))
    df = df.withColumn(t["x"], apart(_day_of(c["d"], month_first)))
    df = df.withColumn(t["h"], apart(F.when(timed, F.split(F.regexp_replace(F.regexp_extract(bare, CLOCK, 0), CLOCK, "$1,$2,$3,$4,$5"), ","))))
    hour, half = F.get(c["h"], 0).try_cast("int"), F.upper(F.get(c["h"], 4))
    hour24 = F.when(half == "", hour).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == "PM", 12).otherwise(0))
    second, frac = F.get(c["h"], 2), F.rpad(F.substring(F.get(c["h"], 3), 1, 6), 6, "0")
    clock = F.concat(c["x"].cast("string"), F.lit(" "), _two(hour24.cast("string")), F.lit(":"), F.get(c["h"], 1), F.lit(":"), F.when(second == "", "00").otherwise(second), F.lit("."), frac)
    digits = F.regexp_replace(zone, r"\D", "")
    oh, om = F.substring(digits, 1, 2).try_cast("int"), F.substring(digits, 3, 2).try_cast("int")
    sign = F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    shift = F.when(zone == "", F.lit(None).cast("int")).when(digits == "", 0).when((oh <= 18) & (om < 60), sign * (oh * 3600 + om * 60))
    df = df.withColumn(f"{out}_shift", apart(shift)).withColumn(f"{out}_wall", F.when((zone == "") | shift.isNotNull(), clock.try_cast("timestamp_ntz")))
    wall, known = F.col(f"{out}_wall"), F.col(f"{out}_shift")
    size = F.length(F.floor(c["n"]).cast("string"))
    us = F.when(size <= 10, F.floor(c["n"] * 1_000_000)).when(size <= 13, F.floor(c["n"] * 1_000)).when(size <= 16, F.floor(c["n"])).when(size <= 19, F.floor(c["n"] / 1_000))
    df = df.withColumn(f"{out}_utc", apart(F.when(known.isNotNull(), ntz_of_micros(micros_of_ntz(wall) - known.cast("long") * 1_000_000)).when(c["n"].isNotNull(), ntz_of_micros(us.try_cast("long")))))
    return df.withColumn(f"{out}_day", F.when(~timed, c["x"])).drop(*t.values())


def _day_of(dated: Column, month_first: Column) -> Column:
    """The day in any of the date spellings, without a time of day."""
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$"
    packed = r"^(\d{4})(\d{2})(\d{2})$"
    ordinal = r"^(\d{4})-(\d{3})$"
    numeric = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$"
    named = r"^(?:\p{L}{2,9}\.?,? +)?(\d{1,2})\.? +(\p{L}{3,9})\.?,? +(\d{4})$"
    american = r"^(?:\p{L}{2,9}\.?, +)?(\p{L}{3,9})\.? +(\d{1,2}), +(\d{4})$"

    def part(pattern: str, k: int) -> Column:
        return F.regexp_extract(dated, pattern, k)

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, F.coalesce(_two(m), F.lit("00")), _two(d)).try_cast("date")

    nth = part(ordinal, 2).try_cast("int")
    first = F.concat(part(ordinal, 1), F.lit("-01-01")).try_cast("date")
    counted = F.date_add(first, nth - 1)
    year = F.when(F.length(part(numeric, 3)) == 2, F.concat(F.lit("20"), part(numeric, 3))).otherwise(part(numeric, 3))
    us = F.coalesce(month_first, F.lit(False))
    return (
        F.when(dated.rlike(iso), day(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(dated.rlike(packed), day(part(packed, 1), part(packed, 2), part(packed, 3)))
        .when(dated.rlike(ordinal), F.when((nth >= 1) & (F.year(counted) == F.year(first)), counted))
        .when(dated.rlike(numeric), day(year, F.when(us, part(numeric, 1)).otherwise(part(numeric, 2)), F.when(us, part(numeric, 2)).otherwise(part(numeric, 1))))
        .when(dated.rlike(named), day(part(named, 3), _month_number(part(named, 2)), part(named, 1)))
        .when(dated.rlike(american), day(part(american, 3), _month_number(part(american, 1)), part(american, 2)))
    )


@functools.cache
def known_zones() -> tuple[str, ...]:
    return tuple(sorted(zoneinfo.available_timezones()))


def valid_zone(zone: Column) -> Column:
    """The zone if it is a known region name, else null (a bad name must not end the job)."""
    return F.when(zone.isin(*known_zones()), zone)


def wall_to_utc(wall: Column, zone: Column) -> Column:
    """The instant a clock in ``zone`` shows ``wall``.

    Shown twice: the earlier instant. Never shown (the hour skipped in spring): null.
    """
    utc = F.convert_timezone(zone, F.lit("UTC"), wall)
    return F.when(F.convert_timezone(F.lit("UTC"), zone, utc) == wall, utc)


def iso_day(day: Column) -> Column:
    return day.cast("string")


def iso_instant(utc: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.mmmZ``, cut to milliseconds."""
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def clean_station(wbanno: Column) -> Column:
    """Five digits of a station id with stray characters or lost leading zeros; null if none."""
    digits = F.regexp_replace(F.regexp_replace(wbanno, r"\.0*\s*$", ""), r"\D", "")
    return F.when(digits != "", F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), "0"))
