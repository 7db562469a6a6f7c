"""Column expressions shared by tables, marts and checks; none needs Python at run time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys under which payloads keep their records, page on, or report errors.
DATA_KEYS = ("records", "data", "items", "results", "activities")
PAGING_KEYS = ("next_token", "nextToken", "next", "paging")
ERROR_KEYS = ("error", "errors", "fault", "exception")


def json_str(json: Column, path: str) -> Column:
    """Text at a dotted path; null where missing, null or malformed."""
    return F.get_json_object(json, f"$.{path}" if not path.startswith(("$", "[")) else path)


def with_fields(df: DataFrame, json: str, paths: list[str], name: str = "__f") -> tuple[DataFrame, Callable[[str], Column]]:
    """``df`` with the fields of a JSON column read in one pass, and a getter of each field's text by its dotted path.

    As ``json_str`` for every path, but a payload is parsed once however many
    fields are read; one that is no object, or not readable to its end, has none.
    """
    tree: dict = {}
    for p in paths:
        at = tree
        for step in p.split("."):
            at = at.setdefault(step, {})

    def shape(x: dict) -> T.DataType:
        return T.StructType([T.StructField(k, shape(v) if v else T.StringType()) for k, v in x.items()])

    return df.withColumn(name, F.from_json(F.col(json), shape(tree))), lambda p: F.col(".".join(f"`{x}`" for x in (name, *p.split("."))))


def json_num(json: Column, path: str) -> Column:
    return json_str(json, path).try_cast("double")


def exact_int(text: Column, kind: str = "int") -> Column:
    """Whole number of a text, fractions and exponents rounded half away from zero, long ids kept exact."""
    whole = text.try_cast("bigint")
    rounded = F.round(F.coalesce(text.try_cast("decimal(38,9)"), text.try_cast("double").try_cast("decimal(38,9)"))).try_cast("bigint")
    return F.coalesce(whole, rounded).try_cast(kind)


def json_int(json: Column, path: str, kind: str = "int") -> Column:
    return exact_int(json_str(json, path), kind)


def flag(text: Column, default: bool = False) -> Column:
    return F.coalesce(text.try_cast("boolean"), F.lit(default))


def json_bool(json: Column, path: str, default: bool = False) -> Column:
    return flag(json_str(json, path), default)


def iso_date(text: Column) -> Column:
    """The date in the first ten characters; partial dates are null."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.substring(text, 1, 10).try_cast("date"))


def json_date(json: Column, path: str) -> Column:
    return iso_date(json_str(json, path))


def json_array(json: Column, path: str | None = None) -> Column:
    """Elements of a JSON array as texts; null for anything else."""
    return F.from_json(json if path is None else json_str(json, path), "array<string>")


def first_map_value(json: Column) -> Column:
    """Value of the first key of an object, in document order."""
    return F.get(F.map_values(F.from_json(json, "map<string,string>")), 0)


def fetched_ms(file_name: Column) -> Column:
    """The 13-digit capture time in a file name."""
    return F.regexp_extract(file_name, r"_([0-9]{13})_", 1).try_cast("bigint")


def partition_day(path: Column) -> Column:
    return F.regexp_extract(path, r"dt=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def offset_minutes(offset: Column) -> Column:
    """Minutes of a ``±HH:MM`` offset; the minutes take the sign of the hours."""
    sign = F.when(F.startswith(offset, F.lit("-")), -1).otherwise(1)
    return F.substring(offset, 1, 3).try_cast("int") * 60 + sign * F.coalesce(F.substring(offset, 5, 2).try_cast("int"), F.lit(0))


def shifted(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def ntz(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def local_date(text: Column, offset: Column) -> Column:
    """Local day of an instant by its offset, or its UTC day where the offset is missing."""
    return F.coalesce(F.to_date(shifted(ntz(text), offset_minutes(offset))), iso_date(text))


def millis_ntz(text: Column) -> Column:
    """Epoch milliseconds in a text as a naive UTC timestamp."""
    return F.timestamp_add("MICROSECOND", text.try_cast("bigint") * 1000, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def millis_or_iso(text: Column) -> Column:
    return F.coalesce(millis_ntz(text), ntz(text))


def compact_ntz(day: Column, hhmm: Column) -> Column:
    """``yyyyMMdd`` and ``HHmm`` as a naive timestamp; null if they do not exist."""
    iso = F.concat(F.substring(day, 1, 4), F.lit("-"), F.substring(day, 5, 2), F.lit("-"), F.substring(day, 7, 2), F.lit(" "), F.substring(hhmm, 1, 2), F.lit(":"), F.substring(hhmm, 3, 2), F.lit(":00"))
    return F.when(day.rlike(r"^\d{8}$") & hhmm.rlike(r"^\d{4}$"), ntz(iso))


def without(value: Column, *sentinels: float) -> Column:
    for s in sentinels:
        value = F.nullif(value, F.lit(s))
    return value


def qc_gate(value: Column, flag: Column) -> Column:
    """The value where its quality flag is zero; a flag that cannot be read nulls it too."""
    return F.when(flag == 0, value)


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def event_date(value: Column) -> Column:
    """Best effort day of a value: ISO, US month-first, slashed year-first, or epoch seconds."""
    s = F.trim(value)
    head = F.get(F.split(F.get(F.split(s, " "), 0), "T"), 0)
    us = F.regexp_replace(head, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3/$1/$2")
    parts = F.split(us, "/")
    ymd = F.when(us.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.concat_ws("-", F.get(parts, 0), F.lpad(F.get(parts, 1), 2, "0"), F.lpad(F.get(parts, 2), 2, "0")).try_cast("date"))
    epoch = F.when(s.rlike(r"^\d{9,10}(\.\d+)?$"), F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s.try_cast("double") / 86400).cast("int")))
    return F.coalesce(F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10).try_cast("date")), ymd, epoch)


def unwrapped(json: Column) -> Column:
    """A JSON text that was written once more as a JSON string, as itself; anything else as it is."""
    return F.when(F.startswith(F.trim(json), F.lit('"')), F.get_json_object(F.concat(F.lit("["), json, F.lit("]")), "$[0]")).otherwise(json)


def record_list(json: Column, *paths: str) -> Column:
    """The records of a readable payload: an array itself, or what stands at the first of the paths that is one; a lone object is one record."""
    body = unwrapped(json)
    readable = F.json_object_keys(body).isNotNull() | F.json_array_length(body).isNotNull()
    found = [F.when(F.json_array_length(body).isNotNull(), json_array(body))]
    for path in paths:
        at = F.get_json_object(body, f"$.{path}")
        found += [F.when(F.json_array_length(at).isNotNull(), json_array(at)), F.when(F.json_object_keys(at).isNotNull(), F.array(at))]
    return F.when(readable, F.coalesce(*found))


def csv_cells(line: Column, mark: str = ",") -> Column:
    """The cells of a CSV line, quotes around a cell removed and doubled ones inside it single."""
    cells = F.split(line, mark + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(cells, lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))


def text_lines(body: Column) -> Column:
    """The lines of a text that are not blank."""
    return F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x) != "")


def payload_signature(json: Column, reader: Column, unnest: Column) -> Column:
    """Sorted keys of an object or the first record; sorted column names of a CSV but ``dt``; the field count of the first text line."""
    records = F.get_json_object(json, "$.records")
    is_object = F.json_object_keys(json).isNotNull()
    target = F.when(unnest & is_object, F.coalesce(F.get_json_object(records, "$[0]"), F.lit("{}"))).when(F.json_array_length(json) >= 0, F.coalesce(F.get_json_object(json, "$[0]"), F.lit("{}"))).when(is_object, json)
    first = F.get(text_lines(json), F.lit(0))
    fields = F.coalesce(F.size(F.split(F.trim(first), r"\s+")), F.lit(0))
    return (
        F.when(reader == "json", F.array_sort(F.json_object_keys(target)))
        .when(reader == "csv", F.array_sort(F.filter(csv_cells(F.coalesce(F.get(F.split(json, r"\r?\n"), F.lit(0)), F.lit(""))), lambda c: (c != "dt") & (c != ""))))
        .otherwise(F.array(F.concat(F.lit("fields="), fields.cast("string"))))
    )


def payload_event_values(json: Column, reader: Column, unnest: Column, field: Column) -> Column:
    """What a payload writes in its event field, once per record: a JSON field by dotted path, or a CSV column by its header."""
    is_object = F.json_object_keys(json).isNotNull()
    records = F.when(unnest & is_object, json_array(json, "records")).when(F.json_array_length(json) >= 0, json_array(json)).when(is_object, F.array(json))
    from_json = F.transform(records, lambda r: F.call_function("get_json_object", r, F.concat(F.lit("$."), field)))
    lines = text_lines(json)
    at = F.array_position(csv_cells(F.get(lines, F.lit(0))), field).cast("int") - 1
    from_csv = F.when(at >= 0, F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))), lambda r: F.get(csv_cells(r), at)))
    return F.when(reader == "csv", from_csv).when(reader == "json", from_json)


def key_signature(json: Column) -> Column:
    """Sorted top-level keys of an object, or of the first record of an array."""
    return F.array_sort(F.json_object_keys(F.coalesce(F.when(F.substring(F.trim(json), 1, 1) == "[", F.get_json_object(json, "$[0]")), json)))


def classify_json(json: Column) -> Column:
    """DATA, EMPTY_LIST, EMPTY_OBJECT, EMPTY_WRAPPER, ERROR_LIKE, EMPTY_FILE or UNPARSEABLE."""
    body = F.trim(F.coalesce(json, F.lit("")))
    keys = F.json_object_keys(body)
    items = F.json_array_length(body)
    lower = F.transform(keys, lambda k: F.lower(k))
    sizes = [F.json_array_length(F.get_json_object(body, f"$.{k}")) for k in DATA_KEYS]
    alone = F.lit(False)
    full = F.lit(False)
    for k, n in zip(DATA_KEYS, sizes):
        others = F.size(F.array_except(keys, F.array(*[F.lit(x) for x in (k, *PAGING_KEYS)])))
        alone = alone | F.coalesce((n == 0) & (others == 0), F.lit(False))
        full = full | F.coalesce(n > 0, F.lit(False))
    error = F.arrays_overlap(lower, F.array(*[F.lit(x) for x in ERROR_KEYS]))
    scalar = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1  # a number, a text or a truth value
    return (
        F.when((F.coalesce(json, F.lit("")) == "") | (body == "null"), "EMPTY_FILE")
        .when(items.isNotNull(), F.when(items == 0, "EMPTY_LIST").otherwise("DATA"))
        .when(keys.isNotNull(), F.when(F.size(keys) == 0, "EMPTY_OBJECT").when(alone, "EMPTY_WRAPPER").when(error & ~full, "ERROR_LIKE").otherwise("DATA"))
        .when(scalar, "DATA")
        .otherwise("UNPARSEABLE")
    )


def classify_payload(file_name: Column, json: Column, http_status: Column) -> Column:
    """As ``classify_json`` for JSON files; a status outside 2xx wins, other readers are told by the file's ending."""
    failed = F.coalesce(~http_status.between(200, 299), F.lit(False))
    empty = F.coalesce(F.length(json), F.lit(0)) == 0
    return (
        F.when(failed, "HTTP_ERROR")
        .when(F.endswith(file_name, F.lit(".json")), classify_json(json))
        .when(empty, "EMPTY_FILE")
        .when(F.endswith(file_name, F.lit(".txt")), "TXT_DATA")
        .otherwise("CSV_DATA")
    )
