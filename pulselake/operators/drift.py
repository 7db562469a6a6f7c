"""Problem 6: schemas that drift between files.

Every file becomes a *state*: its fields in order, the type each shows, and its
values per night. A feed's schema is a version (field to last known type) that a
file moves to the next one by explicit steps: ``renamed``, ``added``,
``removed``, ``retyped`` and ``reader``. The steps of a file are found against
the file before it and recorded. Routing a file to the consistent table chains
the renames its own feed records after it, gives defaults for fields it lacks,
casts every value to the one declared type of its field, and notes the version
and its fingerprint.

A feed is cut into chunks of its files by time; chunks are streamed file by file
on their own, and only their ends (one row per feed and chunk) are gathered per
feed to find the steps between them, so a feed with a third of all files is
spread over its chunks.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

NIGHT = "calendarDate"
CHUNK_MS = 90 * 86_400_000
_WHOLE, _NUMBER = re.compile(r"[+-]?\d+"), re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")


def _records_of(value: object) -> list[dict]:
    if isinstance(value, list):
        return [x for x in value if isinstance(x, dict)]
    if isinstance(value, dict):
        if NIGHT in value:
            return [value]
        for inner in value.values():
            got = _records_of(inner) if isinstance(inner, (list, dict)) else []
            if got:
                return got
    return []


def _read_json(body: str) -> tuple[list[str], list[dict]]:
    try:
        value = json.loads(body)
        value = json.loads(value) if isinstance(value, str) else value
        records = _records_of(value)
    except (ValueError, RecursionError):
        records = []
        for line in body.splitlines():
            try:
                records += _records_of(json.loads(line.strip().rstrip(",")))
            except (ValueError, RecursionError):
                continue
    return list(dict.fromkeys(k for r in records for k in r)), records


def _read_rows(body: str, reader: str) -> tuple[list[str], list[dict]]:
    lines = [x for x in body.replace("\0", "").splitlines() if x.strip()]
    if not lines:
        return [], []
    if reader == "txt":
        rows = [x.lstrip("# ").split() for x in lines]
    else:
        mark = max(",;\t|", key=lines[0].count)
        rows = [x for x in csv.reader(io.StringIO("\n".join(lines)), delimiter=mark)]
    head = [x.strip() for x in rows[0]]
    return list(dict.fromkeys(h for h in head if h)), [{h: v.strip() for h, v in zip(head, row) if h} for row in rows[1:]]


def _missing(value: object, reader: str) -> bool:
    return value is None or value == "" or (reader == "txt" and value == "-")


def _type_of(value: object, reader: str) -> str:
    if reader == "json":
        if isinstance(value, bool):
            return "true/false"
        if isinstance(value, (int, float)):
            return "whole number" if isinstance(value, int) else "decimal"
        return "object" if isinstance(value, (dict, list)) else "text"
    if value.lower() in ("true", "false"):
        return "true/false"
    return "whole number" if _WHOLE.fullmatch(value) else "decimal" if _NUMBER.fullmatch(value) else "text"


def _joint_type(kinds: set[str]) -> str | None:
    """One type for all values of a field: any fraction makes numbers decimal, any mixture text."""
    if kinds == {"whole number", "decimal"}:
        return "decimal"
    return (next(iter(kinds)) if len(kinds) == 1 else "text") if kinds else None


def _figure(value: object) -> str:
    """A value so that the same figure compares equal whatever the reader."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (dict, list)):
        return json.dumps(value, sort_keys=True)
    try:
        return repr(float(value))
    except (TypeError, ValueError):
        return str(value).lower() if str(value).lower() in ("true", "false") else str(value)


class FileState:
    """Reader, fields with the type each shows (None without a value), nights, and the values per field and night of one file."""

    __slots__ = ("dates", "fields", "reader", "_figures", "_seen")

    def __init__(self, reader: str, fields: dict[str, str | None], dates: set[str], seen: dict[str, list], figures: dict[str, dict[str, str]] | None = None) -> None:
        self.reader, self.fields, self.dates, self._seen = reader, fields, dates, seen
        self._figures = figures or {}

    def figures(self, name: str) -> dict[str, str]:
        """Night to figure of a field; only fields that come or go are ever asked for."""
        got = self._figures.get(name)
        if got is None:
            got = self._figures[name] = {d: _figure(v) for d, v in self._seen[name]}
        return got

    def dump(self) -> str:
        return json.dumps([self.reader, self.fields, sorted(self.dates), {n: self.figures(n) for n in self.fields}])

    @staticmethod
    def load(text: str) -> FileState:
        reader, fields, dates, figures = json.loads(text)
        return FileState(reader, fields, set(dates), {}, figures)

    def fingerprint(self) -> str:
        """Of the reader, the fields and their types: the same for every file of one schema."""
        return hashlib.md5(json.dumps([self.reader, sorted(self.fields.items())]).encode()).hexdigest()


def summarise(file_name: str | None, reader: str | None, body: str | None) -> FileState:
    """The state of one file.

    The reader is told by the file name's ending, else by ``reader``. A null or
    unreadable body has no fields.
    """
    ending = (file_name or "").rpartition(".")[2].lower()
    kind = ending if ending in ("json", "csv", "txt") else (reader or "json")
    names, records = (_read_json if kind == "json" else lambda b: _read_rows(b, kind))((body or "").lstrip("﻿"))
    nights = [str(r.get(NIGHT)) for r in records]
    fields, seen = {}, {}
    for n in names:
        if n != NIGHT:
            seen[n] = [(d, r[n]) for d, r in zip(nights, records) if n in r and not _missing(r[n], kind)]
            fields[n] = _joint_type({_type_of(v, kind) for _, v in seen[n]})
    return FileState(kind, fields, {d for d, r in zip(nights, records) if r.get(NIGHT)}, seen)


def renames(before: FileState, after: FileState) -> dict[str, str]:
    """Fields that go on under another name: the same figures on the nights both files have one for.

    Each field goes to at most one other, the pair with most equal figures
    first; a pair without any night with both figures is none.
    """
    gone = [n for n in before.fields if n not in after.fields]
    new = [n for n in after.fields if n not in before.fields]
    if not gone or not new:
        return {}
    common = before.dates & after.dates
    before_at, after_at = ({n: i for i, n in enumerate(s.fields)} for s in (before, after))
    pairs = []
    for a in gone:
        x = {d: v for d, v in before.figures(a).items() if d in common}
        for b in new:
            y = after.figures(b)
            both = [d for d in x if d in y]
            if both and all(x[d] == y[d] for d in both):
                pairs.append((-len(both), -len({x[d] for d in both}), before_at[a], after_at[b], a, b))
    found: dict[str, str] = {}
    for *_, a, b in sorted(pairs):
        if a not in found and b not in found.values():
            found[a] = b
    return found


def steps(before: FileState, after: FileState, types: dict[str, str]) -> tuple[list[tuple[str, str, str]], dict[str, str]]:
    """The changes from one file to the next, and the types known after it.

    ``types``: last known type per field before. A field without a value does
    not change its type; a renamed field keeps what was known of it until it
    shows a type; a removed field is forgotten.
    """
    changes = []
    if before.reader != after.reader:
        changes.append(("reader", before.reader, after.reader))
    moved = renames(before, after)
    back = {b: a for a, b in moved.items()}
    changes += [("renamed", a, b) for a, b in moved.items()]
    changes += [("removed", n, "") for n in before.fields if n not in after.fields and n not in moved]
    changes += [("added", "", n) for n in after.fields if n not in before.fields and n not in back]
    known = {}
    for n, kind in after.fields.items():
        last = types.get(n) if n in before.fields else types.get(back[n]) if n in back else None
        if kind and last and kind != last and n in before.fields:
            changes.append(("retyped", n, n))
        if kind or last:
            known[n] = kind or last
    return changes, known


ROWS = "feed_id long, file_id long, fetched_ms long"
CHANGE = "feed_id long, file_id long, change_kind string, old_field string, new_field string"
PART = f"{CHANGE}, at long, head string, tail string, pending string, passed string, known string"


def _schema(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _ordered(files: DataFrame) -> DataFrame:
    """Files with a feed, the chunks of feeds apart and each in order of time."""
    rows = files.where(F.col("feed_id").isNotNull()).withColumn("fetched_ms", F.coalesce("fetched_ms", F.lit(0))).withColumn("__chunk", F.floor(F.col("fetched_ms") / CHUNK_MS))
    return rows.repartition("feed_id", "__chunk").sortWithinPartitions("feed_id", "__chunk", "fetched_ms", "file_id")


def _states(batch: pa.RecordBatch) -> Iterator[FileState]:
    """The state of each file of a batch, read from its body or as it was kept."""
    if "state" in batch.schema.names:
        return map(FileState.load, batch.column("state").to_pylist())
    return (summarise(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("file_name", "reader", "body"))))


class _Chunk:
    """The files of a chunk one after the other: their changes, and one row with the chunk's ends.

    ``pending``: fields present from the first file on without a value, with
    the first type each later shows and where; whether that is a retyping is
    known only from the chunk before. ``passed``: of those, what name each has
    at the end, still without a type. ``known``: types at the end.
    """

    def __init__(self, feed: int, file_id: int, at: int, first: FileState) -> None:
        self.feed, self.file_id, self.at, self.first, self.last = feed, file_id, at, first.dump(), first
        self.types = {n: k for n, k in first.fields.items() if k}
        self.unknown = {n: n for n, k in first.fields.items() if not k}  # name now -> name in the first file
        self.pending: list[list] = []

    def take(self, file_id: int, after: FileState) -> list[tuple]:
        changes, known = steps(self.last, after, self.types)
        moved = {a: b for kind, a, b in changes if kind == "renamed"}
        still = {}
        for now, start in self.unknown.items():
            name = now if now in after.fields else moved.get(now)
            if name is None:
                continue
            if after.fields[name]:
                self.pending.append([start, after.fields[name], file_id, name if name == now else None])
            else:
                still[name] = start
        self.unknown, self.types, self.last = still, known, after
        return [(self.feed, file_id, *c, None, None, None, None, None, None) for c in changes]

    def ends(self) -> tuple:
        return (self.feed, self.file_id, None, None, None, self.at, self.first, self.last.dump(), json.dumps(self.pending), json.dumps(self.unknown), json.dumps(self.types))


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in PART.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _schema(PART))


def _changes_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes and ends of every chunk of a sorted partition; no more than the file before is held."""
    chunk, key, rows = None, None, []
    for batch in batches:
        feeds, ids, times, parts = (batch.column(c).to_pylist() for c in ("feed_id", "file_id", "fetched_ms", "__chunk"))
        for feed, i, at, part, state in zip(feeds, ids, times, parts, _states(batch)):
            if (feed, part) == key:
                rows += chunk.take(i, state)
            else:
                if chunk is not None:
                    rows.append(chunk.ends())
                chunk, key = _Chunk(feed, i, at, state), (feed, part)
        if len(rows) > 5_000:
            yield _part_batch(rows)
            rows = []
    if chunk is not None:
        rows.append(chunk.ends())
        yield _part_batch(rows)


def _changes_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes between the chunks of each feed, from the chunks' ends in order of feed and time."""
    feed, tail, types = None, None, {}
    for batch in batches:
        rows: list[tuple] = []
        for now, file_id, first, last, pending, passed, known in zip(*(batch.column(c).to_pylist() for c in ("feed_id", "file_id", "head", "tail", "pending", "passed", "known"))):
            head, start = FileState.load(first), {}
            if now == feed:
                changes, start = steps(tail, head, types)
                rows += [(now, file_id, *c) for c in changes]
            for name, kind, where, same in json.loads(pending):
                if same and start.get(name) and start[name] != kind:
                    rows.append((now, where, "retyped", same, same))
            types = json.loads(known)
            types |= {n: start[name] for n, name in json.loads(passed).items() if start.get(name)}
            feed, tail = now, head if last == first else FileState.load(last)
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.string()) for k, c in enumerate(cols)], _schema(CHANGE))


def schema_changes(files: DataFrame) -> DataFrame:
    """``(feed_id, file_id, change_kind, old_field, new_field)`` of every change, at the later file.

    ``files`` has ``feed_id, file_id, fetched_ms, file_name, reader, body``.
    Files without feed are left out; a null ``fetched_ms`` comes first; ties are
    by ``file_id``; a file that cannot be read has no fields, so all of them are
    removed and added again. No files give no rows. The summaries' changes are
    kept as a table in the shared folder, as two results are read from it.
    """
    spark = files.sparkSession
    what = ["state"] if "state" in files.columns else ["file_name", "reader", "body"]
    ordered = _ordered(files.select("feed_id", "file_id", "fetched_ms", *what)).select(*_schema(ROWS), "__chunk", *what)
    path = shared_dir(spark, "schema-changes")
    ordered.mapInArrow(_changes_within, PART).write.parquet(path)
    kept = spark.read.schema(PART).parquet(path)
    inside = kept.where(F.col("change_kind").isNotNull()).select("feed_id", "file_id", "change_kind", "old_field", "new_field")
    ends = kept.where(F.col("at").isNotNull()).drop("change_kind", "old_field", "new_field").repartition("feed_id").sortWithinPartitions("feed_id", "at", "file_id")
    between = ends.mapInArrow(_changes_between, CHANGE)
    return inside.unionByName(between)


def canonical_names(changes: DataFrame, states: DataFrame) -> dict[str, str]:
    """Each renamed field to the one name for all it was renamed from or to, in any feed.

    Pairs are joined in order of how many files record them, but never so that
    two names come together which stand side by side in one file: those are two
    fields, whatever another feed calls them. Only names that take part in a
    rename are looked at, so what comes to the driver is bounded by the number
    of *field names* squared, not by files.
    """
    pairs = changes.where(F.col("change_kind") == "renamed").groupBy("old_field", "new_field").agg(F.count(F.lit(1)).alias("n")).collect()
    names = sorted({n for p in pairs for n in (p["old_field"], p["new_field"])})
    root = {n: {n} for n in names}
    if not pairs:
        return {}

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = set(names), set()
        for batch in batches:
            for state in _states(batch):
                seen.add(tuple(sorted(known.intersection(state.fields))))
        two = sorted({(a, b) for group in seen for i, a in enumerate(group) for b in group[i + 1 :]})
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in two], pa.string()) for k in (0, 1)], ["a", "b"])

    apart = {(r["a"], r["b"]) for r in states.select("state").mapInArrow(beside, "a string, b string").distinct().collect()}
    for p in sorted(pairs, key=lambda p: (-p["n"], p["old_field"], p["new_field"])):
        x, y = root[p["old_field"]], root[p["new_field"]]
        if x is not y and not any((min(a, b), max(a, b)) in apart for a in x for b in y):
            x |= y
            for n in y:
                root[n] = x
    return {n: min(group) for n, group in root.items()}


def _routed(name: str, at: int, file_id: int, recorded: list) -> str:
    """The last name of a file's field in its feed: the later renames one after the other, until it is removed."""
    for when, i, kind, old, new in recorded:
        if old == name and kind in ("renamed", "removed") and (when, i) > (at, file_id):
            if kind == "removed":
                break
            name = new
    return name


_UNIT = re.compile(r"\s*([+-]?\d+(?:\.\d+)?)\s*(?:/\S*)?")
NUMERIC, ARROW = ("whole number", "decimal"), {"whole number": pa.int64(), "decimal": pa.float64(), "true/false": pa.bool_(), "text": pa.string()}
SPARK = {"whole number": "long", "decimal": "double", "true/false": "boolean", "text": "string"}


def declared_type(shown: Counter) -> str:
    """One type for a field from how many files show each: what most of them show, numbers counted together; decimal if any number is; an object counts for what it holds."""
    groups = Counter({"number": sum(shown[k] for k in NUMERIC), "true/false": shown["true/false"], "text": shown["text"]})
    kind = max(("number", "true/false", "text"), key=lambda k: groups[k])
    return kind if kind != "number" else "decimal" if shown["decimal"] else "whole number"


def cast_figure(figure: str | None, shown: str | None, kind: str) -> object:
    """A figure of a file that shows the type ``shown`` as a value of the declared type; None if it cannot be one.

    An object stands for its ``value``; a number may have a unit behind a slash;
    1 and 0 are true and false; a fraction is no whole number.
    """
    if figure is None:
        return None
    if shown == "object" and kind != "text":
        inner = json.loads(figure)
        inner = inner.get("value") if isinstance(inner, dict) else None
        return None if inner is None else cast_figure(_figure(inner), None, kind)
    if kind == "text":
        return figure[:-2] if shown == "whole number" and figure.endswith(".0") else figure
    if kind == "true/false":
        return {"true": True, "1.0": True, "false": False, "0.0": False}.get(figure)
    m = _UNIT.fullmatch(figure)
    try:
        number = float(m.group(1)) if m else float(figure)
    except ValueError:
        return {"true": 1, "false": 0}.get(figure)
    if not np.isfinite(number):
        return None
    return number if kind == "decimal" else int(number) if number.is_integer() else None


def routed_table(files: DataFrame) -> DataFrame:
    """All files as one wide table: ``feed_id, file_id, version, fingerprint, night``, a typed column per field, and ``uncast``.

    A file is routed by the version of its own feed: the renames recorded for
    that feed after it are chained, and the feed's last name leads to the name
    of all feeds (``canonical_names``). Where two fields of one file would still
    come under one name, the feed keeps its own last names for them. A field has
    one declared type over all files; a file that lacks it has null, the
    default. ``version`` counts the files of the feed that changed its schema up
    to this one, ``fingerprint`` is that of the file's reader, fields and types,
    ``uncast`` tells how many of the night's values have no form in their
    declared type. Every file is read once; its state is kept in the shared
    folder. Whole numbers beyond 2^53 lose digits, numbers in a text field
    leading zeros. No files give a table without fields.
    """
    spark = files.sparkSession
    kept, keep = shared_dir(spark, "file-states"), f"{ROWS}, state string"

    def state_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _schema(ROWS)), pa.array([s.dump() for s in _states(batch)], pa.string())], _schema(keep))

    rows = files.where(F.col("feed_id").isNotNull()).select("feed_id", "file_id", F.coalesce("fetched_ms", F.lit(0)).alias("fetched_ms"), "file_name", "reader", "body")
    rows.mapInArrow(state_of, keep).write.parquet(kept)
    states = spark.read.schema(keep).parquet(kept)
    changes = schema_changes(states)
    names = canonical_names(changes, states)
    at = states.select("feed_id", "file_id", F.col("fetched_ms").alias("at"))
    # a feed's record grows with its changes, not its files; joined by size, and split by the engine where a feed is hot
    recorded = changes.join(at, ["feed_id", "file_id"]).groupBy("feed_id").agg(F.sort_array(F.collect_list(F.struct("at", "file_id", "change_kind", "old_field", "new_field"))).alias("steps")).select("feed_id", F.to_json(F.transform("steps", lambda x: F.array(x["at"].cast("string"), x["file_id"].cast("string"), x["change_kind"], x["old_field"], x["new_field"]))).alias("recorded"))
    path, shape = shared_dir(spark, "routed-files"), f"{keep}, version int, last string"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, of = [], None
        for batch in batches:
            versions, last = [], []
            for feed, i, when, state, text in zip(*(batch.column(c).to_pylist() for c in (*_schema(ROWS), "state", "recorded"))):
                if (feed, text) != of:
                    of, record = (feed, text), [(int(a), int(b), *rest) for a, b, *rest in json.loads(text or "[]")]
                versions.append(len({(a, b) for a, b, *_ in record if (a, b) <= (when, i)}))
                last.append(json.dumps({n: _routed(n, when, i, record) for n in FileState.load(state).fields}))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _schema(keep)), pa.array(versions, pa.int32()), pa.array(last, pa.string())], _schema(shape))

    states.join(recorded, "feed_id", "left").select(*_schema(keep), "recorded").mapInArrow(route, shape).write.parquet(path)
    routed = spark.read.schema(shape).parquet(path)

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clash, seen = set(), Counter()
        for batch in batches:
            for feed, text, last in zip(*(batch.column(c).to_pylist() for c in ("feed_id", "state", "last"))):
                fields, last = FileState.load(text).fields, json.loads(last)
                common = Counter(names.get(x, x) for x in last.values())
                clash |= {(feed, x) for x, n in common.items() if n > 1}
                for n, kind in fields.items():
                    seen[last[n], kind or ""] += 1
        out = [(None, n, k, c) for (n, k), c in seen.items()] + [(f, x, None, None) for f, x in clash]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64()))], ["feed_id", "field", "kind", "n"])

    told = routed.select("feed_id", "state", "last").mapInArrow(shown, "feed_id long, field string, kind string, n long").groupBy("feed_id", "field", "kind").agg(F.sum("n").alias("n")).collect()
    split = {(r["feed_id"], r["field"]) for r in told if r["kind"] is None}
    parted = {field for _, field in split}
    counted: dict[str, Counter] = {}
    for r in told:
        if r["kind"] is not None:
            common = names.get(r["field"], r["field"])
            for name in {common, r["field"]} if common in parted else {common}:
                counted.setdefault(name, Counter())[r["kind"]] += r["n"]
    types = {n: declared_type(c) for n, c in sorted(counted.items())}
    order = {n.lower(): n for n in types}
    column = {n: n if order[n.lower()] == n and n.lower() not in ("feed_id", "file_id", "version", "fingerprint", "night", "uncast") else f"{n}_{k}" for k, n in enumerate(types)}

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head: list[tuple] = []
            values: dict[str, list] = {n: [] for n in types}
            for feed, i, version, text, last in zip(*(batch.column(c).to_pylist() for c in ("feed_id", "file_id", "version", "state", "last"))):
                state, last = FileState.load(text), json.loads(last)
                mark, source = state.fingerprint(), {}
                for n in state.fields:
                    common = names.get(last[n], last[n])
                    source[last[n] if (feed, common) in split else common] = n
                nights = sorted({*state.dates, *(d for n in state.fields for d in state.figures(n))})
                lost = dict.fromkeys(nights, 0)
                for field, kind in types.items():
                    n = source.get(field)
                    figures = state.figures(n) if n is not None else {}
                    for d in nights:
                        v = cast_figure(figures.get(d), state.fields.get(n), kind) if figures else None
                        lost[d] += v is None and d in figures
                        values[field].append(v)
                head += [(feed, i, version, mark, d, lost[d]) for d in nights]
            cols = list(zip(*head)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*arrays[:5], *(pa.array(values[n], ARROW[k]) for n, k in types.items()), arrays[5]], ["feed_id", "file_id", "version", "fingerprint", "night", *column.values(), "uncast"])

    ddl = ["feed_id long", "file_id long", "version int", "fingerprint string", "night string", *(f"`{column[n]}` {SPARK[k]}" for n, k in types.items()), "uncast int"]
    return routed.select("feed_id", "file_id", "version", "state", "last").mapInArrow(wide, ", ".join(ddl))
