"""Problem 4: deeply nested records to related flat tables.

Columnar shredding: a declared tree of fields gives, for each leaf, a column of
values with a *repetition level* (which repeated ancestor started anew) and a
*definition level* (how many optional or repeated steps down to the leaf were
there). The levels alone suffice to rebuild a flat table for any repeated
ancestor, with the position of each row among its siblings and the row number
of its parent: ``assemble`` does that with cumulative sums over the level
sequences and never looks at the records again.

A node names several places it may be found at, as shapes vary between
captures; a lone object in place of an array is one child; an object keyed by
id in place of an array is one child per key, the key available as ``KEY``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "#key"


@dataclass(frozen=True)
class Leaf:
    """A scalar field; ``places`` are dotted paths tried in order for the first value that is not null."""

    name: str
    places: tuple[str, ...]


@dataclass(frozen=True)
class Repeated:
    """A repeated group; ``places`` as for leaves, ``""`` being the parent value itself.

    ``keyed``: an object without any of ``marks`` is a map of children by key.
    ``key``: the leaf that names a row of the flat table; its position without one.
    """

    name: str
    places: tuple[str, ...]
    leaves: tuple[Leaf, ...] = ()
    groups: tuple[Repeated, ...] = ()
    keyed: bool = False
    marks: tuple[str, ...] = ()
    key: str | None = None


@dataclass
class Levels:
    """One leaf column: values with repetition and definition levels."""

    depth: int
    rep: list[int] = field(default_factory=list)
    dfn: list[int] = field(default_factory=list)
    val: list = field(default_factory=list)

    def add(self, r: int, d: int, v: object) -> None:
        self.rep.append(r)
        self.dfn.append(d)
        self.val.append(v)


def _dig(value: object, place: str) -> object:
    for step in place.split(".") if place else ():
        if not isinstance(value, dict):
            return None
        value = value.get(step)
    return value


def _first(value: object, places: tuple[str, ...], key: str | None) -> object:
    for p in places:
        got = key if p == KEY else _dig(value, p)
        if got is not None and not isinstance(got, (dict, list)):
            return got
    return None


def _children(value: object, node: Repeated) -> list[tuple[str | None, object]]:
    for p in node.places:
        got = _dig(value, p) if p else value
        if isinstance(got, list):
            return [(None, x) for x in got]
        if isinstance(got, dict) and (p or any(m in got for m in node.marks)):
            if node.keyed and not any(m in got for m in node.marks):
                return [(k, v) for k, v in got.items()]
            return [(None, got)]
    return []


class Shredder:
    """Shreds values along a tree of repeated groups into leaf columns with levels."""

    def __init__(self, root: Repeated) -> None:
        self.root = root
        self.columns: dict[tuple[str, ...], Levels] = {}
        self._declare(root, (), 1)

    def _declare(self, node: Repeated, path: tuple[str, ...], depth: int) -> None:
        here = (*path, node.name)
        for leaf in node.leaves:
            self.columns[(*here, leaf.name)] = Levels(depth)
        for g in node.groups:
            self._declare(g, here, depth + 1)

    def add(self, record: object) -> None:
        self._walk(record, self.root, (), 0, 0, 1)

    def _absent(self, node: Repeated, path: tuple[str, ...], r: int, d: int) -> None:
        here = (*path, node.name)
        for leaf in node.leaves:
            self.columns[(*here, leaf.name)].add(r, d, None)
        for g in node.groups:
            self._absent(g, here, r, d)

    def _walk(self, value: object, node: Repeated, path: tuple[str, ...], r: int, d: int, depth: int) -> None:
        found = _children(value, node)
        if not found:
            self._absent(node, path, r, d)
            return
        here = (*path, node.name)
        for k, (key, child) in enumerate(found):
            rep = r if k == 0 else depth
            for leaf in node.leaves:
                v = _first(child, leaf.places, key)
                self.columns[(*here, leaf.name)].add(rep, depth * 2 if v is not None else depth * 2 - 1, v)
            for g in node.groups:
                self._walk(child, g, here, rep, depth * 2 - 1, depth + 1)


def assemble(columns: dict[tuple[str, ...], Levels], ancestor: tuple[str, ...]) -> dict[str, np.ndarray]:
    """The flat table of a repeated ancestor from level sequences.

    Columns: ``record`` (number of the shredded record), ``parent`` (row of the
    table one level up, -1 at the top), ``position`` among siblings, and each
    leaf of the ancestor. A row exists where the definition level reaches the
    ancestor; its repetition level tells which ancestors began with it.
    """
    depth, out = len(ancestor), {}
    for path, col in columns.items():
        if path[:-1] != ancestor:
            continue
        rep, dfn = np.array(col.rep, np.int64), np.array(col.dfn, np.int64)
        there = dfn >= 2 * depth - 1
        if not out:
            out["record"] = (np.cumsum(rep == 0) - 1)[there]
            out["parent"] = (np.cumsum((rep < depth) & (dfn >= 2 * depth - 3)) - 1)[there] if depth > 1 else np.full(int(there.sum()), -1)
            began = np.maximum.accumulate(np.where(rep < depth, np.arange(len(rep)), 0)) if len(rep) else rep
            out["position"] = (np.arange(len(rep)) - began)[there]
        values = np.empty(len(col.val), object)
        values[:] = col.val
        out[path[-1]] = values[there]
    return out


def read_json(body: str | None) -> object:
    """The value of a JSON text, also where it was wrapped once more as a string; None if unreadable."""
    if body is None:
        return None
    try:
        value = json.loads(body.lstrip("﻿"))
        return json.loads(value.lstrip("﻿")) if isinstance(value, str) else value
    except (ValueError, RecursionError):
        return None


def _text(v: object) -> str:
    return v if isinstance(v, str) else json.dumps(v)


# The two shapes of TESTDATA.md: Whoop sleep pages and Garmin training-status captures.
SLEEP_PAGE = Repeated(
    "sleep",
    ("records", "data.records", ""),
    (Leaf("id", ("id",)), Leaf("performance", ("score.sleep_performance_percentage", "score.performance.percentage")), Leaf("start", ("start",)), Leaf("nap", ("nap",))),
    (Repeated("segment", ("score.stage_summary.segments",), (Leaf("stage", ("stage",)), Leaf("milli", ("milli",))), marks=("stage", "milli")),),
    marks=("id", "start", "score"),
    key="id",
)
TRAINING_STATUS = Repeated(
    "device",
    ("mostRecentTrainingStatus.latestTrainingStatusData", "latestTrainingStatusData"),
    (Leaf("device_id", ("deviceId", KEY)), Leaf("training_status", ("trainingStatus",)), Leaf("weekly_load", ("weeklyTrainingLoad",))),
    (Repeated("load_day", ("acuteTrainingLoadDTO.loadDays", "loadDays"), (Leaf("calendar_date", ("calendarDate",)), Leaf("load", ("load",))), marks=("calendarDate", "load"), key="calendar_date"),),
    keyed=True,
    marks=("deviceId", "trainingStatus", "loadDays", "acuteTrainingLoadDTO", "calendarDate"),
    key="device_id",
)

LINK = "payload_id long, link_kind string, parent_key string, child_key string"
ROW = "payload_id long, table_name string, parent_key string, position int, row_key string, fields map<string,string>"


def _rows_of(ids: list[int], bodies: list[str | None], root: Repeated) -> Iterator[tuple]:
    """Rows of the flat tables of every repeated group, of any depth, as (payload, table, parent key, position, key, leaves).

    A row whose own key is null, and all below it, do not count.
    """
    shred, kept = Shredder(root), []
    for i, body in zip(ids, bodies):
        value = read_json(body)
        if isinstance(value, (dict, list)):
            shred.add(value)
            kept.append(i)

    def rows(node: Repeated, path: tuple[str, ...], above: list[str | None] | None) -> Iterator[tuple]:
        here = (*path, node.name)
        t = assemble(shred.columns, here)
        n = len(t.get("record", ()))
        own = t[node.key] if n and node.key else t.get("position", ())
        keys: list[str | None] = []
        for k in range(n):
            payload = kept[t["record"][k]]
            parent = str(payload) if above is None else above[t["parent"][k]]
            keys.append(None if parent is None or own[k] is None else _text(own[k]) if node.key else str(own[k]))
            if keys[-1] is not None:
                yield payload, node.name, parent, int(t["position"][k]), keys[-1], {x.name: t[x.name][k] for x in node.leaves}
        for g in node.groups:
            yield from rows(g, here, keys)

    yield from rows(root, (), None)


def flat_rows(payloads: DataFrame, shapes: dict[str, Repeated] | None = None) -> DataFrame:
    """Rows of the flat tables of all repeated groups, each naming its parent.

    ``payloads`` has ``payload_id``, ``collection_name`` and ``body``; ``shapes``
    gives the tree of each collection, by default the two of TESTDATA.md.
    Payloads that are null, cut off or not JSON give no rows; records without
    the leaf that names them, and all below them, do not count. Equal rows of
    one payload stay (they differ in position). Other collections give no rows.
    """
    shapes = shapes or {"sleep": SLEEP_PAGE, "training_status": TRAINING_STATUS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            got: list[tuple] = []
            for name, root in shapes.items():
                at = [k for k, c in enumerate(x["collection_name"]) if c == name]
                got += _rows_of([x["payload_id"][k] for k in at], [x["body"][k] for k in at], root)
            cols = list(zip(*got)) if got else [()] * 6
            fields = [[(n, None if v is None else _text(v)) for n, v in f.items()] for f in cols[5]]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.string()), pa.array(fields, pa.map_(pa.string(), pa.string()))], ["payload_id", "table_name", "parent_key", "position", "row_key", "fields"])

    return payloads.select("payload_id", "collection_name", "body").mapInArrow(run, ROW)


def links(payloads: DataFrame) -> DataFrame:
    """``(payload_id, link_kind, parent_key, child_key)``: one row per link of the flat tables."""
    rows = flat_rows(payloads)
    has = {"sleep": ("scored_sleep", "performance"), "device": ("coded_device", "training_status")}
    kinds = F.array(F.col("table_name"))
    for name, (extra, leaf) in has.items():
        kinds = F.when((F.col("table_name") == name) & F.col("fields")[leaf].isNotNull(), F.array(F.col("table_name"), F.lit(extra))).otherwise(kinds)
    return rows.select("payload_id", F.explode(kinds).alias("link_kind"), "parent_key", F.col("row_key").alias("child_key")).distinct()
