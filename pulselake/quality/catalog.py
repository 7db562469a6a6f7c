"""The catalog of endpoints as a table: what a pull calls, what it must never call, what it misses.

A catalog has ``name, method, kind, collection`` and may have ``skip_if_none``,
``skip_if_empty`` and ``screen_secrets``. Nothing here talks to a network: a
pull is a table of calls that some client carries out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How an endpoint's arguments are made, statuses of goals, beginnings of methods that change something, methods that move no data, and getters whose data other endpoints hold.
KINDS = ("daily", "range", "weekly", "static", "static_goals", "per_profile", "per_device", "per_device_range")
GOAL_STATUSES = ("active", "past", "future")
CHANGING = ("add_", "set_", "create_", "update_", "upload_", "delete_", "remove_", "schedule_", "unschedule_", "reset_", "sync_", "archive_", "merge_", "post_", "put_", "patch_", "edit_", "save_", "import_")
PLUMBING = ("login", "logout", "resume_login", "request_reload", "query_garmin_graphql", "count_activities", "get_unit_system", "get_full_name", "garth", "connectapi", "download", "modern_url", "garmin_connect_user_settings")
REDUNDANT = ("get_stats", "get_stats_and_body", "get_stress_data", "get_activities", "get_last_activity")


def _begins(c: Column, starts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.startswith(c, F.lit(s)) for s in starts])


def never_called(method: Column) -> Column:
    """True for a method that changes something or moves no data."""
    return _begins(method, CHANGING) | method.isin(*PLUMBING)


def forbidden(catalog: DataFrame) -> DataFrame:
    """Catalogued methods that must not be called: none, if the catalog is sound."""
    return catalog.where(never_called(F.col("method"))).select("method").distinct()


def uncatalogued(methods: DataFrame, catalog: DataFrame) -> DataFrame:
    """Readable methods of a client (a column ``method``) that the catalog does not know: data a new version may offer."""
    m = F.col("method")
    readable = methods.where(_begins(m, ("get_", "download_")) & ~never_called(m) & ~m.isin(*REDUNDANT))
    return readable.select("method").distinct().join(catalog.select("method").distinct(), "method", "left_anti")


def calls(catalog: DataFrame, days: list[str], devices: DataFrame, profile: str, weeks: int = 1) -> DataFrame:
    """``(name, method, collection, day, arguments)``: every call of a pull over ``days`` (``YYYY-MM-DD``, in order).

    Daily endpoints are called for each day, ranges for the first to the last,
    weekly ones for the weeks up to the last, goals once per status, and those
    per device for every ``device_id``. Without days only calls without a day
    are left; an unknown kind gives no call.
    """
    text = lambda *xs: F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs]).cast("array<string>")
    first, last = (days[0], days[-1]) if days else (None, None)
    kind, lists = F.col("kind"), F.array(F.array().cast("array<string>"))
    each_day = F.array(*[text(d) for d in days]) if days else F.array().cast("array<array<string>>")
    ranged = F.array(text(first, last)) if days else F.array().cast("array<array<string>>")
    weekly = F.array(text(last, str(weeks))) if days else F.array().cast("array<array<string>>")
    alone = (
        F.when(kind == "daily", each_day).when(kind == "range", ranged).when(kind == "weekly", weekly).when(kind == "static", lists)
        .when(kind == "static_goals", F.array(*[text(s) for s in GOAL_STATUSES])).when(kind == "per_profile", F.array(text(profile)))
    )
    own = ["name", "method", "collection"]
    single = catalog.select(*own, F.col("kind"), F.explode(alone).alias("arguments"))
    device = F.col("device_id").cast("string")
    wanted = catalog.where(kind.isin("per_device", "per_device_range")).select(*own, "kind", F.lit(1).alias("__all"))
    fanned = wanted.join(devices.select("device_id", F.lit(1).alias("__all")).distinct(), "__all")  # every device is called by every such endpoint: that product is the plan
    per_device = fanned.where((kind == "per_device") | F.lit(bool(days))).select(*own, "kind", F.when(kind == "per_device", text(device)).otherwise(text(device, first, last)).alias("arguments"))
    day = F.when(F.col("kind") == "daily", F.get("arguments", F.lit(0))).otherwise(F.lit(last))
    return single.unionByName(per_device).select(*own, day.alias("day"), "arguments")


def check_config(catalog: DataFrame, important: list[str], sparse: list[str]) -> DataFrame:
    """Check configuration of catalogued endpoints: important ones must have data, sparse ones may be empty."""
    c = F.col("collection")
    return catalog.withColumn("severity", F.when(c.isin(important), "ERROR").otherwise("WARN")).withColumn("expected_empty", F.when(c.isin(important), False).otherwise(c.isin(sparse)))


def stuck_cursors(pages: DataFrame, stream: list[str]) -> DataFrame:
    """Tokens a stream was given more than once: a cursor that does not advance. Null tokens end a stream and do not count."""
    seen = pages.where(F.col("next_token").isNotNull()).groupBy(*stream, "next_token").agg(F.count(F.lit(1)).alias("times"))
    return seen.where(F.col("times") > 1)


def queue_too_deep(runs: DataFrame, most: int = 15) -> DataFrame:
    """``(queued, passed)``: whether no more runs than ``most`` are waiting."""
    return runs.agg(F.count_if(F.col("status") == "QUEUED").alias("queued")).withColumn("passed", F.col("queued") <= most)
