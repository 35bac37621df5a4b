"""Device scale reports: by (day, city, car) and by (day, agent)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.cells import Day, as_day, day_lit
from tidemark.operators.cumulative import State, Step, running
from tidemark.operators.frames import align, fill_keys, left_join_null_safe
from tidemark.operators.presence import count_devices, firsts, marks, presence, seen
from tidemark.operators.rollup import roll_up

CITY = ("city_sn", "car_type")
AGENT = ("parent_id",)
CITY_FILL = {"city_sn": 0, "car_type": "0"}
AGENT_FILL = {"parent_id": "0"}


@dataclass(frozen=True)
class ScaleInputs:
    """Tables of the scale reports.  ``server`` and ``client`` are the live trip
    tables; ``archive`` the monthly ones, used for cumulative figures only."""

    heartbeat: DataFrame
    server: DataFrame
    client: DataFrame
    archive: Sequence[DataFrame]
    summary: DataFrame
    abnormal: DataFrame
    calendar: DataFrame | None = None


def calendar_extension(calendar: DataFrame, today: Day,
                       default: Day = V.DEFAULT_HIGH_WATER_MARK["calendar"]) -> DataFrame:
    """The days missing between the calendar's last day and yesterday."""
    last = calendar.agg(F.coalesce(F.max("day"), day_lit(default)).alias("last"))
    days = last.select(F.date_add("last", 1).alias("a"), F.date_sub(day_lit(today), 1).alias("b"))
    return days.filter("a <= b").select(F.explode(F.sequence("a", "b")).alias("day"))


def bindings_total(bindings: DataFrame, calendar: DataFrame, keys: Sequence[str], start: Day, end: Day,
                   floor: Day = V.SCALE_HISTORY_START) -> DataFrame:
    """Bindings up to each calendar day, from the floor day on."""
    daily = bindings.groupBy(*keys, F.col("bind_day").alias("day")).agg(F.count(F.lit(1)).alias("total_dev_num"))
    days = calendar.filter(P.in_days(start, end, "day") & (F.col("day") >= day_lit(floor))).select("day").distinct()
    return running(daily, keys, ["total_dev_num"], start, end).join(days, "day", "left_semi")


def device_totals(first: DataFrame, bindings: DataFrame, keys: Sequence[str], start: Day, end: Day,
                  one_group: bool = False) -> DataFrame:
    """Distinct devices with a trip, and with a heartbeat, up to each day.

    ``first`` is ``presence.firsts`` of the whole history (or a kept table of
    it).  A trip counts from its first day.  A heartbeat counts from the later
    of the first heartbeat and the binding; of several bindings in one group the
    earliest matters.  With ``one_group`` a device's trips count in its smallest
    group only.
    """
    since = bindings.groupBy("third_code", *keys).agg(F.min("bind_day").alias("bind_day"))
    main = F.lit(True)
    if one_group:
        (key,) = keys
        main = F.col(key).eqNullSafe(F.min(key).over(Window.partitionBy("third_code")))
    since = since.withColumn("__main", main)
    joined = first.join(since, F.col("device") == F.col("third_code"))
    starts = F.array(
        F.struct(F.when(F.col("__main"), F.col("first_trip")).alias("day"), F.lit(1).alias("t"), F.lit(0).alias("h")),
        F.struct(F.when(F.col("bind_day").isNotNull() & F.col("first_beat").isNotNull(),
                        F.greatest("first_beat", "bind_day")).alias("day"), F.lit(0).alias("t"), F.lit(1).alias("h")),
    )
    daily = (
        joined.select(*keys, F.explode(starts).alias("s")).filter(F.col("s.day").isNotNull())
        .groupBy(*keys, F.col("s.day").alias("day"))
        .agg(F.sum("s.t").alias("total_trip_dev_num"), F.sum("s.h").alias("total_heartbeat_dev_num"))
    )
    return running(daily, keys, ["total_trip_dev_num", "total_heartbeat_dev_num"], start, end)


def normal_devices(bindings: DataFrame, abnormal: DataFrame, keys: Sequence[str], start: Day, end: Day) -> DataFrame:
    """Bindings up to each day without the devices on that day's abnormal list.

    Counted as all bindings minus the listed ones, so no (day, device) product
    is built.  A NULL on a day's list hides every device of that day, which is
    what NOT IN does.
    """
    bound = bindings.filter(F.col("third_code").isNotNull())
    daily = bound.groupBy(*keys, F.col("bind_day").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    total = running(daily, keys, ["n"], start, end)
    listed = abnormal.filter(P.in_days(start, end, "day")).select("day", "device_name").distinct()
    out = (
        listed.join(bound, F.col("device_name") == F.col("third_code")).filter(F.col("bind_day") <= F.col("day"))
        .groupBy("day", *keys).agg(F.count(F.lit(1)).alias("out"))
    )
    hidden = listed.filter(F.col("device_name").isNull()).select("day").distinct()
    left = total.join(hidden, "day", "left_anti").withColumnRenamed("n", "normal_dev_num").withColumn("out", F.lit(0))
    stacked = left.unionByName(out.withColumn("normal_dev_num", F.lit(None).cast("bigint")))
    kept = stacked.groupBy("day", *keys).agg((F.sum("normal_dev_num") - F.sum("out")).alias("normal_dev_num"))
    return kept.filter(F.col("normal_dev_num") > 0)


def daily_presence(rows: DataFrame, dim: DataFrame, keys: Sequence[str], start: Day, end: Day) -> DataFrame:
    """All same-day device counts from the presence bits, in one join.  ``rows`` are marks of the live tables."""
    trip = seen("server") | seen("client")
    shown = presence(rows.filter(P.in_days(start, end, "day")))
    return count_devices(shown, dim, keys, {
        "daily_trip_dev_num": trip,
        "daily_online_dev_num": seen("heartbeat") & trip,
        "daily_play_dev_num": seen("splash"),
        "daily_heartbeat_dev_num": seen("heartbeat"),
        "daily_online_dev_num_server": seen("heartbeat") & seen("server"),
        "daily_online_dev_num_client": seen("heartbeat") & seen("client"),
    })


def all_marks(t: ScaleInputs, end: Day) -> DataFrame:
    """Every sign of a device up to ``end``, from every source."""
    upto = F.col("day") <= day_lit(end)
    trip_upto = as_day(F.col("add_time")) <= day_lit(end)
    return marks(
        heartbeat=t.heartbeat.filter(upto), server=t.server.filter(trip_upto), client=t.client.filter(trip_upto),
        archive=[a.filter(trip_upto) for a in t.archive],
        splash=t.summary.filter(upto & (F.col("tag") == V.SPLASH)),
    )


def day_marks(t: ScaleInputs, start: Day, end: Day) -> DataFrame:
    """The signs of the window's days, from the live tables alone."""
    inside, trips = P.in_days(start, end, "day"), as_day(F.col("add_time")).between(day_lit(start), day_lit(end))
    return marks(heartbeat=t.heartbeat.filter(inside), server=t.server.filter(trips), client=t.client.filter(trips), archive=[],
                 splash=t.summary.filter(inside & (F.col("tag") == V.SPLASH)))


def device_firsts(t: ScaleInputs, end: Day) -> DataFrame:
    """First trip and first heartbeat per device over the history up to ``end``."""
    return firsts(all_marks(t, end).filter(~seen("splash")))


def firsts_run(t: ScaleInputs, start: Day, end: Day, before: State | None, shown: DataFrame | None = None) -> Step:
    """The same from a state: a device's first trip and first heartbeat are kept, each added when it is first seen, and only
    the live tables' days of the window are read.  Bindings are no part of it, so that a later binding moves the totals."""
    if before is None:
        return Step(device_firsts(t, end), lambda new: (None, None))
    known = merged_firsts(before.seen).withColumnsRenamed({"first_trip": "known_trip", "first_beat": "known_beat"})
    rows = day_marks(t, start, end) if shown is None else shown
    new = firsts(rows).join(known, "device", "left").select(
        "device", F.when(F.col("known_trip").isNull(), F.col("first_trip")).alias("first_trip"),
        F.when(F.col("known_beat").isNull(), F.col("first_beat")).alias("first_beat"))
    return Step(new.filter("first_trip IS NOT NULL OR first_beat IS NOT NULL"), lambda new: (None, None))


def merged_firsts(rows: DataFrame) -> DataFrame:
    """One row per device of what several runs kept."""
    return rows.groupBy("device").agg(F.min("first_trip").alias("first_trip"), F.min("first_beat").alias("first_beat"))


def device_scale(t: ScaleInputs, bindings: DataFrame, trips: DataFrame, start: Day, end: Day,
                 first: DataFrame | None = None, shown: DataFrame | None = None) -> DataFrame:
    """Device scale by (day, city, car): 13 measures on the bound groups.

    ``bindings`` has the dimension with bind days; ``trips`` are the
    ``trip_day.trip_figures`` of the window, by raw keys.  Groups without a
    binding are not reported.  ``first`` are the devices' first days and
    ``shown`` the window's ``presence``, if they are kept; else the history and
    the live tables are read.
    """
    first = device_firsts(t, end) if first is None else first
    keys = ["day", *CITY]
    # A group with a NULL key has no trips of its own: NULLs do not meet here.
    trips = trips.withColumnRenamed("date", "day").select(
        *keys, "total_play_dev_cnt", "trip_cnt", F.round(F.col("trip_time_sum") / 60, 0).alias("trip_time"))
    base = bindings_total(bindings, t.calendar, CITY, start, end).join(trips, keys, "left")
    # Some figures are not reported for a group with a NULL key.  All are matched on
    # the raw keys and labels come last, so a NULL and a real 0 keep a row each.
    known = F.col("city_sn").isNotNull() & F.col("car_type").isNotNull()
    totals = device_totals(first, bindings, CITY, start, end).withColumn(
        "total_trip_dev_num", F.when(known, F.col("total_trip_dev_num")))
    raw = ("daily_heartbeat_dev_num", "daily_online_dev_num_server", "daily_online_dev_num_client")
    daily = daily_presence(day_marks(t, start, end) if shown is None else shown, bindings, CITY, start, end).withColumns(
        {m: F.when(known, F.col(m)) for m in raw})
    frames = [totals, normal_devices(bindings, t.abnormal, CITY, start, end), daily]
    joined = left_join_null_safe(base, align(frames, keys), keys)
    measures = [
        "total_dev_num", "total_heartbeat_dev_num", "total_trip_dev_num", "total_play_dev_cnt", "normal_dev_num",
        "daily_trip_dev_num", "daily_online_dev_num", "daily_play_dev_num", "daily_heartbeat_dev_num",
        "daily_online_dev_num_server", "daily_online_dev_num_client", "trip_cnt", "trip_time",
    ]
    return fill_keys(joined.select(*keys, *measures).fillna(0, subset=measures), **CITY_FILL)


def agent_day(t: ScaleInputs, days: DataFrame, bindings: DataFrame, agents: DataFrame, start: Day, end: Day,
              first: DataFrame | None = None, shown: DataFrame | None = None) -> DataFrame:
    """Agent report by (day, agent): 14 measures over the union of all groups.

    ``bindings`` is the agent dimension with bind days (through the car table),
    ``agents`` the plain agent dimension used for event figures, ``days`` is
    ``trips.device_days`` of the window, ``first`` and
    ``shown`` as in ``device_scale``.
    """
    first = device_firsts(t, end) if first is None else first
    keys = ["day", *AGENT]
    base = bindings_total(bindings, t.calendar, AGENT, start, end)
    totals = device_totals(first, bindings, AGENT, start, end, one_group=True).withColumn(
        "total_trip_dev_num", F.when(F.col("parent_id").isNotNull(), F.col("total_trip_dev_num")))
    daily = daily_presence(day_marks(t, start, end) if shown is None else shown, bindings, AGENT, start, end).select(
        *keys, "daily_trip_dev_num", "daily_online_dev_num", "daily_play_dev_num", "daily_heartbeat_dev_num")
    facts = roll_up(
        days.withColumnRenamed("p_date", "day"), agents, keys,
        sums=["trip_cnt", "trip_time", "ad_cnt_ended", "show_video_start", "video_time", "stream_ad_ended_fulltime",
              "video_time_fulltime"],
    ).withColumnsRenamed({"trip_time": "trip_time_total", "ad_cnt_ended": "ad_cnt",
                          "stream_ad_ended_fulltime": "stream_ad_cnt_fulltime"})
    one = F.lit(1)
    frames = [
        base.withColumn("__base", one),
        totals.withColumn("__beats", (F.col("total_heartbeat_dev_num") > 0).cast("int")),
        daily.withColumn("__daily", one),
        facts.withColumn("__facts", one),
    ]
    # Trip totals belong to bound groups and make no row of their own.
    rows = align(frames, keys).filter("__base + __beats + __daily + __facts > 0").withColumn(
        "total_trip_dev_num", F.when(F.col("__base") > 0, F.col("total_trip_dev_num")).otherwise(F.lit(0)))
    return fill_keys(rows, **AGENT_FILL).select(
        *keys, "total_dev_num", "total_trip_dev_num", "daily_trip_dev_num", "daily_online_dev_num",
        "daily_play_dev_num", "trip_cnt", "trip_time_total", "ad_cnt", "show_video_start", "video_time",
        "total_heartbeat_dev_num", "daily_heartbeat_dev_num", "stream_ad_cnt_fulltime", "video_time_fulltime")
