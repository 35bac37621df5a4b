"""The daily runs: every report with its table, load mode and order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.attribution import Rules
from tidemark.functions.cells import as_day, day_lit
from tidemark.operators import dims
from tidemark.operators.cumulative import State, Step
from tidemark.operators.frames import day_spine
from tidemark.operators.presence import presence
from tidemark.operators.trips import device_days
from tidemark.plans import clicks, interaction, plays, retail, scale, trip_day
from tidemark.sinks.days import read_loaded, read_report, replace_parts
from tidemark.sources import logs
from tidemark.sources import schemas as S
from tidemark.sources.tables import read_parquet
from tidemark.streaming.incremental import DayWindow, Report
from tidemark.streaming.kept import kept
from tidemark.streaming.shared import Shared


@dataclass(frozen=True)
class ScreenTables:
    """Inputs of the screen run."""

    events: DataFrame
    service: DataFrame
    info: DataFrame
    car: DataFrame
    snapshot: DataFrame
    heartbeat: DataFrame
    server_trips: DataFrame
    client_trips: DataFrame
    archived_trips: Sequence[DataFrame]
    summary: DataFrame
    abnormal: DataFrame
    excluded: P.Excluded


def read_screen_tables(spark: SparkSession, folder: str, archives: Sequence[str]) -> ScreenTables:
    """The input tables of the screen run from one folder, with their declared schemas; ``archives`` are the names of the
    archived trip tables."""
    def table(name: str, schema: str) -> DataFrame:
        return read_parquet(spark, f"{folder}/{name}", schema)

    return ScreenTables(
        table("screen_event", S.SCREEN_EVENT), table("device_service", S.DEVICE_SERVICE), table("screen_info", S.SCREEN_INFO),
        table("screen_car", S.SCREEN_CAR), table("device_snapshot", S.DEVICE_SNAPSHOT), table("heartbeat_day", S.HEARTBEAT),
        table("trip_server", S.TRIP), table("trip_client", S.TRIP), [table(a, S.TRIP) for a in archives],
        table("sensor_summary", S.SENSOR_SUMMARY), table("abnormal_device", S.ABNORMAL_DEVICE),
        P.exclusions(table("excluded_device", S.EXCLUDED_DEVICE)))


def screen_reports(spark: SparkSession, t: ScreenTables, devices: dims.DeviceRules, campaigns: Rules,
                   root: str, first_mark: dt.date | None = None) -> list[Report]:
    """Reports of the in-car screens, in load order.

    What several reports need is shared: the device tables joined once, presence and device days of the window, the play, click and
    scan rows of the window, the trip figures.  Cumulative reports read new days from these once they have a
    state.  The scale reports read the calendar from its table.  ``first_mark`` replaces the built-in marks of empty tables.
    """
    shared = Shared(spark, f"{root}/shared")
    live = scale.ScaleInputs(t.heartbeat, t.server_trips, t.client_trips, t.archived_trips, t.summary, t.abnormal)

    def bound() -> DataFrame:
        return shared.get("bound", None, lambda: dims.bound(t.service, t.info, devices))

    def cars() -> DataFrame:
        return shared.get("cars", None, lambda: dims.with_car(bound(), t.car))

    def city() -> DataFrame:
        return dims.cities_of(cars(), devices)

    def days(w: DayWindow) -> DataFrame:
        return shared.get("device_days", w, lambda: device_days(P.prod_events(t.events, t.excluded, w.start, w.end)))

    def shown(w: DayWindow) -> DataFrame:
        return shared.get("presence", w, lambda: presence(scale.day_marks(live, w.start, w.end)))

    def figures(w: DayWindow) -> DataFrame:
        return shared.get("trip_figures", w, lambda: trip_day.trip_figures(
            days(w), t.snapshot, t.heartbeat, city(), w.start, w.end, shown=shown(w)))

    def plays_of(w: DayWindow, s: object = True) -> tuple[DataFrame, P.Excluded]:
        """The rows of the play, click and scan reports and the devices to leave out; without a state, the whole log."""
        if s is None:
            return t.events, t.excluded
        return shared.get("play_rows", w, lambda: plays.play_rows(t.events, t.excluded, w.start, w.end)), None

    def inputs() -> scale.ScaleInputs:
        return replace(live, calendar=spark.read.parquet(f"{root}/calendar"))

    def first() -> DataFrame:
        return scale.merged_firsts(kept(spark, f"{root}/device_firsts").state.seen)

    def report(name, build, day="date", since=None, **kw):
        """``since`` names the report whose first day this one shares."""
        return Report(name, build, day, default=first_mark or (V.DEFAULT_HIGH_WATER_MARK[since] if since else None), shared=shared, **kw)

    def content_play_day(w: DayWindow) -> DataFrame:
        rows, excluded = plays_of(w)
        return plays.content_play_day(rows, campaigns, excluded, w.start, w.end)

    def content_play_total(w: DayWindow, s: State | None) -> Step:
        rows, excluded = plays_of(w, s)
        return plays.content_play_run(rows, excluded, w.start, w.end, s)

    def scan_total(w: DayWindow, s: State | None) -> Step:
        rows, excluded = plays_of(w, s)
        return plays.scan_run(rows, campaigns, excluded, w.start, w.end, s)

    def ad_total(run) -> Callable[[DayWindow, State | None], Step]:
        def step(w: DayWindow, s: State | None) -> Step:
            rows, excluded = plays_of(w, s)
            return run(rows, city(), excluded, w.start, w.end, s)
        return step

    def by_city(build) -> Callable[[DayWindow], DataFrame]:
        def rows_of(w: DayWindow) -> DataFrame:
            rows, excluded = plays_of(w)
            return build(rows, city(), excluded, w.start, w.end)
        return rows_of

    def plain(build) -> Callable[[DayWindow], DataFrame]:
        def rows_of(w: DayWindow) -> DataFrame:
            rows, excluded = plays_of(w)
            return build(rows, excluded, w.start, w.end)
        return rows_of

    return [
        report("content_play_day", content_play_day),
        report("content_play_total", None, since="content_play_day", run=content_play_total),
        report("scan_total", None, since="content_play_day", run=scan_total),
        report("ad_play_total", None, since="ad_play_day", run=ad_total(plays.ad_play_run)),
        report("ad_play_fulltime_total", None, since="ad_play_fulltime", run=ad_total(plays.ad_play_fulltime_run)),
        report("points_total", None, since="trip_day", run=lambda w, s: trip_day.points_run(
            t.events, city(), t.excluded, w.start, w.end, s, days=None if s is None else days(w))),
        report("on_road_total", None, since="trip_day", run=lambda w, s: trip_day.on_road_run(
            t.events, city(), t.excluded, w.start, w.end, s, days=None if s is None else days(w))),
        report("ad_play_day", by_city(plays.ad_play_day)),
        report("ad_play_fulltime", by_city(plays.ad_play_fulltime)),
        report("ad_plan_day", plain(plays.ad_plan_day)),
        report("trip_day", lambda w: trip_day.trip_labels(figures(w)), sort=scale.CITY),
        report("tab_click", by_city(clicks.tab_clicks)),
        report("video_click", plain(clicks.video_clicks)),
        report("scan_extract", plain(clicks.scan_extract)),
        report("interaction_day", lambda w: interaction.interaction_day(t.events, t.excluded, w.start, w.end)),
        report("taxi_interaction_day", lambda w: interaction.taxi_interaction_day(
            t.events, t.heartbeat, dims.taxis_of(cars(), devices), devices, t.excluded, w.start, w.end, shown(w))),
        # Refreshed as a whole for the seven days before the run day.
        Report("content_interaction", lambda w: interaction.content_interaction(t.events, t.excluded, w.start),
               mode="refresh"),
        report("calendar", lambda w: day_spine(spark, w.start, w.end), day="day", mode="append"),
        # First trip and first heartbeat of every device: kept for the two reports below, and no report itself.
        report("device_firsts", None, day="day", since="device_scale", mode="state", run=lambda w, s: scale.firsts_run(
            live, w.start, w.end, s, None if s is None else shown(w))),
        report("device_scale", lambda w: scale.device_scale(
            inputs(), dims.city_bindings_of(cars(), devices), figures(w), w.start, w.end, first(), shown(w)),
               day="day", after=("calendar", "device_firsts"), sort=scale.CITY),
        report("agent_day", lambda w: scale.agent_day(
            inputs(), days(w), dims.agent_bindings_of(cars(), devices), dims.agents_of(bound(), devices), w.start, w.end, first(), shown(w)),
               day="day", after=("calendar", "device_firsts")),
    ]


@dataclass(frozen=True)
class RetailTables:
    """Inputs of the retail run; ``log_root`` is the folder of the log files (see ``sources.logs.FILE``)."""

    orders: DataFrame
    lines: DataFrame
    comments: DataFrame
    comment_tags: DataFrame
    sku: DataFrame
    sku_goods: DataFrame
    user_tag: DataFrame
    company: DataFrame
    driver: DataFrame
    driver_info: DataFrame
    driver_tag: DataFrame
    driver_shelf: DataFrame
    city: DataFrame
    replenishment: DataFrame
    estimate: DataFrame
    log_root: str


def read_retail_tables(spark: SparkSession, folder: str, log_root: str) -> RetailTables:
    """The input tables of the retail run from one folder, with their declared schemas."""
    def table(name: str, schema: str) -> DataFrame:
        return read_parquet(spark, f"{folder}/{name}", schema)

    return RetailTables(
        table("shop_order", S.SHOP_ORDER), table("order_line", S.ORDER_LINE), table("order_comment", S.ORDER_COMMENT),
        table("comment_tag", S.COMMENT_TAG), table("sku", S.SKU), table("sku_goods", S.SKU_GOODS), table("user_tag", S.USER_TAG),
        table("company", S.COMPANY), table("driver", S.DRIVER), table("driver_info", S.DRIVER_INFO), table("driver_tag", S.DRIVER_TAG),
        table("driver_shelf", S.DRIVER_SHELF), table("city", S.CITY), table("replenishment", S.REPLENISHMENT), table("estimate", S.ESTIMATE),
        log_root)


def retail_reports(spark: SparkSession, t: RetailTables, root: str, first_mark: dt.date) -> list[Report]:
    """Retail facts and the company scorecard, in load order: lines, orders,
    comments, scan log, scorecard.  The scorecard reads the loaded facts, and the
    scan log is loaded before it."""
    drivers = retail.driver_dim(t.driver_info, t.city, t.driver_tag)

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("day", as_day(F.col("add_time")))

    def order_lines(w: DayWindow) -> DataFrame:
        return dated(retail.order_lines(t.lines, drivers, t.user_tag, t.sku, t.sku_goods, w.start, w.end))

    def order_facts(w: DayWindow) -> DataFrame:
        loaded = read_loaded(order_lines(w), f"{root}/order_lines")
        return dated(retail.order_facts(t.orders, drivers, t.user_tag, loaded, w.start, w.end))

    def scorecard(w: DayWindow) -> DataFrame:
        facts = read_loaded(order_facts(w), f"{root}/order_facts").filter(P.in_days(w.start, w.end, "day")).drop("day")
        scans = read_loaded(spark.createDataFrame([], f"{S.SCAN_LOG}, day date"), f"{root}/scan_log").filter(P.in_days(w.start, w.end, "day"))
        return retail.scorecard(retail.ScorecardInputs(
            t.company, t.driver, t.driver_info, t.driver_tag, t.driver_shelf, t.city, t.orders, facts, scans,
            t.replenishment, t.estimate), w.start, w.end)

    def report(name, build, **kw):
        return Report(name, build, default=first_mark, **kw)

    return [
        report("order_lines", order_lines),
        report("order_facts", order_facts, after=("order_lines",)),
        report("order_comments", lambda w: dated(retail.order_comments(t.comments, t.comment_tags, w.start, w.end))),
        # Both tables of the logs: a late or changed file is read whenever it comes, one that was read is not.
        Report("scan_log", None, own=lambda path, today: load_scan_logs(spark, t.log_root, path, first_mark, today)),
        report("scorecard", scorecard, after=("order_facts", "scan_log")),
    ]


def load_scan_logs(spark: SparkSession, log_root: str, path: str, after: dt.date, today: dt.date) -> DayWindow:
    """Load the day logs that have new files, from the day after ``after`` to yesterday, and return the days they span.

    A log (module, host and day) is a partition of ``path`` and of ``path``_rejects, whose rows have their day of arrival as well.
    The list of files read is written last, so a run that stops reads them again and replaces what it had written.
    """
    listed = f"{path}_files"
    files = logs.log_files(spark, log_root).filter((F.col("day") > day_lit(after)) & (F.col("day") < day_lit(today)))
    new = logs.unread_logs(files, read_report(spark, listed)).collect()  # a small row for each file to be read
    if not new:
        return DayWindow(today, today - dt.timedelta(days=1))
    parsed = logs.parse_scan_lines(logs.read_files(spark, [f.path for f in new]), keep=logs.LOG)
    known = sorted({tuple(f[c] for c in logs.LOG) for f in new if f.known})
    replace_parts(logs.scan_log(parsed), path, logs.LOG, known)
    replace_parts(logs.scan_log_rejects(parsed, logs.LOG).withColumn("arrived", day_lit(today)), f"{path}_rejects", logs.LOG, known)
    rows = spark.createDataFrame([(f.day, f.host, f.folder, f.path, f.size) for f in new], "day date, host string, folder string, path string, size long")
    rows.coalesce(1).write.mode("append").parquet(listed)
    return DayWindow(min(f.day for f in new), max(f.day for f in new))
