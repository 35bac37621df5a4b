"""Content and ad play reports, and their cumulative forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.attribution import PARTS, Rules, attributed
from tidemark.functions.cells import Day, blank_to_zero, day_lit, flag, key_label
from tidemark.operators.cumulative import State, Step, continued, running, whole
from tidemark.operators.rollup import roll_up

CITY_KEYS = ("date", "city_sn", "car_type")
CONTENT_KEYS = (*CITY_KEYS, "contentid", "tag")


#: What the play, click and scan reports look at.
TAGS = (*V.ADPLAN_TAGS, V.RECOVER_END, V.TAB_CLICK)
COLUMNS = ("p_date", "devicename", "traceid", "contentid", "adsn", "tag", "event", "page", "targetvalue", "currentvalue", "message", "env",
           "versioncode", "playtime", *PARTS)


def play_rows(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """The rows and columns of a window that the play, click and scan reports read, without test devices.  Taken for ``events``
    by those reports, with nothing to exclude, they give the same figures as the whole log."""
    wanted = F.col("tag").isin(*TAGS) | (F.col("event") == "SCAN")
    return P.prod_events(events, excluded, start, end).filter(wanted).select(*COLUMNS)


def _counted_scans(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Scans counted by day and by what the rules look at, so that few rows meet the rules."""
    scans = P.prod_events(events, excluded, start, end).filter(F.col("event") == "SCAN")
    return scans.groupBy("p_date", *PARTS).agg(F.count(F.lit(1)).alias("n"))


def scan_counts(events: DataFrame, rules: Rules, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Scans per day and attributed campaign content."""
    found = attributed(_counted_scans(events, excluded, start, end), rules)
    return found.groupBy(F.col("p_date").alias("date"), "video").agg(F.sum("n").alias("scan_cnt"))


def content_play_day(
    events: DataFrame, rules: Rules, excluded: P.Excluded, start: Day, end: Day
) -> DataFrame:
    """In-trip plays by (date, content, tag) with the scans of the content.

    The scan count belongs to the content and repeats on each of its tags.  Plays and scans come from one pass: a row
    makes a record of either kind (or of both), and both are counted by one aggregation.  Figures meet on the raw content, labels come last.
    """
    timed, scan = flag(P.counted_trip() & P.play_timed(V.PLAY_TAGS)), flag(F.col("event") == "SCAN")
    rows = P.prod_events(events, excluded, start, end).filter(timed | scan).withColumn("__play", flag(P.played(V.PLAY_TAGS)))
    none = F.lit(None).cast("string")
    play_parts, scan_parts = (F.col("contentid"), F.col("tag"), none), tuple(map(F.col, PARTS))

    def record(kind: str, where: Column, parts: tuple[Column, ...], device: Column, trip: Column, play: Column, time: Column) -> Column:
        return F.when(where, F.struct(F.lit(kind).alias("kind"), *[p.alias(f"part{i}") for i, p in enumerate(parts)], device.alias("device"),
                                      trip.alias("trip"), play.alias("play"), time.alias("time")))

    records = F.array(record("play", timed, play_parts, F.col("devicename"), F.col("traceid"), F.col("__play"), F.col("playtime")),
                      record("scan", scan, scan_parts, none, none, F.lit(False), F.lit(None).cast("double")))
    keys = ["p_date", "kind", "part0", "part1", "part2"]
    counted = rows.select("p_date", F.explode(records).alias("r")).filter("r IS NOT NULL").select("p_date", "r.*").groupBy(*keys).agg(
        F.count_distinct("device").alias("play_dev_cnt"),
        # Distinct counts with FILTER share one Expand per counted column.
        F.expr("count(distinct trip) filter (where play)").alias("play_trip_cnt"),
        F.count_if("play").alias("play_cnt"),
        F.coalesce(F.sum("time"), F.lit(0)).alias("play_time"),
        F.count(F.lit(1)).alias("n"),
    ).filter("kind = 'scan' OR play_cnt > 0")
    is_scan = F.col("kind") == "scan"
    of_rules = counted.select("*", *[F.when(is_scan, F.col(f"part{i}")).alias(p) for i, p in enumerate(PARTS)])
    found = attributed(of_rules, rules, where=is_scan)
    measures = ["play_dev_cnt", "play_trip_cnt", "play_cnt", "play_time"]
    by_content = found.groupBy(
        F.col("p_date").alias("date"), "kind", F.when(is_scan, F.col("video")).otherwise(F.col("part0")).alias("content"),
        F.when(~is_scan, F.col("part1")).alias("tag"),
    ).agg(*[F.sum(m).alias(m) for m in measures], F.sum(F.when(is_scan, F.col("n"))).alias("n"))
    # a few rows for each content: one per tag and one with its scans
    scans = F.sum("n").over(Window.partitionBy("date", "content"))
    return by_content.withColumn("scan_cnt", F.coalesce(scans, F.lit(0))).filter(~is_scan).select(
        "date", key_label(F.col("content")).alias("contentid"), key_label(F.col("tag")).alias("tag"), "play_dev_cnt", "play_trip_cnt",
        "play_cnt", "scan_cnt", "play_time")


def content_play_total(events: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                       history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """Devices, plays and play time per (content, tag) from history start to each day."""
    return whole(content_play_run(events, excluded, start, end, None, history))


def content_play_run(events: DataFrame, excluded: P.Excluded, start: Day, end: Day, before: State | None,
                     history: Day = V.EVENT_HISTORY_START) -> Step:
    """The same from the state that earlier runs kept: then only the window's days are read."""
    rows = P.prod_events(events, excluded, history if before is None else start, end).filter(P.counted_trip() & P.played(V.HISTORY_TAGS))
    measures = ["total_play_cnt", "total_play_time", "total_play_dev_cnt"]

    def report(daily: DataFrame) -> DataFrame:
        return running(daily, ["contentid", "tag"], measures, start, end, "p_date").withColumn(
            "contentid", blank_to_zero(F.col("contentid"))).withColumnRenamed("p_date", "date")

    return continued(
        rows, ["contentid", "tag"], "p_date", start, before, report, counts=["total_play_cnt"],
        sums={"total_play_time": F.col("playtime")}, distinct={"total_play_dev_cnt": F.col("devicename")})


def scan_total(events: DataFrame, rules: Rules, excluded: P.Excluded, start: Day, end: Day,
               history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """Scans per attributed content from history start to each day."""
    return whole(scan_run(events, rules, excluded, start, end, None, history))


def scan_run(events: DataFrame, rules: Rules, excluded: P.Excluded, start: Day, end: Day, before: State | None,
             history: Day = V.EVENT_HISTORY_START) -> Step:
    """The same from a state.  Scans are kept by what the rules look at and attributed after they are summed, so the rules of
    the run hold for all days, whatever rules earlier runs had."""
    counted = _counted_scans(events, excluded, history if before is None else start, end)

    def finish(new: DataFrame) -> tuple[DataFrame, DataFrame]:
        daily = new.withColumn("p_date", F.greatest("p_date", day_lit(start)))
        if before is not None:
            daily = daily.unionByName(before.totals.select(day_lit(start).alias("p_date"), *PARTS, "n"))
        daily = daily.groupBy("p_date", *PARTS).agg(F.sum("n").alias("n"))
        videos = attributed(daily, rules).groupBy("p_date", "video").agg(F.sum("n").alias("total_scan_cnt"))
        report = running(videos, ["video"], ["total_scan_cnt"], start, end, "p_date").withColumnRenamed("p_date", "date")
        return report, daily.groupBy(*PARTS).agg(F.sum("n").alias("n"))

    return Step(counted, finish)


def _ad_plays_by_device(rows: DataFrame, tags: tuple[str, ...]) -> DataFrame:
    """Per (date, device, content, tag).  Trips of different devices are added up
    later, so they are counted distinct per device here and not per city."""
    return (
        rows.withColumn("__play", flag(P.played(tags)))
        .groupBy(F.col("p_date").alias("date"), "devicename", blank_to_zero(F.col("contentid")).alias("contentid"),
                 F.col("contentid").alias("__raw"), "tag")
        .agg(
            F.expr("count(distinct traceid) filter (where __play)").alias("play_trip_cnt"),
            F.count_if("__play").alias("play_cnt"),
            F.sum("playtime").alias("play_time"),
        )
    )


def _ad_rollup(per_device: DataFrame, city: DataFrame, measures: list[str]) -> DataFrame:
    rolled = roll_up(per_device, city, CONTENT_KEYS, sums=measures, count="play_dev_cnt")
    return rolled.filter(F.col("play_cnt") > 0)


def ad_play_day(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """In-trip ad plays by (date, city, car, content, tag)."""
    rows = P.prod_events(events, excluded, start, end).filter(
        P.counted_trip() & P.is_ad() & P.play_timed(V.PLAY_TAGS))
    rolled = _ad_rollup(_ad_plays_by_device(rows, V.PLAY_TAGS), city, ["play_trip_cnt", "play_cnt", "play_time"])
    return rolled.select(*CONTENT_KEYS, "play_dev_cnt", "play_trip_cnt", "play_cnt", "play_time")


def ad_play_fulltime(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Ad plays in and outside trips by (date, city, car, content, tag)."""
    rows = P.prod_events(events, excluded, start, end).filter(P.is_ad() & P.play_timed(V.FULLTIME_TAGS))
    per_device = (
        rows.withColumn("__play", flag(P.played(V.FULLTIME_TAGS)))
        .groupBy(F.col("p_date").alias("date"), "devicename", blank_to_zero(F.col("contentid")).alias("contentid"),
                 F.col("contentid").alias("__raw"), "tag")
        .agg(F.count_if("__play").alias("play_cnt"), F.sum("playtime").alias("play_time"))
    )
    rolled = _ad_rollup(per_device, city, ["play_cnt", "play_time"])
    return rolled.select(*CONTENT_KEYS, "play_dev_cnt", "play_cnt", "play_time")


def _ad_total(rows: DataFrame, city: DataFrame, start: Day, end: Day, distinct: dict, before: State | None) -> Step:
    """What each device adds per day, rolled up to the city, then summed over days.  The state is kept per device, so
    that a device counts where it is bound now, as without a state."""
    measures = [*distinct, "total_play_cnt", "total_play_time"]

    def report(per_device: DataFrame) -> DataFrame:
        labelled = per_device.withColumn("contentid", blank_to_zero(F.col("contentid"))).withColumnRenamed("p_date", "date")
        daily = roll_up(labelled, city, CONTENT_KEYS, sums=measures)
        return running(daily, [k for k in CONTENT_KEYS if k != "date"], measures, start, end, "date")

    return continued(
        rows, ["devicename", "contentid", "tag"], "p_date", start, before, report,
        counts=["total_play_cnt"], sums={"total_play_time": F.col("playtime")}, distinct=distinct)


def ad_play_total(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                  history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """In-trip ad plays from history start to each day."""
    return whole(ad_play_run(events, city, excluded, start, end, None, history))


def ad_play_run(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day, before: State | None,
                history: Day = V.EVENT_HISTORY_START) -> Step:
    """The same from the state that earlier runs kept: then only the window's days are read."""
    rows = P.prod_events(events, excluded, history if before is None else start, end).filter(
        P.counted_trip() & P.is_ad() & P.played(V.HISTORY_TAGS))
    return _ad_total(rows, city, start, end, {
        "total_play_trip_cnt": F.col("traceid"), "total_play_dev_cnt": F.col("devicename")}, before)


def ad_play_fulltime_total(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                           history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """Ad plays in and outside trips from history start to each day."""
    return whole(ad_play_fulltime_run(events, city, excluded, start, end, None, history))


def ad_play_fulltime_run(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day, before: State | None,
                         history: Day = V.EVENT_HISTORY_START) -> Step:
    """The same from the state that earlier runs kept: then only the window's days are read."""
    rows = P.prod_events(events, excluded, history if before is None else start, end).filter(P.is_ad() & P.played(V.HISTORY_TAGS))
    return _ad_total(rows, city, start, end, {"total_play_dev_cnt": F.col("devicename")}, before)


def ad_plan_day(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Devices, trips and plays by (date, ad number, tag), in and outside trips.

    The groups are those of the raw ad number; its label turns empty and NULL
    into '0', so '0' can have two rows per tag.
    """
    rows = P.prod_events(events, excluded, start, end).filter(P.played(V.ADPLAN_TAGS))
    return (
        rows.groupBy(F.col("p_date").alias("date"), F.col("adsn").alias("__adsn"), "tag")
        .agg(
            F.count_distinct("devicename").alias("play_dev_cnt"),
            F.count_distinct("traceid").alias("play_trip_cnt"),
            F.count(F.lit(1)).alias("play_cnt"),
        )
        .select("date", key_label(F.col("__adsn")).alias("adsn"), "tag", "play_dev_cnt", "play_trip_cnt", "play_cnt")
    )
