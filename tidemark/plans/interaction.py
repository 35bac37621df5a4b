"""Interaction reports: many filtered counts per day from one scan each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.cells import Day, day_lit
from tidemark.operators.dims import DeviceRules
from tidemark.operators.flags import Where, distinct_counts, row_counts
from tidemark.operators.frames import align, day_spine

# Tags clicked on a video page, each a metric "<tag>_trip_cnt".
VIDEO_PAGE_TAGS = (
    "video_progress_change", "hide_detail", "click_video_detail", "channel_click", "video_zoomin", "video_zoomout",
    "video_banner_click", "video_recommend_swith", "video_recommend_change",
)


COUNTED = "counted_trip"


def trip_metrics() -> dict[str, Where]:
    """Metrics that count distinct trips, in report order."""
    counted = (COUNTED,)

    def touch(pages, not_tags, also=()):
        return Where(isin={"event": V.TOUCH_EVENTS, "page": pages}, notin={"tag": not_tags}, also=also)

    def opened(tab):
        return Where(isin={"tag": (V.TAB_AUTO, V.TAB_CLICK), "targetvalue": V.tab_targets(tab)})

    def on_video(tag):
        return Where(isin={"tag": (tag,), "page": V.VIDEO_PAGES}, also=counted)

    metrics = {
        "inter_trip_cnt": Where(isin={"event": V.TOUCH_EVENTS}, notin={"tag": V.NOT_TOUCH_VIDEO}, also=counted),
        "close_trip_cnt": Where(isin={"tag": (V.SCREEN_CLOSE,)}, also=counted),
        "recommend_click_trip_cnt": on_video("video_recommend_click"),
        # The version is asked for on trip, video and activity pages only.
        "trip_inter_trip_cnt": touch(V.TRIP_PAGES, V.NOT_TOUCH, counted),
        "video_inter_trip_cnt": touch(V.VIDEO_PAGES, V.NOT_TOUCH_VIDEO, counted),
        "eat_inter_trip_cnt": touch(V.EAT_PAGES, V.NOT_TOUCH),
        "play_inter_trip_cnt": touch(V.PLAY_PAGES, V.NOT_TOUCH),
        "activity_inter_trip_cnt": touch(V.ACTIVITY_PAGES, V.NOT_TOUCH, counted),
        "video_trip_cnt": opened("video"),
        "eat_trip_cnt": opened("eat"),
        "play_trip_cnt": opened("play"),
        "activity_trip_cnt": opened("activity_video"),
        "trip_effect_inter_trip_cnt": touch(V.TRIP_PAGES, V.NOT_EFFECT),
        "video_effect_inter_trip_cnt": touch(V.VIDEO_PAGES, V.NOT_EFFECT_VIDEO),
        "eat_effect_inter_trip_cnt": touch(V.EAT_PAGES, V.NOT_EFFECT),
        "play_effect_inter_trip_cnt": touch(V.PLAY_PAGES, V.NOT_EFFECT),
        "activity_effect_inter_trip_cnt": touch(V.ACTIVITY_PAGES, V.NOT_EFFECT),
    }
    return metrics | {f"{tag}_trip_cnt": on_video(tag) for tag in VIDEO_PAGE_TAGS}


def content_metrics() -> dict[str, Where]:
    """Metrics that count distinct (trip, content) pairs."""
    content = (COUNTED, "content")
    return {
        "daily_play_trip_content_cnt": Where(isin={"tag": (V.CONTENT_BEGIN,)}, also=content),
        "inter_trip_content_cnt": Where(
            isin={"event": V.CLICK_EVENTS}, notin={"tag": V.NOT_CONTENT_TOUCH}, also=content),
    }


def interaction_columns() -> list[str]:
    names = [*trip_metrics()]
    return [names[0], *content_metrics(), *names[1:]]


def trip_content_key() -> Column:
    """Trip and content as one text.  Two different pairs can read the same; the
    report counts them once."""
    return F.concat("traceid", "contentid")


def interaction_counts(events: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                       content_key: Column | None = None) -> DataFrame:
    """The 28 metrics for each day that has any."""
    rows = P.prod_events(events, excluded, start, end).filter(P.in_trip())
    counts = distinct_counts(rows, ["p_date"], {
        "trip": (F.col("traceid"), trip_metrics()),
        "content": (trip_content_key() if content_key is None else content_key, content_metrics()),
    }, {COUNTED: P.counted_trip(), "content": P.has_content() & P.no_ad()})
    # Interactions with content are reported for days with content plays only.
    shown = F.when(F.col("daily_play_trip_content_cnt") > 0, F.col("inter_trip_content_cnt")).otherwise(F.lit(0))
    return counts.withColumn("inter_trip_content_cnt", shown).withColumnRenamed("p_date", "date")


def interaction_day(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """One row per day of the window, days without events as zeros."""
    counts = interaction_counts(events, excluded, start, end)
    columns = interaction_columns()
    spine = day_spine(events.sparkSession, start, end, "date")
    return spine.join(counts, "date", "left").select("date", *columns).fillna(0, subset=columns)


def taxi_metrics() -> dict[str, Where]:
    """Row counts of the taxi screens, in report order."""
    def at(name, pages):
        return Where(isin={"tag": (name,), "page": pages})

    def tab(name):
        return Where(isin={"tag": (V.TAB_CLICK,), "targetvalue": (name,)})

    around, popular, video, voice = V.AROUND_PAGES, V.POPULAR_PAGES, V.TAXI_VIDEO_PAGES, "SCREEN_CLICK_SET_BUTTON"
    return {
        "inter_cnt": Where(isin={"event": V.TOUCH_EVENTS}, notin={"tag": V.NOT_TOUCH}),
        "close_cnt": Where(isin={"tag": (V.SCREEN_CLOSE,)}),
        "screensaver_play_cnt": Where(isin={"tag": (V.SCREENSAVER,)}),
        "screensaver_click_cnt": Where(isin={"tag": V.SCREENSAVER_CLICKS}),
        "screensaver_next_click_cnt": Where(isin={"tag": ("show_next_screensaver_click",)}),
        "voice_click_screensaver_cnt": at(voice, V.SAVER_PAGES),
        "tab_click_around_cnt": tab("around"),
        "map_zoomout_around_cnt": at("map_zoomout", around),
        "business_skip_popular_click_cnt": at("click_business_skip_popular", around),
        "list_switch_around_cnt": at("list_switch", around),
        "map_point_around_cnt": at("map_point", around),
        "detail_show_around_cnt": at("detail_show", around),
        "tab_click_popular_cnt": tab("popular"),
        "list_switch_popular_cnt": at("list_switch", popular),
        "list_load_more_popular_cnt": at("list_load_more", popular),
        "detail_show_popular_cnt": at("detail_show", popular),
        "image_slide_popular_cnt": at("image_slide", popular),
        "preview_show_popular_cnt": at("preview_show", popular),
        "detail_close_popular_cnt": at("detail_close", popular),
        "tab_click_video_cnt": tab("video"),
        "channel_click_video_cnt": at("channel_click", video),
        "video_recommend_swith_cnt": at("video_recommend_swith", video),
        "video_recommend_change_cnt": at("video_recommend_change", video),
        "video_zoomout_cnt": at("video_zoomout", video),
        "video_zoomin_cnt": at("video_zoomin", video),
        "voice_click_video_cnt": at(voice, video),
        "video_banner_click_cnt": at("video_banner_click", video),
    }


def online_heartbeats(heartbeat: DataFrame, taxi: DataFrame, start: Day, end: Day, shown: DataFrame | None = None) -> DataFrame:
    """Heartbeat rows of taxi devices per day: rows, not distinct devices."""
    # Rows per device are counted before the join, a device bound twice counts twice.
    if shown is None:
        beats = heartbeat.filter(P.in_days(start, end, "day") & F.col("sn").isNotNull()).groupBy("sn", "day").agg(
            F.count(F.lit(1)).alias("n"))
    else:
        beats = shown.filter(P.in_days(start, end, "day") & (F.col("beats") > 0)).select(
            F.col("device").alias("sn"), "day", F.col("beats").alias("n"))
    joined = beats.join(taxi.select("third_code"), F.col("sn") == F.col("third_code"), "inner")
    return joined.groupBy(F.col("day").alias("date")).agg(F.sum("n").alias("online_dev_cnt"))


def taxi_interaction_day(events: DataFrame, heartbeat: DataFrame, taxi: DataFrame, rules: DeviceRules,
                         excluded: P.Excluded, start: Day, end: Day, shown: DataFrame | None = None) -> DataFrame:
    """One row per day of the window: online devices and 27 event counts.  ``shown`` is the window's ``presence``,
    if it is at hand."""
    metrics = taxi_metrics()
    rows = P.prod_events(events, excluded, start, end).filter(F.col("category") == rules.taxi_category)
    counts = row_counts(rows.withColumnRenamed("p_date", "date"), ["date"], metrics)
    aligned = align([online_heartbeats(heartbeat, taxi, start, end, shown), counts], ["date"])
    columns = ["online_dev_cnt", *metrics]
    spine = day_spine(events.sparkSession, start, end, "date")
    return spine.join(aligned, "date", "left").select("date", *columns).fillna(0, subset=columns)


# Pivot column and the tags it adds up.
CONTENT_PIVOT = {
    "screen_click_trip_cnt": ("SCREEN_CLICK_SCREEN", "screen_click"),
    "recommend_swith_trip_cnt": ("video_recommend_swith",),
    "click_speaker_button_trip_cnt": ("SCREEN_CLICK_SPEAKER_BUTTON",),
    "volume_change_trip_cnt": ("SCREEN_OTHER_VOLUME_CHANGE",),
    "recommend_click_trip_cnt": ("video_recommend_click",),
    "recommend_change_trip_cnt": ("video_recommend_change",),
    "progress_change_trip_cnt": ("video_progress_change",),
    "pause_click_trip_cnt": ("video_pause_click",),
    "start_click_trip_cnt": ("video_start_click",),
}


def content_interaction(events: DataFrame, excluded: P.Excluded, today: Day) -> DataFrame:
    """Trips that played and touched each content in the 7 days before ``today``.

    A trip counts once per tag; a pivot column over two tags adds both counts.
    """
    week = F.col("p_date").between(F.date_sub(day_lit(today), 7), F.date_sub(day_lit(today), 1))
    rows = P.known_devices(events.filter(week & P.prod()), excluded).filter(
        P.in_trip() & P.has_content() & P.blank_ad())
    metrics = {
        "play_trip_cnt": Where(isin={"tag": (V.CONTENT_BEGIN,)}),
        "total_inter_trip_cnt": Where(isin={"event": V.CLICK_EVENTS}, notin={"tag": V.PLAYER_TAGS}),
    }
    for name, tags in CONTENT_PIVOT.items():
        for i, tag in enumerate(tags):
            metrics[f"{name}__{i}"] = Where(isin={"event": V.CLICK_EVENTS, "tag": (tag,)})
    counts = distinct_counts(rows, ["contentid"], {"trip": (F.col("traceid"), metrics)})
    pivot = [sum((F.col(f"{n}__{i}") for i in range(1, len(t))), F.col(f"{n}__0")).alias(n)
             for n, t in CONTENT_PIVOT.items()]
    return counts.filter(F.col("play_trip_cnt") > 0).select("contentid", "play_trip_cnt", "total_inter_trip_cnt", *pivot)
