"""Queries over the event log: plays, trips, clicks, interaction."""

from __future__ import annotations

from testbed.registry import VIEWS, plain, query
from testbed.tables import CAMPAIGN_RULES, END, HISTORY, LATE_START, RULES, START, TODAY
from tidemark.functions import predicates as P
from tidemark.operators import dims
from tidemark.operators.trips import device_days
from tidemark.plans import clicks, interaction, plays, trip_day

# Tags, pages and targets below are fixed values of the log; they must be as they are.
TRIP = "traceid IS NOT NULL AND traceid <> ''"
V179 = "TRY_CAST(versioncode AS INT) >= 179"
ENDED = "(tag = 'SCREEN_OTHER_RECOVER_END' AND message LIKE '内容正常结束%')"
PLAY = "'SCREEN_OTHER_CONTENT_BEGIN','splash_show_begin','video_banner_click','click_video_detail','video_banner_show'"
FULL = PLAY + ",'screensaver_ad_begin','click_show_screensaver_detail','click_invalid_screensaver_detail'"
HIST = "'SCREEN_OTHER_CONTENT_BEGIN','splash_show_begin','video_banner_click','click_video_detail'"
LABEL = "CASE WHEN {0} IS NULL OR {0} = '' THEN '0' ELSE {0} END"
BLANK = "CASE WHEN {0} = '' THEN '0' ELSE {0} END"
PLAYED_NOW = f"(tag IN ({PLAY}) OR {ENDED})"
IN_TRIP = f"{TRIP} AND {V179}"
# The campaign rules of the test tables as rows; a scan belongs to the first rule that holds.
VIEWS["campaign_rule"] = "SELECT * FROM (VALUES " + ", ".join(
    "({}, {})".format(r.priority, ", ".join("NULL" if v is None else f"'{v}'" for v in (r.target, r.source, r.campaign, r.content, r.kind)))
    for r in CAMPAIGN_RULES) + ") v(priority, target, source, campaign, content, kind)"
VIEWS["campaign_of"] = """SELECT x.utmsource, x.utmcampaign, x.utmcontent, COALESCE(arg_min(r.target, r.priority), 'else ') AS video
FROM (SELECT DISTINCT utmsource, utmcampaign, utmcontent FROM screen_event) x LEFT JOIN campaign_rule r
  ON COALESCE(r.source = x.utmsource, r.source IS NULL) AND COALESCE(r.campaign = x.utmcampaign, r.campaign IS NULL)
  AND CASE WHEN r.content IS NULL THEN TRUE WHEN x.utmcontent IS NULL THEN FALSE WHEN r.kind = 'eq' THEN r.content = x.utmcontent
    ELSE position(r.content IN x.utmcontent) > 0 END
GROUP BY ALL"""
VIEWS["scanned"] = """SELECT e.p_date, c.video FROM ev_hist e, campaign_of c WHERE e.event = 'SCAN'
AND (e.utmsource, e.utmcampaign, e.utmcontent) IS NOT DISTINCT FROM (c.utmsource, c.utmcampaign, c.utmcontent)"""


def ledger(keys: str, parts: list[tuple[str, str, str]], source: str = "", where: str = "TRUE") -> str:
    """Every measure as postings of its own set of rows, added up by the keys: (measure, amount, rows)."""
    posted = " UNION ALL BY NAME ".join(f"SELECT * EXCLUDE (amount), amount AS {m} FROM (SELECT *, {amount} AS amount FROM ({rows}) r_{m}) p_{m}"
                                        for m, amount, rows in parts)
    sums = ", ".join(f"SUM(COALESCE({m}, 0)) AS {m}" for m, _, _ in parts)
    return f"SELECT {keys}, {sums} FROM ({posted}) postings {source} WHERE {where} GROUP BY ALL"


def listed(measures: dict[str, str]) -> str:
    """Counts as whole numbers and sums of doubles rounded, in that order of names."""
    return ", ".join(f"CAST({m} AS BIGINT) AS {m}" if kind == "n" else f"ROUND({m}, 3) AS {m}" for m, kind in measures.items())


CITY_OF = "JOIN dim ON devicename = third_code"
WHOLE = "city_sn IS NOT NULL AND car_type IS NOT NULL AND contentid IS NOT NULL"
UNTIL = "FROM span JOIN ev_hist ON p_date <= day WHERE day >= DATE '" + LATE_START + "'"


def city(t):
    return dims.city_dim(t.device_service, t.screen_info, t.screen_car, RULES)


def agents(t):
    return dims.agent_dim(t.device_service, t.screen_info, RULES)


def days(t):
    return device_days(P.prod_events(t.screen_event, t.excluded, START, END))


# --- plays ----------------------------------------------------------------------

@query("r1_content_play_day", f"""
SELECT g.p_date AS date, {LABEL.format('g.contentid')} AS contentid, g.tag,
  (SELECT COUNT(DISTINCT devicename) {{timed}}) AS play_dev_cnt, (SELECT COUNT(DISTINCT traceid) {{played}}) AS play_trip_cnt,
  (SELECT COUNT(*) {{played}}) AS play_cnt, (SELECT COUNT(*) FROM scanned s WHERE s.p_date = g.p_date AND s.video = g.contentid) AS scan_cnt,
  ROUND(COALESCE((SELECT SUM(playtime) {{timed}}), 0), 3) AS play_time
FROM (SELECT DISTINCT p_date, contentid, tag FROM ev WHERE {PLAYED_NOW} AND {IN_TRIP}) g""".format(**{
    name: f"FROM ev x WHERE x.p_date = g.p_date AND x.contentid IS NOT DISTINCT FROM g.contentid AND x.tag = g.tag AND {IN_TRIP} AND {where}"
    for name, where in {"played": PLAYED_NOW, "timed": f"x.tag IN ({PLAY}, 'SCREEN_OTHER_RECOVER_END')"}.items()}))
def _(t):
    return plain(plays.content_play_day(t.screen_event, CAMPAIGN_RULES, t.excluded, START, END))


@query("r1a_scan_counts", f"SELECT p_date AS date, video, COUNT(*) AS scan_cnt FROM scanned WHERE p_date >= DATE '{START}' GROUP BY ALL")
def _(t):
    return plays.scan_counts(t.screen_event, CAMPAIGN_RULES, t.excluded, START, END)


_HIST_IN_TRIP = f"{UNTIL} AND (tag IN ({HIST}) OR {ENDED}) AND {IN_TRIP}"


@query("r1b_content_play_total", f"""
SELECT date, {BLANK.format('contentid')} AS contentid, tag, {listed({'total_play_dev_cnt': 'n', 'total_play_cnt': 'n', 'total_play_time': 's'})}
FROM ({ledger('day AS date, contentid, tag', [
    ('total_play_dev_cnt', '1', f'SELECT DISTINCT day, contentid, tag, devicename {_HIST_IN_TRIP}'),
    ('total_play_cnt', '1', f'SELECT day, contentid, tag {_HIST_IN_TRIP}'),
    ('total_play_time', 'playtime', f'SELECT day, contentid, tag, playtime {_HIST_IN_TRIP}')])}) sums""")
def _(t):
    return plain(plays.content_play_total(t.screen_event, t.excluded, LATE_START, END, history=HISTORY))


@query("r1c_scan_total", f"""
SELECT d.day AS date, so_far.video, so_far.total_scan_cnt FROM (SELECT day FROM span WHERE day >= DATE '{LATE_START}') d,
LATERAL (SELECT video, COUNT(*) AS total_scan_cnt FROM scanned WHERE p_date <= d.day GROUP BY video) so_far""")
def _(t):
    return plays.scan_total(t.screen_event, CAMPAIGN_RULES, t.excluded, LATE_START, END, history=HISTORY)


def _ad_plays(tags: str, where: str) -> tuple[str, str]:
    """Rows that are plays, and rows whose time and device count."""
    rows = f"FROM ev WHERE adsn <> '' AND {where}"
    return f"{rows} AND (tag IN ({tags}) OR {ENDED})", f"{rows} AND tag IN ({tags}, 'SCREEN_OTHER_RECOVER_END')"


_K = "p_date, devicename, contentid, tag"
_AD_KEYS = f"p_date AS date, city_sn, car_type, {BLANK.format('contentid')} AS contentid, tag"
_R2, _R2_TIMED = _ad_plays(PLAY, IN_TRIP)
_R3, _R3_TIMED = _ad_plays(FULL, "TRUE")


@query("r2_ad_play_day", f"""
SELECT date, city_sn, car_type, contentid, tag, {listed({'play_dev_cnt': 'n', 'play_trip_cnt': 'n', 'play_cnt': 'n', 'play_time': 's'})}
FROM ({ledger(_AD_KEYS, [
    ('play_dev_cnt', '1', f'SELECT DISTINCT {_K} {_R2_TIMED}'), ('play_trip_cnt', '1', f'SELECT DISTINCT {_K}, traceid {_R2}'),
    ('play_cnt', '1', f'SELECT {_K} {_R2}'), ('play_time', 'playtime', f'SELECT {_K}, playtime {_R2_TIMED}')],
    CITY_OF, WHOLE)}) sums WHERE play_cnt > 0""")
def _(t):
    return plain(plays.ad_play_day(t.screen_event, city(t), t.excluded, START, END))


_D = "day, devicename, contentid, tag"
_AD_TOTAL_KEYS = f"day AS date, city_sn, car_type, {BLANK.format('contentid')} AS contentid, tag"
_R2A = f"{_HIST_IN_TRIP} AND adsn <> ''"
_R3A = f"{UNTIL} AND (tag IN ({HIST}) OR {ENDED}) AND adsn <> ''"


@query("r2a_ad_play_total", f"""
SELECT date, city_sn, car_type, contentid, tag, {listed({'total_play_trip_cnt': 'n', 'total_play_dev_cnt': 'n', 'total_play_cnt': 'n', 'total_play_time': 's'})}
FROM ({ledger(_AD_TOTAL_KEYS, [
    ('total_play_trip_cnt', '1', f'SELECT DISTINCT {_D}, traceid {_R2A}'), ('total_play_dev_cnt', '1', f'SELECT DISTINCT {_D} {_R2A}'),
    ('total_play_cnt', '1', f'SELECT {_D} {_R2A}'), ('total_play_time', 'playtime', f'SELECT {_D}, playtime {_R2A}')],
    CITY_OF, WHOLE)}) sums""")
def _(t):
    return plain(plays.ad_play_total(t.screen_event, city(t), t.excluded, LATE_START, END, history=HISTORY))


@query("r3_ad_play_fulltime", f"""
SELECT date, city_sn, car_type, contentid, tag, {listed({'play_dev_cnt': 'n', 'play_cnt': 'n', 'play_time': 's'})}
FROM ({ledger(_AD_KEYS, [
    ('play_dev_cnt', '1', f'SELECT DISTINCT {_K} {_R3_TIMED}'), ('play_cnt', '1', f'SELECT {_K} {_R3}'),
    ('play_time', 'playtime', f'SELECT {_K}, playtime {_R3_TIMED}')], CITY_OF, WHOLE)}) sums WHERE play_cnt > 0""")
def _(t):
    return plain(plays.ad_play_fulltime(t.screen_event, city(t), t.excluded, START, END))


@query("r3a_ad_play_fulltime_total", f"""
SELECT date, city_sn, car_type, contentid, tag, {listed({'total_play_dev_cnt': 'n', 'total_play_cnt': 'n', 'total_play_time': 's'})}
FROM ({ledger(_AD_TOTAL_KEYS, [
    ('total_play_dev_cnt', '1', f'SELECT DISTINCT {_D} {_R3A}'), ('total_play_cnt', '1', f'SELECT {_D} {_R3A}'),
    ('total_play_time', 'playtime', f'SELECT {_D}, playtime {_R3A}')], CITY_OF, WHOLE)}) sums""")
def _(t):
    return plain(plays.ad_play_fulltime_total(t.screen_event, city(t), t.excluded, LATE_START, END, history=HISTORY))


_PLAN = f"FROM ev WHERE tag IN ({FULL}, 'click_screensaver_dialog') OR {ENDED}"


@query("r4_ad_plan_day", f"""
SELECT date, {LABEL.format('adsn')} AS adsn, tag, {listed({'play_dev_cnt': 'n', 'play_trip_cnt': 'n', 'play_cnt': 'n'})}
FROM ({ledger('p_date AS date, adsn, tag', [
    ('play_dev_cnt', '1', f'SELECT DISTINCT p_date, adsn, tag, devicename {_PLAN}'),
    ('play_trip_cnt', 'CAST(traceid IS NOT NULL AS INT)', f'SELECT DISTINCT p_date, adsn, tag, traceid {_PLAN}'),
    ('play_cnt', '1', f'SELECT p_date, adsn, tag {_PLAN}')])}) sums""")
def _(t):
    return plays.ad_plan_day(t.screen_event, t.excluded, START, END)


# --- trip report ------------------------------------------------------------------

# One row per trip (device, trip id, day), then one per device and day.
TRIP_SUMMARY = """SELECT devicename, p_date AS date, COUNT(*) AS trip_cnt, SUM(ms / 1000) AS trip_time, SUM(ads + splashes) AS ad_cnt,
  SUM(splashes) AS show_video_start, SUM(played) AS video_time
FROM (SELECT devicename, p_date, traceid, MAX(time_stamp) - MIN(time_stamp) AS ms, COUNT(*) FILTER ({ad} AND adsn <> '') AS ads,
        COUNT(*) FILTER (tag = 'splash_show_begin') AS splashes, SUM(playtime) FILTER (tag = 'SCREEN_OTHER_RECOVER_END') AS played
      FROM ev WHERE {trip} AND {v} GROUP BY ALL) trips
GROUP BY ALL"""
BEGIN_SUMMARY = TRIP_SUMMARY.format(ad="tag = 'SCREEN_OTHER_CONTENT_BEGIN'", trip=TRIP, v=V179)
ENDED_SUMMARY = TRIP_SUMMARY.format(ad=ENDED, trip=TRIP, v=V179)
ON_ROAD = f"""SELECT date, city_sn, car_type, COUNT(devicename) AS daily_trip_dev_cnt FROM
  (SELECT DISTINCT p_date AS date, devicename FROM ev WHERE {TRIP} AND {V179}) x
  JOIN dim ON x.devicename = dim.third_code WHERE city_sn IS NOT NULL AND car_type IS NOT NULL GROUP BY 1, 2, 3"""
# Devices of the snapshot, with whether any of its days puts them in the special city.
POINTS = f"""SELECT p_date AS date, city_sn, car_type, COUNT(*) AS daily_play_dev_cnt
FROM (SELECT e.p_date, e.devicename FROM ev e
      JOIN (SELECT devicename, BOOL_OR(city_sn = 310100) AS special FROM device_snapshot
            WHERE p_date IN (SELECT day FROM span) GROUP BY devicename) listed USING (devicename)
      GROUP BY ALL HAVING BOOL_OR(tag IN ('splash_show_begin', 'SCREEN_OTHER_CONTENT_BEGIN') AND {TRIP})
        OR BOOL_OR(special AND tag IN ('screensaver_ad_begin', 'SCREEN_OTHER_CONTENT_BEGIN'))) points
JOIN dim ON devicename = third_code WHERE city_sn IS NOT NULL AND car_type IS NOT NULL GROUP BY ALL"""
BEATS = f"""SELECT a.day AS date, city_sn, car_type, COUNT(DISTINCT a.sn) AS daily_heartbeat_dev_num FROM
  (SELECT DISTINCT sn, day FROM heartbeat_day WHERE day BETWEEN DATE '{START}' AND DATE '{END}') a
  JOIN dim ON a.sn = dim.third_code GROUP BY 1, 2, 3"""
# A roll-up of sums is the sum over all events of the matched devices.
STREAMS = """SELECT p_date AS date, city_sn, car_type,
  COUNT(*) FILTER (tag = 'SCREEN_OTHER_CONTENT_BEGIN' AND adsn <> '') AS stream_ad_cnt_fulltime,
  COUNT(*) FILTER (tag = 'screensaver_ad_begin') AS screensaver_ad_cnt_fulltime,
  COALESCE(SUM(playtime) FILTER (tag = 'SCREEN_OTHER_RECOVER_END'), 0) AS video_time_fulltime
FROM ev JOIN dim ON devicename = third_code WHERE city_sn IS NOT NULL AND car_type IS NOT NULL GROUP BY ALL"""
SUMMED = f"""SELECT date, city_sn, car_type, CAST(SUM(trip_cnt) AS BIGINT) AS trip_cnt, COALESCE(SUM(trip_time), 0) AS trip_time_sum,
  CAST(SUM(ad_cnt) AS BIGINT) AS ad_cnt, CAST(SUM(show_video_start) AS BIGINT) AS show_video_start,
  COALESCE(SUM(video_time), 0) AS video_time FROM ({BEGIN_SUMMARY}) x JOIN dim ON x.devicename = dim.third_code
  WHERE city_sn IS NOT NULL AND car_type IS NOT NULL GROUP BY 1, 2, 3"""
# by the raw keys of the heartbeat groups
TRIP_FIGURES = f"""SELECT a.date, a.city_sn, a.car_type,
  COALESCE(r.daily_trip_dev_cnt, 0) AS daily_trip_dev_cnt, COALESCE(p.daily_play_dev_cnt, 0) AS daily_play_dev_cnt,
  CAST(0 AS BIGINT) AS total_trip_dev_cnt, CAST(0 AS BIGINT) AS total_play_dev_cnt,
  CASE WHEN a.city_sn = 310100 THEN COALESCE(f.stream_ad_cnt_fulltime, 0) + COALESCE(f.screensaver_ad_cnt_fulltime, 0)
    ELSE COALESCE(s.ad_cnt, 0) END AS ad_cnt,
  COALESCE(s.show_video_start, 0) AS show_video_start, COALESCE(s.trip_cnt, 0) AS trip_cnt,
  ROUND(COALESCE(s.trip_time_sum, 0), 3) AS trip_time_sum, ROUND(COALESCE(s.video_time, 0), 3) AS video_time,
  a.daily_heartbeat_dev_num, COALESCE(f.stream_ad_cnt_fulltime, 0) AS stream_ad_cnt_fulltime,
  COALESCE(f.screensaver_ad_cnt_fulltime, 0) AS screensaver_ad_cnt_fulltime,
  ROUND(COALESCE(f.video_time_fulltime, 0), 3) AS video_time_fulltime
FROM ({BEATS}) a
LEFT JOIN ({STREAMS}) f ON a.date = f.date AND a.city_sn = f.city_sn AND a.car_type = f.car_type
LEFT JOIN ({POINTS}) p ON a.date = p.date AND a.city_sn = p.city_sn AND a.car_type = p.car_type
LEFT JOIN ({SUMMED}) s ON a.date = s.date AND a.city_sn = s.city_sn AND a.car_type = s.car_type
LEFT JOIN ({ON_ROAD}) r ON a.date = r.date AND a.city_sn = r.city_sn AND a.car_type = r.car_type"""


TRIP_DAY = f"SELECT * REPLACE (COALESCE(city_sn, 0) AS city_sn, COALESCE(car_type, '0') AS car_type) FROM ({TRIP_FIGURES}) figures"


def trip_figures(t):
    return trip_day.trip_figures(days(t), t.device_snapshot, t.heartbeat_day, city(t), START, END)


@query("r5_trip_day", TRIP_DAY)
def _(t):
    return plain(trip_day.trip_day(days(t), t.device_snapshot, t.heartbeat_day, city(t), START, END))


@query("r5a_trip_summary", f"""
SELECT devicename, date, trip_cnt, ROUND(trip_time, 3) AS trip_time_sum, CAST(ad_cnt AS BIGINT) AS ad_cnt,
  CAST(show_video_start AS BIGINT) AS show_video_start, ROUND(COALESCE(video_time, 0), 3) AS video_time FROM ({BEGIN_SUMMARY}) x""")
def _(t):
    return plain(trip_day.trip_summary(t.screen_event, t.excluded, START, END))


@query("r5b_on_road_devices", ON_ROAD)
def _(t):
    return trip_day.on_road_devices(t.screen_event, city(t), t.excluded, START, END)


# Day by day: which devices have been seen by then?
TOTAL = """SELECT d.day AS date, so_far.* FROM (SELECT day FROM span WHERE day >= DATE '{late}') d,
LATERAL (SELECT city_sn, car_type, COUNT(*) AS {name} FROM dim WHERE city_sn IS NOT NULL AND car_type IS NOT NULL
  AND EXISTS (SELECT 1 FROM ev_hist e WHERE e.devicename = third_code AND e.p_date <= d.day AND {where}) GROUP BY ALL) so_far"""


@query("r5c_points_total", TOTAL.format(name="total_play_dev_cnt", where="tag = 'splash_show_begin'", late=LATE_START))
def _(t):
    return trip_day.points_total(t.screen_event, city(t), t.excluded, LATE_START, END, history=HISTORY)


@query("r5d_on_road_total", TOTAL.format(name="total_trip_dev_cnt", where=f"{TRIP} AND {V179}", late=LATE_START))
def _(t):
    return trip_day.on_road_total(t.screen_event, city(t), t.excluded, LATE_START, END, history=HISTORY)


@query("r5e_points_of_day", POINTS)
def _(t):
    return trip_day.points_of_day(t.screen_event, t.device_snapshot, city(t), t.excluded, START, END)


@query("r5f_heartbeat_devices", BEATS)
def _(t):
    return trip_day.heartbeat_devices(t.heartbeat_day, city(t), ("city_sn", "car_type"), START, END).withColumnRenamed(
        "day", "date")


@query("r5g_fulltime_streams", f"""SELECT date, city_sn, car_type, stream_ad_cnt_fulltime, screensaver_ad_cnt_fulltime,
  ROUND(video_time_fulltime, 3) AS video_time_fulltime FROM ({STREAMS}) x""")
def _(t):
    return plain(trip_day.fulltime_streams(t.screen_event, city(t), t.excluded, START, END))


# --- clicks -------------------------------------------------------------------------

_TAB_CLICK = f"FROM ev WHERE {IN_TRIP} AND tag = 'screen_tab_click'"
_C = "p_date, devicename, targetvalue"


@query("r6_tab_clicks", f"""
SELECT date, city_sn, car_type, targetvalue, {listed({'click_times': 'n', 'click_trip_cnt': 'n', 'click_dev_cnt': 'n'})}
FROM ({ledger(f"p_date AS date, city_sn, car_type, {BLANK.format('targetvalue')} AS targetvalue", [
    ('click_times', '1', f'SELECT {_C} {_TAB_CLICK}'), ('click_trip_cnt', '1', f'SELECT DISTINCT {_C}, traceid {_TAB_CLICK}'),
    ('click_dev_cnt', '1', f'SELECT DISTINCT {_C} {_TAB_CLICK}')],
    CITY_OF, "city_sn IS NOT NULL AND car_type IS NOT NULL AND targetvalue IS NOT NULL")}) sums""")
def _(t):
    return clicks.tab_clicks(t.screen_event, city(t), t.excluded, START, END)


_VIDEO_CLICK = "FROM ev WHERE length(traceid) > 0 AND TRY_CAST(versioncode AS INT) > 203 AND tag IN ('click_video_detail', 'video_banner_click')"
_V = "p_date, tag, page, currentvalue"


@query("r7_video_clicks", f"""
SELECT date, tag, {BLANK.format('page')} AS page, {BLANK.format('currentvalue')} AS currentvalue, {listed({'click_trip_cnt': 'n', 'click_cnt': 'n'})}
FROM ({ledger('p_date AS date, tag, page, currentvalue', [
    ('click_trip_cnt', '1', f'SELECT DISTINCT {_V}, traceid {_VIDEO_CLICK}'), ('click_cnt', '1', f'SELECT {_V} {_VIDEO_CLICK}')])}) sums""")
def _(t):
    return clicks.video_clicks(t.screen_event, t.excluded, START, END)


@query("r8_scan_extract", f"""
SELECT p_date AS date, {', '.join(f"rpad({c}, CAST(greatest(length({c}), 1) AS INT), '0') AS {c}" for c in ('utmsource', 'utmcampaign', 'utmcontent'))}
FROM ev WHERE event = 'SCAN'""")
def _(t):
    return clicks.scan_extract(t.screen_event, t.excluded, START, END)


# --- interaction: one subquery per metric, as plain SQL ---------------------------------

T3 = "event IN ('CLICK','SLIDE','ZOOM')"
N6 = "'video_start','video_pause','video_resume','SCREEN_CLICK_STOP_PLAY','SCREEN_CLICK_RECOVER_PLAY','SCREEN_CLICK_CONSOLE_AUTO_VANISH'"
N8 = N6 + ",'sub_tab_auto_change','list_auto_swith_time'"
N9 = N8 + ",'video_recommend_swith'"
N7 = "'video_start','SCREEN_CLICK_STOP_PLAY','SCREEN_CLICK_RECOVER_PLAY','SCREEN_CLICK_CONSOLE_AUTO_VANISH','video_recommend_swith','sub_tab_auto_change','list_auto_swith_time'"
PG = {
    "video": "page IN ('2','video','page:main, subPage:video')",
    "eat": "page IN ('eat','3','page:main, subPage:eat','28')",
    "play": "page IN ('play','4','page:main, subPage:play')",
    "trip": "page IN ('trip','1')",
    "activity": "page IN ('21','33','34','35','36','37','41')",
}


def _tab(name: str) -> str:
    return (f"traceid <> '' AND tag IN ('tab_auto_switch','screen_tab_click') "
            f"AND targetvalue IN ('targetPage: main ,targetSubPage: {name}','{name}')")


TRIP_METRICS = {
    "inter_trip_cnt": f"{TRIP} AND {V179} AND {T3} AND tag NOT IN ({N9})",
    "close_trip_cnt": f"{TRIP} AND {V179} AND tag = 'screen_close'",
    "recommend_click_trip_cnt": f"{TRIP} AND {V179} AND tag = 'video_recommend_click' AND {PG['video']}",
    "trip_inter_trip_cnt": f"{TRIP} AND {V179} AND {T3} AND {PG['trip']} AND tag NOT IN ({N8})",
    "video_inter_trip_cnt": f"{TRIP} AND {V179} AND {T3} AND {PG['video']} AND tag NOT IN ({N9})",
    "eat_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8}) AND {PG['eat']}",
    "play_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8}) AND {PG['play']}",
    "activity_inter_trip_cnt": f"{TRIP} AND {V179} AND {T3} AND {PG['activity']} AND tag NOT IN ({N8})",
    "video_trip_cnt": _tab("video"), "eat_trip_cnt": _tab("eat"), "play_trip_cnt": _tab("play"),
    "activity_trip_cnt": _tab("activity_video"),
    "trip_effect_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8},'screen_click') AND {PG['trip']}",
    "video_effect_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N9},'screen_click','SCREEN_CLICK_SCREEN') AND {PG['video']}",
    "eat_effect_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8},'screen_click') AND {PG['eat']}",
    "play_effect_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8},'screen_click') AND {PG['play']}",
    "activity_effect_inter_trip_cnt": f"{TRIP} AND {T3} AND tag NOT IN ({N8},'screen_click') AND {PG['activity']}",
} | {
    f"{g}_trip_cnt": f"{TRIP} AND {V179} AND tag = '{g}' AND {PG['video']}" for g in (
        "video_progress_change", "hide_detail", "click_video_detail", "channel_click", "video_zoomin", "video_zoomout",
        "video_banner_click", "video_recommend_swith", "video_recommend_change")
}
PAIR = f"{TRIP} AND {V179} AND contentid IS NOT NULL AND contentid <> '' AND (adsn = '' OR adsn IS NULL)"

PLAYED = "COUNT(DISTINCT traceid || contentid) FILTER (tag = 'SCREEN_OTHER_CONTENT_BEGIN')"
INTERACTED = f"COUNT(DISTINCT traceid || contentid) FILTER (event IN ('CLICK','SLIDE') AND tag NOT IN ({N7}))"


def _per_day(metrics: dict[str, str], counted: str, extra: str = "", source: str = "ev") -> str:
    """LEFT JOINs of one subquery per metric onto the day span."""
    return " ".join(
        f"LEFT JOIN (SELECT p_date, {counted} AS {m} FROM {source} WHERE {extra}{w} GROUP BY p_date) q{i} ON s.day = q{i}.p_date"
        for i, (m, w) in enumerate(metrics.items()))


@query("r9_interaction_day", f"""
SELECT s.day AS date, {', '.join(f'COALESCE({m}, 0) AS {m}' for m in TRIP_METRICS)},
  COALESCE(daily_play_trip_content_cnt, 0) AS daily_play_trip_content_cnt,
  COALESCE(inter_trip_content_cnt, 0) AS inter_trip_content_cnt
FROM span s {_per_day(TRIP_METRICS, 'COUNT(DISTINCT traceid)')}
LEFT JOIN (SELECT p_date, {PLAYED} AS daily_play_trip_content_cnt, CASE WHEN {PLAYED} > 0 THEN {INTERACTED} ELSE 0 END AS inter_trip_content_cnt
   FROM ev WHERE {PAIR} GROUP BY p_date) pairs ON s.day = pairs.p_date""")
def _(t):
    return interaction.interaction_day(t.screen_event, t.excluded, START, END)


def _at(tag: str, pages: str) -> str:
    return f"tag = '{tag}' AND page IN ({pages})"


TAXI = {
    "inter_cnt": f"{T3} AND tag NOT IN ({N8})", "close_cnt": "tag = 'screen_close'",
    "screensaver_play_cnt": "tag = 'screensaver_ad_begin'",
    "screensaver_click_cnt": "tag IN ('click_show_screensaver_detail','click_invalid_screensaver_detail')",
    "screensaver_next_click_cnt": "tag = 'show_next_screensaver_click'",
    "voice_click_screensaver_cnt": _at("SCREEN_CLICK_SET_BUTTON", "'0'"),
    "tab_click_around_cnt": "tag = 'screen_tab_click' AND targetvalue = 'around'",
    "map_zoomout_around_cnt": _at("map_zoomout", "'38'"),
    "business_skip_popular_click_cnt": _at("click_business_skip_popular", "'38'"),
    "list_switch_around_cnt": _at("list_switch", "'38'"), "map_point_around_cnt": _at("map_point", "'38'"),
    "detail_show_around_cnt": _at("detail_show", "'38'"),
    "tab_click_popular_cnt": "tag = 'screen_tab_click' AND targetvalue = 'popular'",
    "list_switch_popular_cnt": _at("list_switch", "'5','6'"),
    "list_load_more_popular_cnt": _at("list_load_more", "'5','6'"),
    "detail_show_popular_cnt": _at("detail_show", "'5','6'"),
    "image_slide_popular_cnt": _at("image_slide", "'5','6'"),
    "preview_show_popular_cnt": _at("preview_show", "'5','6'"),
    "detail_close_popular_cnt": _at("detail_close", "'5','6'"),
    "tab_click_video_cnt": "tag = 'screen_tab_click' AND targetvalue = 'video'",
    "channel_click_video_cnt": _at("channel_click", "'40'"),
    "video_recommend_swith_cnt": _at("video_recommend_swith", "'40'"),
    "video_recommend_change_cnt": _at("video_recommend_change", "'40'"),
    "video_zoomout_cnt": _at("video_zoomout", "'40'"), "video_zoomin_cnt": _at("video_zoomin", "'40'"),
    "voice_click_video_cnt": _at("SCREEN_CLICK_SET_BUTTON", "'40'"),
    "video_banner_click_cnt": _at("video_banner_click", "'40'"),
}
ONLINE = f"""SELECT a.day AS date, COUNT(a.sn) AS online_dev_cnt FROM heartbeat_day a JOIN taxi_dim b ON a.sn = b.third_code
WHERE a.day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY a.day"""


def taxi(t):
    return dims.taxi_dim(t.device_service, t.screen_info, t.screen_car, RULES)


@query("r10_taxi_interaction_day", f"""
SELECT s.day AS date, COALESCE(o.online_dev_cnt, 0) AS online_dev_cnt, {', '.join(f'COALESCE({m}, 0) AS {m}' for m in TAXI)}
FROM span s LEFT JOIN ({ONLINE}) o ON s.day = o.date {_per_day(TAXI, 'COUNT(1)', "category = 'TAXI' AND ")}""")
def _(t):
    return interaction.taxi_interaction_day(
        t.screen_event, t.heartbeat_day, taxi(t), RULES, t.excluded, START, END)


@query("r10_1_online_heartbeats", ONLINE)
def _(t):
    return interaction.online_heartbeats(t.heartbeat_day, taxi(t), START, END)


WEEK = f"""{TRIP} AND contentid IS NOT NULL AND contentid <> '' AND adsn = ''
  AND p_date BETWEEN DATE '{TODAY}' - 7 AND DATE '{TODAY}' - 1"""
CLICKED = f"event IN ('CLICK','SLIDE') AND tag NOT IN ({N6})"
PIVOT = {
    "screen_click_trip_cnt": ("SCREEN_CLICK_SCREEN", "screen_click"), "recommend_swith_trip_cnt": ("video_recommend_swith",),
    "click_speaker_button_trip_cnt": ("SCREEN_CLICK_SPEAKER_BUTTON",), "volume_change_trip_cnt": ("SCREEN_OTHER_VOLUME_CHANGE",),
    "recommend_click_trip_cnt": ("video_recommend_click",), "recommend_change_trip_cnt": ("video_recommend_change",),
    "progress_change_trip_cnt": ("video_progress_change",), "pause_click_trip_cnt": ("video_pause_click",),
    "start_click_trip_cnt": ("video_start_click",),
}


def _trips(where: str) -> str:
    return f"COUNT(DISTINCT traceid) FILTER ({where})"


_PIVOTED = ", ".join(
    " + ".join(_trips(f"{CLICKED} AND tag = '{tag}'") for tag in tags) + f" AS {m}" for m, tags in PIVOT.items())


@query("r11_content_interaction", f"""
SELECT contentid, {_trips("tag = 'SCREEN_OTHER_CONTENT_BEGIN'")} AS play_trip_cnt, {_trips(CLICKED)} AS total_inter_trip_cnt, {_PIVOTED}
FROM ev WHERE {WEEK} GROUP BY contentid HAVING play_trip_cnt > 0""")
def _(t):
    return interaction.content_interaction(t.screen_event, t.excluded, TODAY)
