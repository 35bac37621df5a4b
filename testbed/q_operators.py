"""Queries of single operators: dimensions, joins, roll-ups, spines, sinks, loads."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from testbed import q_retail  # noqa: F401  registers the scan_log view used below
from testbed.q_events import ENDED_SUMMARY, LABEL, PAIR, BEGIN_SUMMARY, agents, city, days
from testbed.q_scale import AGENT_COLUMNS, R13_SQL, agent_bindings, bindings, inputs
from testbed.registry import REGISTRY, plain, query, scratch_dir
from testbed.tables import CAMPAIGN_RULES, END, HISTORY, LATE_START, RULES, START, TODAY
from tidemark.functions import predicates as P
from tidemark.functions.attribution import PARTS, Rule, attributed
from tidemark.operators import dims, frames
from tidemark.operators.cumulative import first_seen, merge_first_seen
from tidemark.operators.presence import marks, presence, seen
from tidemark.operators.rollup import roll_up
from tidemark.operators.trips import device_days
from tidemark.plans import daily, interaction, plays, scale, trip_day
from tidemark.sinks import days as sink
from tidemark.sinks.layouts import LAYOUTS, ZERO, to_layout
from tidemark.sources.tables import clean_cells
from tidemark.streaming import incremental, kept

D = dt.date.fromisoformat


def scratch(t, name: str) -> str:
    return f"{scratch_dir(t.spark)}/{name}"


# --- sources ---------------------------------------------------------------------------

@query("s1_clean_cells", """
SELECT p_date, CASE WHEN utmsource = '' THEN '0' ELSE utmsource END AS utmsource, CASE WHEN page = '' THEN '0' ELSE page END AS page,
  TRY_CAST(CASE WHEN versioncode = '' THEN '0' ELSE versioncode END AS DOUBLE) AS versioncode, ROUND(playtime, 3) AS playtime
FROM screen_event""")
def _(t):
    cols = t.screen_event.select("p_date", "utmsource", "page", "versioncode", "playtime")
    return plain(clean_cells(cols, measures=["versioncode", "playtime"]))


@query("s2_clean_text_cells", """
SELECT CASE WHEN adsn = '' THEN '0' ELSE adsn END AS adsn, CASE WHEN traceid = '' THEN '0' ELSE traceid END AS traceid,
  versioncode FROM screen_event""")
def _(t):
    return clean_cells(t.screen_event.select("adsn", "traceid", "versioncode"))


def write_logs(t, root: str, where: str) -> None:
    """Some of the log lines as day logs of two hosts, a module on each, beside what is there."""
    lines = t.scan_line.withColumn("crc", F.crc32(F.col("value").cast("binary"))).filter(where)
    day = F.coalesce(F.substr("value", F.lit(1), F.lit(10)).try_cast("date"), F.substr("value", F.lit(8), F.lit(10)).try_cast("date"), F.lit("1999-05-14").cast("date"))
    lines.select("value", F.when(F.col("crc") % 2 == 0, "host_a").otherwise("host_b").alias("host"), F.when(F.col("crc") % 2 == 0, "goods-web").otherwise(
        "order-web").alias("folder"), F.concat(F.lit("app.log."), day.cast("string")).alias("log")).hint("rebalance", F.col("host"), F.col("folder"), F.col("log")).write.mode("append").partitionBy(
            "host", "folder", "log").text(root)


def load_logs(t) -> str:
    """The path of the scan log after two loads: the second finds further files of logs that were read, new logs and old ones."""
    root, path = scratch(t, "logs"), scratch(t, "scan_log")
    write_logs(t, root, "crc % 7 < 3 AND (crc % 2 = 0 OR crc % 3 > 0)")
    daily.load_scan_logs(t.spark, root, path, D("1990-01-01"), D("1999-05-20"))
    write_logs(t, root, "crc % 7 >= 3 AND (crc % 2 = 0 OR crc % 3 > 0)")
    write_logs(t, root, "crc % 2 = 1 AND crc % 3 = 0")
    daily.load_scan_logs(t.spark, root, path, D("1990-01-01"), D("2030-01-01"))
    return path


@query("s7_log_files", "SELECT module, user_tel, user_id, shelf_sn, driver_id, add_time FROM scan_log")
def _(t):
    return t.spark.read.parquet(load_logs(t)).select("module", "user_tel", "user_id", "shelf_sn", "driver_id", "add_time")


@query("d4_rejects_of_log_files", f"SELECT * FROM ({REGISTRY['d4_scan_log_rejects'].sql}) rejects")
def _(t):
    return t.spark.read.parquet(load_logs(t) + "_rejects").select("line")


# --- dimensions --------------------------------------------------------------------------

@query("j5_city_dim", "SELECT third_code, city_sn, car_type FROM dim")
def _(t):
    return city(t)


@query("j5_taxi_dim", "SELECT third_code, city_sn, car_type FROM taxi_dim")
def _(t):
    return dims.taxi_dim(t.device_service, t.screen_info, t.screen_car, RULES)


@query("j6_agent_dim", "SELECT * FROM agent_dim")
def _(t):
    return agents(t)


@query("j6_vendor_dim", "SELECT * FROM vendor_dim")
def _(t):
    return dims.vendor_dim(t.device_service, t.screen_info, RULES)


@query("j5_city_bindings", "SELECT third_code, city_sn, car_type, bind_day FROM dim")
def _(t):
    return bindings(t)


@query("j5_agent_bindings", "SELECT third_code, parent_id, bind_day FROM dim")
def _(t):
    return agent_bindings(t)


@query("a18_one_agent_per_device", """
SELECT parent_id, COUNT(1) AS devices FROM
  (SELECT third_code, MIN(parent_id) AS parent_id FROM dim
   WHERE third_code IN (SELECT device_name FROM trip_all) GROUP BY third_code) x GROUP BY parent_id""")
def _(t):
    total = scale.device_totals(scale.device_firsts(inputs(t), END), agent_bindings(t), ("parent_id",), END, END,
                                one_group=True)
    return total.filter("total_trip_dev_num > 0").select("parent_id", F.col("total_trip_dev_num").alias("devices"))


# --- joins ---------------------------------------------------------------------------------

@query("j2_left_join_null_keys", """
SELECT a.contentid, a.adsn, a.n, COALESCE(b.scans, 0) AS scans FROM
  (SELECT contentid, adsn, COUNT(1) AS n FROM screen_event WHERE event = 'CLICK' GROUP BY 1, 2) a
LEFT JOIN (SELECT contentid, adsn, COUNT(1) AS scans FROM screen_event WHERE event = 'SCAN' GROUP BY 1, 2) b
  ON a.contentid IS NOT DISTINCT FROM b.contentid AND a.adsn IS NOT DISTINCT FROM b.adsn""")
def _(t):
    keys = ["contentid", "adsn"]
    left = t.screen_event.filter("event = 'CLICK'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    right = t.screen_event.filter("event = 'SCAN'").groupBy(*keys).agg(F.count(F.lit(1)).alias("scans"))
    return frames.zero_fill(frames.left_join_null_safe(left, right, keys), ["scans"])


@query("j4_full_outer_align", """
SELECT COALESCE(a.sn, b.device_name) AS device, CAST(COALESCE(a.beats, 0) AS BIGINT) AS beats, CAST(COALESCE(b.trips, 0) AS BIGINT) AS trips
FROM (SELECT sn, COUNT(1) AS beats FROM heartbeat_day GROUP BY sn) a
FULL JOIN (SELECT device_name, COUNT(1) AS trips FROM trip_archive_2 GROUP BY 1) b ON a.sn = b.device_name""")
def _(t):
    beats = t.heartbeat_day.groupBy(F.col("sn").alias("device")).agg(F.count(F.lit(1)).alias("beats"))
    trips = t.trip_archive_2.groupBy(F.col("device_name").alias("device")).agg(F.count(F.lit(1)).alias("trips"))
    return frames.align([beats, trips], ["device"])


@query("j10_heartbeat_with_trip", """
SELECT DISTINCT sn, day FROM heartbeat_day
WHERE (sn, day) IN (SELECT (device_name, CAST(add_time AS DATE)) FROM trip_live)""")
def _(t):
    shown = presence(marks(heartbeat=t.heartbeat_day, server=t.trip_server, client=t.trip_client))
    return shown.filter(seen("heartbeat") & (seen("server") | seen("client"))).select(F.col("device").alias("sn"), "day")


@query("j11_not_in", """
SELECT third_code, city_sn, car_type FROM dim
WHERE third_code NOT IN (SELECT device_name FROM abnormal_device WHERE device_name IS NOT NULL)""")
def _(t):
    listed = t.abnormal_device.filter("device_name is not null")
    return frames.not_in(city(t), "third_code", listed, "device_name")


@query("j11_not_in_list_with_null", """
SELECT third_code, city_sn, car_type FROM dim WHERE third_code NOT IN (SELECT device_name FROM abnormal_device)""")
def _(t):
    return frames.not_in(city(t), "third_code", t.abnormal_device, "device_name")


KNOWN = """SELECT devicename, COUNT(1) AS n FROM screen_event
WHERE devicename NOT IN (SELECT devicename FROM excluded_device) GROUP BY devicename"""


def _known(t, excluded):
    return P.known_devices(t.screen_event, excluded).groupBy("devicename").agg(F.count(F.lit(1)).alias("n"))


@query("p6_known_devices_list", KNOWN)
def _(t):
    return _known(t, t.excluded)


@query("p6_known_devices_broadcast", KNOWN)
def _(t):
    # a list with NULLs and the same devices twice
    return _known(t, P.exclusions(t.excluded_device.union(t.excluded_device).union(t.spark.sql("SELECT string(NULL)"))))


@query("p6_known_devices_hash", KNOWN)
def _(t):
    # the list as it is, without being made distinct before
    return _known(t, t.excluded_device)


# --- aggregation ------------------------------------------------------------------------------

@query("a8_exact_pair_key", f"""
SELECT s.day AS date, COALESCE(a.n, 0) AS daily_play_trip_content_cnt FROM span s LEFT JOIN
  (SELECT p_date, COUNT(DISTINCT (traceid, contentid)) AS n FROM ev WHERE {PAIR} AND tag = 'SCREEN_OTHER_CONTENT_BEGIN'
   GROUP BY p_date) a ON s.day = a.p_date""")
def _(t):
    # With the length in front two different pairs never read the same.
    key = F.concat(F.length("traceid").cast("string"), F.lit(":"), "traceid", "contentid")
    counts = interaction.interaction_counts(t.screen_event, t.excluded, START, END, content_key=key)
    spine = frames.day_spine(t.spark, START, END, "date")
    return spine.join(counts, "date", "left").select("date", "daily_play_trip_content_cnt").fillna(0)


@query("a9_first_seen_state", "SELECT sn, MIN(day) AS day FROM heartbeat_day GROUP BY sn")
def _(t):
    cut = F.col("day") < F.lit("2024-01-15").cast("date")
    state = first_seen(t.heartbeat_day.filter(cut), ["sn"])
    return merge_first_seen(state, t.heartbeat_day.filter(~cut), ["sn"])


@query("a12_agent_count", """
SELECT date, parent_id, COUNT(devicename) AS devices FROM (SELECT DISTINCT p_date AS date, devicename FROM ev) x
JOIN agent_dim d ON x.devicename = d.third_code WHERE parent_id IS NOT NULL GROUP BY 1, 2""")
def _(t):
    per_device = days(t).select(F.col("p_date").alias("date"), "devicename")
    return roll_up(per_device, agents(t), ["date", "parent_id"], count="devices")


_VENDOR_SUM = """SELECT date, type, CAST(SUM(trip_cnt) AS BIGINT) AS trip_cnt, CAST(SUM({ads}) AS BIGINT) AS {ads}
FROM ({q}) x JOIN vendor_dim v ON x.devicename = v.third_code GROUP BY 1, 2"""


@query("a13_vendor_sum", _VENDOR_SUM.format(ads="ad_cnt", q=BEGIN_SUMMARY))
def _(t):
    vendor = dims.vendor_dim(t.device_service, t.screen_info, RULES)
    per_device = days(t).filter("trip_cnt > 0").withColumnRenamed("p_date", "date")
    return roll_up(per_device, vendor, ["date", "type"], sums=["trip_cnt", "ad_cnt"])


@query("a14_city_range_sum", f"""
SELECT date, city_sn, CAST(SUM(trip_cnt) AS BIGINT) AS trip_cnt, CAST(SUM(ad_cnt) AS BIGINT) AS ad_cnt_ended,
  COUNT(1) AS devices FROM ({ENDED_SUMMARY}) x JOIN dim ON x.devicename = dim.third_code
WHERE city_sn IS NOT NULL GROUP BY 1, 2""")
def _(t):
    per_device = days(t).filter("trip_cnt > 0").withColumnRenamed("p_date", "date")
    return roll_up(per_device, city(t), ["date", "city_sn"], sums=["trip_cnt", "ad_cnt_ended"], count="devices")


@query("f4_attribution_from_rule_table", """
SELECT CASE WHEN utmsource = 'src2' AND utmcampaign = 'camp1' THEN 'x1' WHEN utmcontent LIKE '%/b/4%' THEN 'x2'
  WHEN utmsource = 'src2' THEN 'x3' ELSE 'else ' END AS video, COUNT(1) AS n FROM screen_event GROUP BY 1""")
def _(t):
    # Rules out of order on purpose: the priority decides.
    table = t.spark.createDataFrame(
        [(3, "src2", None, None, None, "x3"), (1, "src2", "camp1", None, None, "x1"), (2, None, None, "/b/4", "contains", "x2")],
        "priority int, utm_source string, utm_campaign string, content_match string, match_kind string, target string")
    counted = t.screen_event.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("n"))
    return attributed(counted, table).groupBy("video").agg(F.sum("n").alias("n"))


# A rule for every order: 1,500 at sf0.001, 15,000 at sf0.01.  Some match by parts of the content.
_RULES = """SELECT CAST(o_orderkey AS INT) AS priority, 'o' || CAST(o_orderkey AS {text}) AS target,
  CASE WHEN o_orderkey % 4 < 3 THEN 'src' || CAST(o_orderkey % 7 AS {text}) END AS utm_source,
  CASE WHEN o_orderkey % 3 > 0 THEN 'camp' || CAST(o_orderkey % 5 AS {text}) END AS utm_campaign,
  CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 3 > 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'x//a/' || CAST(o_orderkey % 90 AS {text})
    ELSE 'http://b/' || CAST(o_orderkey % 11 AS {text}) END AS content_match,
  CASE WHEN o_orderkey % 97 = 0 THEN 'contains' ELSE 'eq' END AS match_kind FROM {orders}"""


@query("f4_attribution_many_rules", f"""
WITH rules AS ({_RULES.format(text="VARCHAR", orders="orders")}),
seen AS (SELECT utmsource, utmcampaign, utmcontent, COUNT(*) AS n FROM screen_event GROUP BY ALL),
chosen AS (SELECT s.utmsource, s.utmcampaign, s.utmcontent, s.n, arg_min(r.target, r.priority) AS target FROM seen s LEFT JOIN rules r
  ON (r.utm_source IS NULL OR r.utm_source = s.utmsource) AND (r.utm_campaign IS NULL OR r.utm_campaign = s.utmcampaign)
  AND (r.content_match IS NULL OR r.content_match = s.utmcontent OR (r.match_kind = 'contains' AND contains(s.utmcontent, r.content_match)))
  GROUP BY ALL)
SELECT COALESCE(target, 'else ') AS video, CAST(SUM(n) AS BIGINT) AS n FROM chosen GROUP BY 1""")
def _(t):
    rules = t.spark.sql(_RULES.format(text="STRING", orders="{orders}"), orders=t.orders)
    counted = t.screen_event.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("n"))
    return attributed(counted, rules).groupBy("video").agg(F.sum("n").alias("n"))


# A rule of containment for every order: pieces that many rules have, some of one or two characters, most of them in no content.
_CONTAINED = """SELECT CAST(o_orderkey AS INT) AS priority, 'o' || CAST(o_orderkey AS {text}) AS target,
  CASE WHEN o_orderkey % 3 = 0 THEN 'src' || CAST(o_orderkey % 7 AS {text}) END AS utm_source,
  CASE WHEN o_orderkey % 5 = 0 THEN 'camp' || CAST(o_orderkey % 5 AS {text}) END AS utm_campaign,
  CASE WHEN o_orderkey % 101 = 0 THEN '/' || CAST(o_orderkey % 10 AS {text}) WHEN o_orderkey % 103 = 0 THEN CAST(o_orderkey % 10 AS {text})
    WHEN o_orderkey % 89 = 0 THEN '//b/' || CAST(o_orderkey % 10 AS {text}) ELSE 'http://b/' || CAST(o_orderkey AS {text}) END AS content_match,
  'contains' AS match_kind FROM {orders}"""


@query("f4_attribution_contained_pieces", f"""
WITH rules AS ({_CONTAINED.format(text="VARCHAR", orders="orders")}),
seen AS (SELECT utmsource, utmcampaign, utmcontent, COUNT(*) AS n FROM screen_event GROUP BY ALL),
chosen AS (SELECT s.utmsource, s.utmcampaign, s.utmcontent, s.n, arg_min(r.target, r.priority) AS target FROM seen s LEFT JOIN rules r
  ON (r.utm_source IS NULL OR r.utm_source = s.utmsource) AND (r.utm_campaign IS NULL OR r.utm_campaign = s.utmcampaign)
  AND contains(s.utmcontent, r.content_match) GROUP BY ALL)
SELECT COALESCE(target, 'else ') AS video, CAST(SUM(n) AS BIGINT) AS n FROM chosen GROUP BY 1""")
def _(t):
    rules = t.spark.sql(_CONTAINED.format(text="STRING", orders="{orders}"), orders=t.orders)
    counted = t.screen_event.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("n"))
    return attributed(counted, rules).groupBy("video").agg(F.sum("n").alias("n"))


@query("i2_zero_filled_days", """
SELECT s.day, COALESCE(x.n, 0) AS n FROM span s LEFT JOIN
  (SELECT p_date, COUNT(1) AS n FROM screen_event WHERE tag = 'video_zoomin' AND event = 'ZOOM' AND page = '40' GROUP BY p_date) x
  ON s.day = x.p_date""")
def _(t):
    rows = t.screen_event.filter("tag = 'video_zoomin' and event = 'ZOOM' and page = '40'")
    counts = rows.groupBy(F.col("p_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spine = frames.day_spine(t.spark, START, END)
    return frames.zero_fill(spine.join(counts, "day", "left"), ["n"])


# --- sinks and loads -----------------------------------------------------------------------------

def _beats(t):
    return t.heartbeat_day.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


BEATS_SQL = "SELECT day, COUNT(1) AS n FROM heartbeat_day GROUP BY day"


@query("k1_append_days", f"{BEATS_SQL} UNION ALL {BEATS_SQL}")
def _(t):
    path = scratch(t, "beats")
    sink.append_days(_beats(t), path)
    sink.append_days(_beats(t), path)
    return t.spark.read.parquet(path).select("day", "n")


@query("k2_replace_days", f"""
SELECT day, CASE WHEN day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' THEN n + 1 ELSE n END AS n FROM ({BEATS_SQL}) x
WHERE day <> DATE '2024-01-06' AND day BETWEEN DATE '{START}' AND DATE '{END}'""")
def _(t):
    path, beats = scratch(t, "beats"), _beats(t)
    sink.replace_days(beats, path, START, END)
    # A second load of some days, one of them now without rows.
    again = beats.filter("day <> '2024-01-06'").withColumn("n", F.col("n") + 1)
    for _ in range(2):
        sink.replace_days(again, path, "2024-01-05", "2024-01-20")
    return t.spark.read.parquet(path).select("day", "n")


@query("k3_full_refresh", BEATS_SQL)
def _(t):
    path = scratch(t, "beats")
    for factor in (5, 4, 3, 2, 1):  # more often than there are folders for versions
        sink.refresh(_beats(t).withColumn("n", F.col("n") * factor), path)
    return sink.read_report(t.spark, path)


@query("k3_refresh_that_stopped", BEATS_SQL)
def _(t):
    path = scratch(t, "beats")
    sink.refresh(_beats(t).withColumn("n", F.col("n") * 2), path)
    sink.refresh(_beats(t), path)
    # the next one writes its rows and dies before it names the version
    _beats(t).withColumn("n", F.col("n") * 7).write.mode("overwrite").parquet(f"{path}/versions/{3 % sink.SLOTS}")
    return sink.read_report(t.spark, path)


@query("o2_interaction_in_order", f"""
SELECT date, play_trip_cnt, row_number() OVER (ORDER BY date) AS place FROM ({REGISTRY['r9_interaction_day'].sql}) report""")
def _(t):
    path = scratch(t, "interaction")
    sink.refresh(interaction.interaction_day(t.screen_event, t.excluded, START, END), path, order=["date"])
    return sink.read_ordered(sink.read_report(t.spark, path)).select("date", "play_trip_cnt", "place")


@query("o2_scan_total_newest_first", f"""
SELECT *, row_number() OVER (ORDER BY date DESC, video) AS place FROM ({REGISTRY['r1c_scan_total'].sql}) report""")
def _(t):
    path = scratch(t, "scans")
    total = plays.scan_total(t.screen_event, CAMPAIGN_RULES, t.excluded, LATE_START, END, history=HISTORY)
    # several files, as a large table has
    sink.refresh(total.repartition(4), path, order=[F.desc("date"), "video"])
    return sink.read_ordered(sink.read_report(t.spark, path))


@query("k5_sink_layout", f"""
SELECT p_date AS date, {LABEL.format('contentid')} AS contentid, tag, COUNT(1) AS play_cnt, CAST(0 AS BIGINT) AS total_scan_cnt
FROM ev WHERE (tag IN ('SCREEN_OTHER_CONTENT_BEGIN','splash_show_begin','video_banner_click','click_video_detail','video_banner_show')
  OR (tag = 'SCREEN_OTHER_RECOVER_END' AND message LIKE '内容正常结束%'))
  AND traceid <> '' AND TRY_CAST(versioncode AS INT) >= 179 GROUP BY p_date, contentid, tag""")
def _(t):
    report = plays.content_play_day(t.screen_event, CAMPAIGN_RULES, t.excluded, START, END)
    return to_layout(report, "content_play_day").select("date", "contentid", "tag", "play_cnt", "total_scan_cnt")


def _laid_out(of: str, report: str) -> str:
    """The columns of a report's table, from the oracle of the report."""
    return "SELECT " + ", ".join(
        c if isinstance(c, str) else f"CAST({0 if c[1] is ZERO else 'NULL'} AS BIGINT) AS {c[0]}" for c in LAYOUTS[report]) + (
        f" FROM ({REGISTRY[of].sql}) report")


for _report, _of in {"content_play_day": "r1_content_play_day", "ad_play_day": "r2_ad_play_day",
                     "ad_play_fulltime": "r3_ad_play_fulltime", "agent_day": "r14_agent_day"}.items():
    query(f"k5_{_report}", _laid_out(_of, _report))(lambda t, r=_report, q=_of: to_layout(REGISTRY[q].build(t), r))


@query("o1_days_in_order", """
SELECT day, sn, CAST(row_number() OVER (PARTITION BY day ORDER BY sn) AS INTEGER) AS place FROM (SELECT DISTINCT day, sn FROM heartbeat_day)""")
def _(t):
    # rows of a day come back in the order of the file they were written to
    path = scratch(t, "sorted")
    rows = t.heartbeat_day.select("day", "sn").distinct()
    sink.append_days(rows, path, sort=("sn",))
    read = t.spark.read.parquet(path).withColumn("at", F.monotonically_increasing_id())
    return read.select("day", "sn", F.row_number().over(Window.partitionBy("day").orderBy("at")).alias("place"))


@query("s8_high_water_mark", "SELECT MAX(day) AS mark, DATE '2019-08-01' AS mark_of_nothing FROM heartbeat_day")
def _(t):
    path = scratch(t, "beats")
    sink.append_days(_beats(t), path)
    marks = (sink.high_water_mark(t.spark, path, D("2019-08-01")),
             sink.high_water_mark(t.spark, path + "-none", D("2019-08-01")))
    return t.spark.createDataFrame([marks], "mark date, mark_of_nothing date")


@query("i1_incremental_loads", """
SELECT p_date AS date, CASE WHEN contentid IS NULL OR contentid = '' THEN '0' ELSE contentid END AS contentid, tag,
  COUNT(DISTINCT traceid) AS play_trip_cnt, COUNT(1) AS play_cnt
FROM ev WHERE (tag IN ('SCREEN_OTHER_CONTENT_BEGIN','splash_show_begin','video_banner_click','click_video_detail','video_banner_show')
  OR (tag = 'SCREEN_OTHER_RECOVER_END' AND message LIKE '内容正常结束%'))
  AND traceid <> '' AND TRY_CAST(versioncode AS INT) >= 179 GROUP BY p_date, contentid, tag""")
def _(t):
    report = incremental.Report(
        "content_play_day", day="date", default=D(START) - dt.timedelta(days=1),
        build=lambda w: plays.content_play_day(t.screen_event, CAMPAIGN_RULES, t.excluded, w.start, w.end))
    path = scratch(t, "content_play_day")
    for today in ("2024-01-11", "2024-01-11", TODAY):
        incremental.load(t.spark, report, path, D(today))
    return t.spark.read.parquet(path).select("date", "contentid", "tag", "play_trip_cnt", "play_cnt")


def _two_runs(t, name: str, run):
    """The report's table after a first run to the middle of the window and a second one from there."""
    path = scratch(t, name)
    report = incremental.Report(name, None, day="date", default=D(LATE_START) - dt.timedelta(days=1), run=run)
    for today in (D("2024-01-18"), D("2024-01-18"), D(TODAY)):
        incremental.load(t.spark, report, path, today)
    return t.spark.read.parquet(path)


@query("i3_content_total_in_two_runs", f"SELECT * FROM ({REGISTRY['r1b_content_play_total'].sql}) report")
def _(t):
    run = lambda w, s: plays.content_play_run(t.screen_event, t.excluded, w.start, w.end, s, history=HISTORY)
    return plain(_two_runs(t, "content_play_total", run))


@query("i3_ad_total_in_two_runs", f"SELECT * FROM ({REGISTRY['r2a_ad_play_total'].sql}) report")
def _(t):
    run = lambda w, s: plays.ad_play_run(t.screen_event, city(t), t.excluded, w.start, w.end, s, history=HISTORY)
    return plain(_two_runs(t, "ad_play_total", run))


def _ad_fulltime_run(t):
    return lambda w, s: plays.ad_play_fulltime_run(t.screen_event, city(t), t.excluded, w.start, w.end, s, history=HISTORY)


def _ad_run(t):
    return lambda w, s: plays.ad_play_run(t.screen_event, city(t), t.excluded, w.start, w.end, s, history=HISTORY)


def _content_run(t):
    return lambda w, s: plays.content_play_run(t.screen_event, t.excluded, w.start, w.end, s, history=HISTORY)


@query("i3_ad_fulltime_total_in_two_runs", f"SELECT * FROM ({REGISTRY['r3a_ad_play_fulltime_total'].sql}) report")
def _(t):
    return plain(_two_runs(t, "ad_play_fulltime_total", _ad_fulltime_run(t)))


@query("i3_points_total_in_two_runs", f"SELECT * FROM ({REGISTRY['r5c_points_total'].sql}) report")
def _(t):
    run = lambda w, s: trip_day.points_run(t.screen_event, city(t), t.excluded, w.start, w.end, s, history=HISTORY)
    return _two_runs(t, "points_total", run)


@query("i3_on_road_total_in_two_runs", f"SELECT * FROM ({REGISTRY['r5d_on_road_total'].sql}) report")
def _(t):
    # the second run takes its days from the device days that other reports share
    def run(w, s):
        days_of = device_days(P.prod_events(t.screen_event, t.excluded, w.start, w.end))
        return trip_day.on_road_run(t.screen_event, city(t), t.excluded, w.start, w.end, s, history=HISTORY, days=days_of)
    return _two_runs(t, "on_road_total", run)


@query("i3_scan_total_under_new_rules", f"SELECT * FROM ({REGISTRY['r1c_scan_total'].sql}) report WHERE date >= DATE '2024-01-18'")
def _(t):
    old = [Rule(1, "c9", content="http://b/", kind="contains"), Rule(2, "gone", source="src1")]

    def run(w, s):  # the first run has other rules
        rules = old if s is None else CAMPAIGN_RULES
        return plays.scan_run(t.screen_event, rules, t.excluded, w.start, w.end, s, history=HISTORY)
    return _two_runs(t, "scan_total", run).filter("date >= '2024-01-18'")


def _with_stops(t, name: str, run):
    """The report's table after runs of which two have stopped: one after its state was committed and before its rows were
    written, one after the first table of its state."""
    path = scratch(t, name)
    report = incremental.Report(name, None, day="date", default=D(LATE_START) - dt.timedelta(days=1), run=run)
    incremental.load(t.spark, report, path, D("2024-01-15"))
    before = kept.kept(t.spark, path)
    stopped = incremental.next_window(before.upto, D("2024-01-18"))
    kept.commit(t.spark, path, run(stopped, before.state), stopped.end, before)
    run(stopped, before.state).added.write.parquet(f"{path}_state/added/{before.commits[0].number + 2}")
    for today in (D("2024-01-20"), D(TODAY)):
        incremental.load(t.spark, report, path, today)
    return t.spark.read.parquet(path)


@query("i3_after_a_stop", f"SELECT * FROM ({REGISTRY['r1b_content_play_total'].sql}) report")
def _(t):
    return plain(_with_stops(t, "content_play_total", _content_run(t)))


@query("i3_ad_total_after_a_stop", f"SELECT * FROM ({REGISTRY['r2a_ad_play_total'].sql}) report")
def _(t):
    return plain(_with_stops(t, "ad_play_total", _ad_run(t)))


@query("i3_ad_fulltime_total_after_a_stop", f"SELECT * FROM ({REGISTRY['r3a_ad_play_fulltime_total'].sql}) report")
def _(t):
    return plain(_with_stops(t, "ad_play_fulltime_total", _ad_fulltime_run(t)))


@query("i1_reload_of_an_earlier_day", f"SELECT * FROM ({REGISTRY['r1b_content_play_total'].sql}) report")
def _(t):
    # some rows of a day come late: the day is loaded again when the table is well past it
    late = t.screen_event.filter("NOT (p_date = '2024-01-12' AND devicename LIKE '%3')")
    path = scratch(t, "content_play_total")

    def report(events):
        run = lambda w, s: plays.content_play_run(events, t.excluded, w.start, w.end, s, history=HISTORY)
        return incremental.Report("content_play_total", None, day="date", default=D(LATE_START) - dt.timedelta(days=1), run=run)

    for today in (D("2024-01-12"), D("2024-01-16"), D("2024-01-21")):
        incremental.load(t.spark, report(late), path, today)
    incremental.load(t.spark, report(t.screen_event), path, D("2024-01-21"), since=D("2024-01-12"))
    incremental.load(t.spark, report(t.screen_event), path, D(TODAY))
    return plain(t.spark.read.parquet(path))


# --- whole daily runs ------------------------------------------------------------------------------

def screen_run(t, **changes):
    tables = daily.ScreenTables(
        t.screen_event, t.device_service, t.screen_info, t.screen_car, t.device_snapshot, t.heartbeat_day, t.trip_server,
        t.trip_client, t.archives, t.sensor_summary, t.abnormal_device, t.excluded)
    return dataclasses.replace(tables, **changes)


# The run's own calendar holds every day of the window.
@query("i4_scale_after_trip_day", R13_SQL.replace("SELECT day FROM calendar INTERSECT ", "").replace("calendar a", "span a"))
def _(t):
    root = scratch(t, "screen")
    reports = daily.screen_reports(t.spark, screen_run(t), RULES, CAMPAIGN_RULES, root, D(START) - dt.timedelta(days=1))
    wanted = [r for r in reports if r.name in ("calendar", "trip_day", "device_firsts", "device_scale")]
    incremental.run_all(t.spark, wanted, root, D(TODAY))
    return plain(t.spark.read.parquet(f"{root}/device_scale"))


def _scale_in_two_runs(t, name: str):
    """The days of a second run; devices bound after the first one count in it from their binding on."""
    root, mark = scratch(t, "screen"), D(START) - dt.timedelta(days=1)
    early = t.device_service.filter("add_time < '2024-01-08'")
    for today, service in ((D("2024-01-17"), early), (D(TODAY), t.device_service)):
        reports = daily.screen_reports(t.spark, screen_run(t, service=service), RULES, CAMPAIGN_RULES, root, mark)
        incremental.run_all(t.spark, [r for r in reports if r.name in ("calendar", "device_firsts", name)], root, today)
    return plain(t.spark.read.parquet(f"{root}/{name}").filter("day >= '2024-01-17'"))


@query("i3_device_scale_in_two_runs", f"""
SELECT * FROM ({R13_SQL.replace("SELECT day FROM calendar INTERSECT ", "").replace("calendar a", "span a")}) report WHERE day >= DATE '2024-01-17'""")
def _(t):
    return _scale_in_two_runs(t, "device_scale")


@query("i3_agent_day_in_two_runs", f"""
SELECT * FROM ({REGISTRY['r14_agent_day'].sql.replace("SELECT day FROM calendar INTERSECT ", "").replace("calendar a", "span a")}) report
WHERE day >= DATE '2024-01-17'""")
def _(t):
    report = _scale_in_two_runs(t, "agent_day")
    return report.select(*[c for c in report.columns if c in AGENT_COLUMNS])
