"""Semantic traps, one tiny hand-made frame each."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from testbed.tables import RULES
from tidemark.functions import cells
from tidemark.functions import predicates as P
from tidemark.functions.attribution import RULE_SCHEMA, Rule, _rule_index, attributed
from tidemark.operators import dims, frames
from tidemark.operators.flags import Where, distinct_counts, row_counts
from tidemark.operators.rollup import roll_up
from tidemark.operators.trips import device_days, with_points
from tidemark.plans import clicks, interaction, plays, retail, scale, trip_day
from tidemark.sources import logs, schemas
from tidemark.sources.tables import clean_cells

D = dt.date
DAY = D(2024, 3, 1)
EVENT_COLUMNS = [c.split()[0] for c in schemas.SCREEN_EVENT.replace("\n", " ").split(",")]


def events(spark, *rows):
    base = dict.fromkeys(EVENT_COLUMNS) | {
        "p_date": DAY, "time_stamp": 1000, "devicename": "d1", "traceid": "t1", "contentid": "c1", "adsn": "ad1",
        "tag": "splash_show_begin", "event": "CLICK", "category": "TAXI", "page": "2", "env": "prod",
        "versioncode": "200", "playtime": 1.0}
    return spark.createDataFrame([tuple((base | r)[c] for c in EVENT_COLUMNS) for r in rows], schemas.SCREEN_EVENT)


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.fixture
def city(spark):
    return spark.createDataFrame([("d1", 1, "A"), ("d2", 2, "B")], "third_code string, city_sn int, car_type string")


def test_null_group_keys_are_dropped_in_roll_ups(spark):  # T1
    facts = spark.createDataFrame([("d1", 1), ("d2", 2)], "devicename string, n int")
    dim = spark.createDataFrame([("d1", None), ("d2", 7)], "third_code string, city_sn int")
    assert rows(roll_up(facts, dim, ["city_sn"], sums=["n"])) == [(7, 2)]


def test_null_keys_match_in_metric_joins(spark):  # T2
    a = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    b = spark.createDataFrame([(None, 3), ("a", 4)], "k string, y int")
    assert rows(frames.left_join_null_safe(a, b, ["k"]), "k", "x", "y") == [("a", 2, 4), (None, 1, 3)]


def test_empty_text_is_zero_and_bad_numbers_are_null(spark):  # T3, T22
    df = spark.createDataFrame([("",), (None,), ("3",), ("x",)], "v string").withColumn("k", F.col("v"))
    got = clean_cells(df, measures=["v"]).select("k", "v").collect()
    assert [tuple(r) for r in got] == [("0", 0.0), (None, None), ("3", 3.0), ("x", None)]
    e = events(spark, {"versioncode": "bad"}, {"versioncode": "179"}, {"versioncode": None})
    assert e.filter(P.min_version(179)).count() == 1


def test_sum_of_nothing_is_zero(spark, city):  # T4
    facts = spark.createDataFrame([("d1", None)], "devicename string, n int")
    assert rows(roll_up(facts, city, ["city_sn"], sums=["n"])) == [(1, 0)]


def test_city_trips_are_sums_over_devices(spark, city):  # T5, T6
    both = city.withColumns({"city_sn": F.lit(1), "car_type": F.lit("A")})
    e = events(spark, {"devicename": "d1"}, {"devicename": "d2"}, {"devicename": "d2"})  # one trip id on two devices
    got = rows(plays.ad_play_day(e, both, None, DAY, DAY), "play_dev_cnt", "play_trip_cnt", "play_cnt")
    assert got == [(2, 2, 3)]


def test_device_bound_twice_counts_twice(spark):  # T7
    facts = spark.createDataFrame([("d1", 5)], "devicename string, n int")
    dim = spark.createDataFrame([("d1", 1), ("d1", 1)], "third_code string, city_sn int")
    assert rows(roll_up(facts, dim, ["city_sn"], sums=["n"], count="devices")) == [(1, 10, 2)]


def test_scans_repeat_on_each_tag_of_a_content(spark):  # T8
    e = events(spark, {"tag": "splash_show_begin"}, {"tag": "click_video_detail"},
               {"event": "SCAN", "tag": "x", "utmsource": "s", "traceid": None})
    got = rows(plays.content_play_day(e, [Rule(1, "c1", source="s")], None, DAY, DAY), "tag", "scan_cnt")
    assert got == [("click_video_detail", 1), ("splash_show_begin", 1)]


def test_ad_report_without_play_time_is_zero(spark, city):  # T9
    e = events(spark, {"playtime": None})
    assert rows(plays.ad_play_day(e, city, None, DAY, DAY), "play_time") == [(0.0,)]


def test_play_needs_normal_end_but_play_time_does_not(spark):  # T10
    e = events(spark, {"tag": "SCREEN_OTHER_RECOVER_END", "message": "内容正常结束 1", "playtime": 2.0},
               {"tag": "SCREEN_OTHER_RECOVER_END", "message": "cut", "playtime": 3.0, "traceid": "t2"})
    got = rows(plays.content_play_day(e, [], None, DAY, DAY), "play_trip_cnt", "play_cnt", "play_time")
    assert got == [(1, 1, 5.0)]


def test_empty_window_gives_empty_reports(spark, city):  # T11, I2
    e = events(spark, {})
    assert plays.content_play_day(e, [], None, "2030-01-01", "2030-01-02").count() == 0
    assert clicks.scan_extract(e, None, DAY, DAY).count() == 0
    assert frames.day_spine(spark, "2024-01-02", "2024-01-01").count() == 0
    # the interaction report still has its days, as zeros
    got = interaction.interaction_day(e, None, "2030-01-01", "2030-01-02").collect()
    assert len(got) == 2 and all(v == 0 for r in got for k, v in r.asDict().items() if k != "date")


def test_first_matching_rule_wins(spark):  # T12
    e = events(spark, {"utmsource": "s", "utmcampaign": "c"}, {"utmcontent": "xx/y"}, {"utmsource": None})
    rules = [Rule(9, "late", source="s"), Rule(1, "early", source="s", campaign="c"),
             Rule(2, "part", content="/y", kind="contains")]
    assert rows(attributed(e, rules).select("video")) == [("early",), ("else ",), ("part",)]
    assert rows(attributed(e, []).select("video")) == [("else ",)] * 3


def test_rules_of_any_shape_equal_a_scan_of_the_list(spark):
    parts = [(s, c, t) for s in ("s1", "s2", None) for c in ("c1", "c2", None) for t in ("x/1", "y/1", None)]
    e = events(spark, *[{"utmsource": s, "utmcampaign": c, "utmcontent": t} for s, c, t in parts])
    rules = [Rule(i, f"t{i}", *p, kind=k) for i, (p, k) in enumerate((p, k) for p in reversed(parts) if p != (None,) * 3 for k in ("eq", "contains"))]
    rules += [Rule(-1, "end", content="/1", kind="contains", source="s2"), Rule(200, "last", campaign="c1")]

    def first(s, c, t):
        for r in sorted(rules, key=lambda r: r.priority):
            content = r.content is None or (t is not None and (r.content in t if r.kind == "contains" else r.content == t))
            if content and r.source in (None, s) and r.campaign in (None, c):
                return r.target
        return "else "

    got = attributed(e.select("utmsource", "utmcampaign", "utmcontent"), rules).collect()
    assert {tuple(r) for r in got} == {(*p, first(*p)) for p in parts}


def as_index(table):
    return _rule_index(table.select(
        F.struct("priority", "target").alias("__rule"), F.col("utm_source").alias("__r0"), F.col("utm_campaign").alias("__r1"),
        F.col("content_match").alias("__r2"), F.coalesce("match_kind", F.lit("eq")).alias("__kind")))


def test_rules_with_one_condition_are_one_rule(spark):
    """A row meets one rule of a condition, however many have it; of these the lowest priority wins, then the smallest target."""
    same = [("s", "c", None, "eq"), ("s", None, "x/y", "eq"), (None, None, "x/y", None), (None, None, "x/y", "contains"), (None, "c", "/", "contains")]
    table = spark.createDataFrame([(i // 2, f"t{i:04d}", *s) for i in range(1000, 0, -1) for s in same]
                                  + [(None, "free", "z", None, None, None), (None, "no condition", None, None, None, None)], RULE_SCHEMA)
    assert as_index(table).count() == len(same) + 1
    e = events(spark, {"utmsource": "s", "utmcampaign": "c", "utmcontent": "q"}, {"utmsource": "o", "utmcampaign": "c", "utmcontent": "a/b"},
               {"utmcontent": "1x/y2"}, {"utmsource": "z"}, {"utmsource": None, "utmcampaign": None, "utmcontent": None})
    assert rows(attributed(e, table).select("utmsource", "utmcontent", "video")) == rows(spark.createDataFrame(
        [("s", "q", "t0001"), ("o", "a/b", "t0001"), (None, "1x/y2", "t0001"), ("z", None, "free"), (None, None, "else ")], "a string, b string, c string"))


def test_a_rule_needs_a_condition(spark):
    with pytest.raises(ValueError):
        attributed(events(spark), [Rule(1, "t")])


def test_left_join_with_condition_on_the_right_is_inner(spark):  # T13
    service = spark.createDataFrame([("d1", 1, 0, 0, "SVC-1", None), ("d2", 2, 0, 0, "SVC-1", None)], schemas.DEVICE_SERVICE)
    info = spark.createDataFrame([("d1", "a1", "app.taxi", "ok")], schemas.SCREEN_INFO)
    assert rows(dims.agent_dim(service, info, RULES)) == [("d1", "a1")]


@pytest.mark.parametrize(("listed", "expected"), [
    (["d1"], ["d2"]), (["d1", None], []), ([], ["d1", "d2", None]), ([None], [])])
def test_not_in_follows_null_rules(spark, listed, expected):  # T14
    df = spark.createDataFrame([("d1",), ("d2",), (None,)], "d string")
    lst = spark.createDataFrame([(v,) for v in listed], "x string")
    df.createOrReplaceTempView("t14"), lst.createOrReplaceTempView("l14")
    assert {r.d for r in frames.not_in(df, "d", lst, "x").collect()} == set(expected)
    assert {r.d for r in spark.sql("SELECT d FROM t14 WHERE d NOT IN (SELECT x FROM l14)").collect()} == set(expected)


def test_null_on_a_days_abnormal_list_hides_that_day(spark):  # T14 per day
    bind = spark.createDataFrame([("d1", 1, DAY), ("d2", 1, DAY)], "third_code string, k int, bind_day date")
    bad = spark.createDataFrame([("d1", D(2024, 3, 1)), (None, D(2024, 3, 2))], schemas.ABNORMAL_DEVICE)
    got = rows(scale.normal_devices(bind, bad, ["k"], D(2024, 3, 1), D(2024, 3, 3)), "day", "normal_dev_num")
    assert got == [(D(2024, 3, 1), 1), (D(2024, 3, 3), 2)]


def test_smallest_agent_of_a_device_counts_its_trips(spark):  # T15
    first = spark.createDataFrame([("d1", DAY, DAY)], "device string, first_trip date, first_beat date")
    bind = spark.createDataFrame([("d1", "b", DAY), ("d1", "a", DAY)], "third_code string, parent_id string, bind_day date")
    got = rows(scale.device_totals(first, bind, ("parent_id",), DAY, DAY, one_group=True),
               "parent_id", "total_trip_dev_num", "total_heartbeat_dev_num")
    assert got == [("a", 1, 1), ("b", 0, 1)]


def test_point_needs_the_snapshot_of_any_day_in_the_window(spark):  # T16
    e = events(spark, {}, {"devicename": "d2"})
    snap = spark.createDataFrame([(D(2024, 3, 2), "d1", 5)], schemas.DEVICE_SNAPSHOT)
    days = with_points(device_days(e), snap, D(2024, 3, 1), D(2024, 3, 2))
    assert rows(days, "devicename", "is_point") == [("d1", True), ("d2", False)]


def test_special_city_counts_ads_its_own_way(spark):  # T17, T34
    dim = spark.createDataFrame([("d1", 310100, "A"), ("d2", 2, "A"), ("d3", 3, "A")],
                                "third_code string, city_sn int, car_type string")
    e = events(spark, *[{"devicename": d, "tag": g} for d in ("d1", "d2", "d3")
                        for g in ("splash_show_begin", "screensaver_ad_begin", "SCREEN_OTHER_CONTENT_BEGIN")])
    beats = spark.createDataFrame([("d1", DAY), ("d2", DAY)], schemas.HEARTBEAT)
    snap = spark.createDataFrame([], schemas.DEVICE_SNAPSHOT)
    got = rows(trip_day.trip_day(device_days(e), snap, beats, dim, DAY, DAY), "city_sn", "ad_cnt")
    assert got == [(2, 2), (310100, 2)]  # no heartbeat in city 3: not reported
    e = e.filter("tag != 'splash_show_begin'")
    got = rows(trip_day.trip_day(device_days(e), snap, beats, dim, DAY, DAY), "city_sn", "ad_cnt")
    assert got == [(2, 1), (310100, 2)]


def test_week_ends_on_the_day_itself(spark):  # T18
    info = spark.createDataFrame([(1, 1, "SH1")], schemas.DRIVER_INFO)
    order = spark.createDataFrame([(1, 1, dt.datetime(2024, 3, 1, 23, 59))], "driver_id bigint, status int, add_time timestamp_ntz")
    got = rows(retail.week_drivers(order, info, D(2024, 2, 25), D(2024, 3, 10)), "day")
    assert got == [(D(2024, 3, d),) for d in range(1, 8)]


def test_company_without_online_drivers_or_dimension_row_is_left_out(spark):  # T19
    info = spark.createDataFrame([(1, 1, "SH1"), (2, 1, "SH2"), (3, 1, "XX")], schemas.DRIVER_INFO)
    driver = spark.createDataFrame([(1, 1, "s", dt.datetime(2024, 3, 1)), (2, 0, "s", dt.datetime(2024, 3, 1)),
                                    (3, 1, "s", dt.datetime(2024, 3, 1))], schemas.DRIVER)
    company = spark.createDataFrame([("SH1", "c", "one", 0), ("SH2", "c", "two", 0)], schemas.COMPANY)
    def empty(s):
        return spark.createDataFrame([], s)
    facts = empty(schemas.SHOP_ORDER).withColumns({"company_sn": F.lit("SH1"), "cost": F.lit(1).cast("bigint")})
    t = retail.ScorecardInputs(
        company, driver, info, empty(schemas.DRIVER_TAG), empty(schemas.DRIVER_SHELF), empty(schemas.CITY),
        empty(schemas.SHOP_ORDER), facts, empty(schemas.SCAN_LOG), empty(schemas.REPLENISHMENT), empty(schemas.ESTIMATE))
    got = retail.scorecard(t, DAY, DAY).collect()
    assert [(r.company_sn, r.online_driver_cnt, r.active_alldriver_cnt, r.gmv) for r in got] == [("SH1", 1, 1, 0)]


def test_short_supply_filter(spark):  # T20, P14, T23
    info = spark.createDataFrame([(1, 1, "SH1"), (2, 1, "sh1"), (3, 2, "SH1"), (4, 1, "SH1")], schemas.DRIVER_INFO)
    tag = spark.createDataFrame([(1, 0, 1), (2, 0, 1), (3, 0, 1), (4, 0, 0)], schemas.DRIVER_TAG)
    city = spark.createDataFrame([(1, 310100), (2, 5)], schemas.CITY)
    assert rows(retail.short_supply(info, tag, city)) == [("SH1", 1)]


def test_trip_across_midnight_is_two_trips(spark):  # T24
    e = events(spark, {"time_stamp": 86399000}, {"time_stamp": 86399900}, {"p_date": D(2024, 3, 2), "time_stamp": 86460000})
    got = rows(trip_day.trip_summary(e, None, DAY, D(2024, 3, 2)), "date", "trip_cnt", "trip_time_sum")
    assert got == [(D(2024, 3, 1), 1, 0.9), (D(2024, 3, 2), 1, 0.0)]


def test_two_ad_counts(spark):  # T25
    e = events(spark, {"tag": "SCREEN_OTHER_CONTENT_BEGIN"}, {"tag": "SCREEN_OTHER_CONTENT_BEGIN"},
               {"tag": "SCREEN_OTHER_RECOVER_END", "message": "内容正常结束"}, {"tag": "splash_show_begin", "adsn": ""})
    assert rows(device_days(e), "ad_cnt", "ad_cnt_ended") == [(3, 2)]


def test_three_meanings_of_ad(spark):  # T26
    e = events(spark, {"adsn": ""}, {"adsn": None}, {"adsn": "x"})
    assert [e.filter(p).count() for p in (P.is_ad(), P.blank_ad(), P.no_ad())] == [1, 1, 2]


def test_cumulative_reports_keep_their_own_tags(spark):  # T27, T28
    e = events(spark, {"tag": "video_banner_show"}, {"tag": "video_banner_click"})
    assert rows(plays.content_play_total(e, None, DAY, DAY), "tag") == [("video_banner_click",)]
    assert len(rows(plays.content_play_day(e, [], None, DAY, DAY), "tag")) == 2


def test_order_cost_covers_lines_of_all_days(spark):  # T29
    lines = spark.createDataFrame([("o1", 5), ("o1", 7), ("o2", None)], "order_sn string, cost_price bigint")
    assert rows(retail.order_cost(lines, lines)) == [("o1", 12), ("o2", None)]


def test_comment_tags_are_not_trimmed_one_by_one(spark):  # T30, F11
    ts = dt.datetime(2024, 3, 1)
    c = spark.createDataFrame([("o1", 5, " 1,2 ", None, ts, ts), ("o2", 4, "1, 2", "m", ts, ts), ("o3", 3, "  ", "m", ts, ts),
                               ("o4", 2, None, "m", ts, ts)], schemas.ORDER_COMMENT)
    tags = spark.createDataFrame([(1, "one"), (2, "two")], schemas.COMMENT_TAG)
    assert rows(retail.order_comments(c, tags, DAY, DAY), "order_sn", "tag", "comment") == [
        ("o1", "one", ""), ("o1", "two", ""), ("o2", "null", "m"), ("o2", "one", "m"), ("o3", "null", "m"), ("o4", "null", "m")]


def test_null_keys_become_zero_where_reported(spark):  # T31
    e = events(spark, {"contentid": None}, {"contentid": ""})
    got = rows(plays.content_play_day(e, [], None, DAY, DAY), "contentid", "play_cnt")
    assert got == [("0", 1), ("0", 1)]
    assert rows(plays.ad_plan_day(events(spark, {"adsn": None}, {"adsn": ""}), None, DAY, DAY), "adsn") == [("0",), ("0",)]


def test_heartbeat_rows_and_heartbeat_devices_differ(spark, city):  # T32
    beats = spark.createDataFrame([("d1", DAY), ("d1", DAY)], schemas.HEARTBEAT)
    assert rows(interaction.online_heartbeats(beats, city, DAY, DAY), "online_dev_cnt") == [(2,)]
    assert rows(trip_day.heartbeat_devices(beats, city, ("city_sn",), DAY, DAY), "daily_heartbeat_dev_num") == [(1,)]


def test_align_wants_each_measure_once(spark):  # T33
    a = spark.createDataFrame([(1, 2)], "k int, m int")
    with pytest.raises(ValueError):
        frames.align([a, a], ["k"])
    assert rows(frames.align([a, spark.createDataFrame([(None, 3), (1, 4)], "k int, n int")], ["k"])) == [(1, 2, 4), (None, 0, 3)]


def test_log_lines(spark):  # T35, F10
    lines = spark.createDataFrame([
        ("2024-03-01 08:00:00,1 [INFO ]a submitRequest|home|139|u1|s1|7 ",),
        ("2024-03-01 08:00:00,1 submitRequest|home|null|null|null|null",),
        ("2024-03-01 08:00:00,1 submitRequest|home|139|u1|s1",),
        ("2024-03-01 08:00:00,1 submitRequest|home|139|u1|s1|x",),
        ("2024-03-01 08:00:00,1 other|home|139|u1|s1|7",)], "value string")
    parsed = logs.parse_scan_lines(lines)
    t = dt.datetime(2024, 3, 1, 8)
    assert rows(logs.scan_log(parsed)) == sorted(
        [("home", "139", "u1", "s1", 7, t), ("home", None, None, None, None, t)], key=repr)
    assert logs.scan_log_rejects(parsed).count() == 2


def test_composite_key_collides_as_text(spark):  # T36, A8
    e = events(spark, {"traceid": "1", "contentid": "23"}, {"traceid": "12", "contentid": "3"}).withColumns(
        {"tag": F.lit("SCREEN_OTHER_CONTENT_BEGIN"), "adsn": F.lit("")})
    assert rows(interaction.interaction_counts(e, None, DAY, DAY), "daily_play_trip_content_cnt") == [(1,)]
    exact = F.concat(F.length("traceid").cast("string"), F.lit(":"), "traceid", "contentid")
    assert rows(interaction.interaction_counts(e, None, DAY, DAY, exact), "daily_play_trip_content_cnt") == [(2,)]


def test_interacting_pairs_are_reported_for_days_with_plays_only(spark):
    e = events(spark, {"tag": "other", "adsn": None})
    got = interaction.interaction_counts(e, None, DAY, DAY).collect()[0]
    assert (got.inter_trip_cnt, got.inter_trip_content_cnt) == (1, 0)


def test_excluded_and_unnamed_devices(spark):  # P6
    e = events(spark, {}, {"devicename": "d2"}, {"devicename": None})
    gone = spark.createDataFrame([("d2",), (None,)], schemas.EXCLUDED_DEVICE)
    assert rows(P.known_devices(e, gone), "devicename") == [("d1",)]
    assert rows(P.known_devices(e, None), "devicename") == [("d1",), ("d2",)]


def test_flags_treat_null_like_sql(spark):  # P8
    df = spark.createDataFrame([("k", None, "p"), ("k", "a", None), ("k", "b", "p"), ("k", "c'\\x", "p")], "k string, tag string, page string")
    metrics = {"notin": Where(notin={"tag": ("a",)}), "isin": Where(isin={"tag": ("a", "b")}),
               "both": Where(isin={"page": ("p",)}, notin={"tag": ("b",)}), "quoted": Where(isin={"tag": ("c'\\x",)}),
               "any": Where()}
    assert rows(row_counts(df, ["k"], metrics)) == [("k", 2, 2, 1, 1, 4)]
    got = distinct_counts(df.withColumn("e", F.col("page")), ["k"], {"e": (F.col("e"), metrics)})
    assert rows(got) == [("k", 1, 1, 1, 1, 1)]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(10**15 + 1,), (99,)], "c bigint")
    assert str(df.agg(cells.amount(F.sum("c")).alias("m")).collect()[0].m) == "10000000000001.00"
