"""The daily runs end to end: two runs one after the other equal one report over both windows."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter

from test_plans import plan, scans
from testbed.q_events import agents, city, days, trip_figures
from testbed.q_operators import write_logs
from tidemark.sources.logs import scan_log_rejects
from testbed.q_retail import drivers, parsed, scan_log, scorecard_inputs
from testbed.q_scale import agent_bindings, bindings, inputs
from testbed.registry import plain
from testbed.tables import ARCHIVES, CAMPAIGN_RULES, RULES
from tidemark.operators import dims
from tidemark.plans import clicks, daily, interaction, plays, retail, scale, trip_day
from tidemark.sinks.days import read_report
from tidemark.streaming.incremental import run_all

D = dt.date


def as_rows(df):
    df = plain(df)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def taxi(t):
    return dims.taxi_dim(t.device_service, t.screen_info, t.screen_car, RULES)


def test_screen_run(spark, prepared, tmp_path, monkeypatch):
    t, root = prepared, str(tmp_path)
    reports = daily.screen_reports(spark, daily.read_screen_tables(spark, t.prepared, list(ARCHIVES)), RULES, CAMPAIGN_RULES, root, D(2024, 1, 22))
    assert [r.name for r in reports if r.after] == ["device_scale", "agent_day"]
    run_all(spark, reports, root, D(2024, 1, 24))
    plans = []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **kw: (plans.append(plan(w._df)), real(w, *a, **kw))[1])
    run_all(spark, reports, root, D(2024, 1, 26))
    # what the second run reads of the input tables, each counted in the plans of all it has written
    read = {name: sum(len(scans(p, name)) for p in plans) for name in (
        "screen_event", "heartbeat_day", "device_service", "screen_info", "screen_car", "trip_server", "trip_client", "trip_archive", "sensor_summary")}
    assert read.pop("screen_event") <= 8  # 22 reports
    assert read == {"heartbeat_day": 1, "device_service": 1, "screen_info": 1, "screen_car": 1, "trip_server": 1, "trip_client": 1,
                    "trip_archive": 0, "sensor_summary": 1}
    first, last = "2024-01-23", "2024-01-25"
    want = plays.ad_play_fulltime(t.screen_event, city(t), t.excluded, first, last)
    assert as_rows(spark.read.parquet(f"{root}/ad_play_fulltime").select(*want.columns)) == as_rows(want)
    total = plays.ad_play_total(t.screen_event, city(t), t.excluded, first, last)
    assert as_rows(spark.read.parquet(f"{root}/ad_play_total").select(*total.columns)) == as_rows(total) and total.count() > 0
    want = {
        "content_play_day": plays.content_play_day(t.screen_event, CAMPAIGN_RULES, t.excluded, first, last),
        "ad_play_day": plays.ad_play_day(t.screen_event, city(t), t.excluded, first, last),
        "ad_plan_day": plays.ad_plan_day(t.screen_event, t.excluded, first, last),
        "content_play_total": plays.content_play_total(t.screen_event, t.excluded, first, last),
        "ad_play_fulltime_total": plays.ad_play_fulltime_total(t.screen_event, city(t), t.excluded, first, last),
        "scan_total": plays.scan_total(t.screen_event, CAMPAIGN_RULES, t.excluded, first, last),
        "points_total": trip_day.points_total(t.screen_event, city(t), t.excluded, first, last),
        "on_road_total": trip_day.on_road_total(t.screen_event, city(t), t.excluded, first, last),
        "trip_day": trip_day.trip_day(days(t), t.device_snapshot, t.heartbeat_day, city(t), first, last).filter(f"date between '{first}' and '{last}'"),
        "tab_click": clicks.tab_clicks(t.screen_event, city(t), t.excluded, first, last),
        "video_click": clicks.video_clicks(t.screen_event, t.excluded, first, last),
        "scan_extract": clicks.scan_extract(t.screen_event, t.excluded, first, last),
        "interaction_day": interaction.interaction_day(t.screen_event, t.excluded, first, last),
        "taxi_interaction_day": interaction.taxi_interaction_day(t.screen_event, t.heartbeat_day, taxi(t), RULES, t.excluded, first, last),
    }
    for name, df in want.items():
        table = spark.read.parquet(f"{root}/{name}")
        assert as_rows(table.select(*[c for c in df.columns if c in table.columns])) == as_rows(df.select(*[c for c in df.columns if c in table.columns])), name
    for r in reports:
        if r.mode != "state":
            assert read_report(spark, f"{root}/{r.name}").count() > 0, r.name
    calendar = spark.read.parquet(f"{root}/calendar")
    t2 = scale.ScaleInputs(*[getattr(inputs(t), f) for f in ("heartbeat", "server", "client", "archive", "summary", "abnormal")], calendar)
    window = trip_figures(t).filter(f"date between '{first}' and '{last}'")
    want = scale.device_scale(t2, bindings(t), window, first, last)
    assert as_rows(spark.read.parquet(f"{root}/device_scale")) == as_rows(want) and calendar.count() == 3
    of_agents = scale.agent_day(t2, days(t).filter(f"p_date between '{first}' and '{last}'"), agent_bindings(t), agents(t), first, last)
    table = spark.read.parquet(f"{root}/agent_day")
    assert as_rows(table.select(*of_agents.columns)) == as_rows(of_agents)


@pytest.fixture
def retail_tables(prepared, tmp_path):
    t, root = prepared, str(tmp_path / "logs")
    write_logs(t, root, "true")
    return daily.read_retail_tables(t.spark, t.prepared, root)


def test_declared_schemas_are_those_of_the_tables(spark, prepared):
    """Names and types; a table may have no column that is not declared."""
    screen = daily.read_screen_tables(spark, prepared.prepared, list(ARCHIVES))
    retail_ = daily.read_retail_tables(spark, prepared.prepared, "")
    names = {"events": "screen_event", "service": "device_service", "info": "screen_info", "car": "screen_car", "snapshot": "device_snapshot",
             "heartbeat": "heartbeat_day", "server_trips": "trip_server", "client_trips": "trip_client", "summary": "sensor_summary", "abnormal": "abnormal_device",
             "orders": "shop_order", "lines": "order_line", "comments": "order_comment", "comment_tags": "comment_tag"}
    for tables in (screen, retail_):
        for f in dataclasses.fields(tables):
            df, name = getattr(tables, f.name), names.get(f.name, f.name)
            if name in ("archived_trips", "excluded", "log_root"):
                continue
            actual = {c.name.lower(): c.dataType.simpleString() for c in spark.read.parquet(f"{prepared.prepared}/{name}").schema}
            assert actual == {c.name: c.dataType.simpleString() for c in df.schema}, name


def test_retail_run(spark, prepared, retail_tables, tmp_path):
    root, t = str(tmp_path / "tables"), prepared
    # lines of the day of their order, so that the orders of the window have costs
    lines = t.order_line.drop("add_time").join(t.shop_order.select("order_sn", "add_time"), "order_sn").select(*t.order_line.columns)
    reports = daily.retail_reports(spark, dataclasses.replace(retail_tables, lines=lines), root, D(1999, 5, 11))
    for today in (D(1999, 5, 14), D(1999, 5, 16)):
        run_all(spark, reports, root, today)

    def wanted(first: str, last: str):
        """The cost of an order is that of the lines loaded by then."""
        loaded = retail.order_lines(lines, drivers(t), t.user_tag, t.sku, t.sku_goods, "1999-05-12", last)
        facts = retail.order_facts(t.shop_order, drivers(t), t.user_tag, loaded, first, last)
        return retail.scorecard(dataclasses.replace(scorecard_inputs(t), order_facts=facts), first, last)

    want = wanted("1999-05-12", "1999-05-13").union(wanted("1999-05-14", "1999-05-15"))
    got = spark.read.parquet(f"{root}/scorecard").select(*want.columns)
    assert as_rows(got) == as_rows(want) and got.filter("cost > 0").count() > 0
    logs = scan_log(prepared).filter("add_time between '1999-05-12' and '1999-05-16'")
    assert as_rows(spark.read.parquet(f"{root}/scan_log").select(*logs.columns)) == as_rows(logs)
    bad = scan_log_rejects(parsed(prepared))
    day = "coalesce(try_cast(substr(line, 1, 10) as date), date '1999-05-14')"
    assert as_rows(spark.read.parquet(f"{root}/scan_log_rejects").select("line")) == as_rows(bad.filter(f"{day} between '1999-05-12' and '1999-05-15'"))
