"""Plans: one scan, pruned columns and days, no nested loops, no Python."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from testbed import all_queries
from testbed.q_events import city
from testbed.q_scale import inputs
from testbed.tables import CAMPAIGN_RULES, END, START
from tidemark.functions import attribution
from tidemark.functions import predicates as P
from tidemark.plans import plays, scale, trip_day
from tidemark.streaming import kept


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str, table: str) -> list[str]:
    return [line for line in text.splitlines() if "FileScan" in line and f"/{table}" in line]


WRITES = ("s7_", "d4_rejects_of", "k1_", "k2_", "k3_", "s8_", "i1_", "i3_", "i4_", "o1_", "o2_")


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if not n.startswith(WRITES)))
def test_no_nested_loops_and_no_python(prepared, name):
    text = plan(all_queries()[name].build(prepared))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["r9_interaction_day", "r11_content_interaction", "r5a_trip_summary", "r2_ad_play_day", "r1_content_play_day",
                                  "r2a_ad_play_total", "r1b_content_play_total", "r4_ad_plan_day", "r5g_fulltime_streams"])
def test_one_pass_over_the_event_log(prepared, name):
    assert len(scans(plan(all_queries()[name].build(prepared)), "screen_event")) == 1


def test_scorecard_scans_each_fact_once_per_use(prepared):
    text = plan(all_queries()["d5_scorecard"].build(prepared))
    assert len(scans(text, "order_line")) == 1  # the 17 order measures share one aggregate
    assert len(scans(text, "shop_order")) == 3  # order facts, their numbers for the cost, and raw orders for the trailing week


def test_days_and_columns_are_pruned(prepared):
    df = P.prod_events(prepared.screen_event, None, "2024-01-10", "2024-01-11").groupBy("tag").count()
    (scan,) = scans(plan(df), "screen_event")
    assert "PartitionFilters: [isnotnull(p_date" in scan and "2024-01-10" in scan
    assert "IsNotNull(env), EqualTo(env,prod)" in scan.replace("PushedFilters: [", "")
    schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["devicename", "env", "tag"]


def test_timestamp_day_filter_reaches_the_scan(prepared):
    from tidemark.plans.retail import on_days

    df = prepared.shop_order.filter(on_days("add_time", "1997-01-01", "1997-01-02")).select("id")
    (scan,) = scans(plan(df), "shop_order")
    assert "GreaterThanOrEqual(add_time" in scan and "LessThan(add_time" in scan


def test_facts_are_aggregated_before_the_dimension_join(prepared):
    text = plan(all_queries()["r2_ad_play_day"].build(prepared))
    join = text.index("Join")
    assert "Aggregate" in text[join:], "events are aggregated below the join"
    assert START < END


def test_a_run_with_a_state_reads_new_days_only(prepared, tmp_path):
    t, path = prepared, str(tmp_path / "state")
    runs = {
        "content": lambda a, b, s: plays.content_play_run(t.screen_event, t.excluded, a, b, s, history="2023-01-01"),
        "scans": lambda a, b, s: plays.scan_run(t.screen_event, CAMPAIGN_RULES, t.excluded, a, b, s, history="2023-01-01"),
        "points": lambda a, b, s: trip_day.points_run(t.screen_event, city(t), t.excluded, a, b, s, history="2023-01-01"),
        "road": lambda a, b, s: trip_day.on_road_run(t.screen_event, city(t), t.excluded, a, b, s, history="2023-01-01"),
    }
    for name, run in runs.items():
        rows = kept.commit(t.spark, f"{path}/{name}", run("2024-01-10", "2024-01-15", None), dt.date(2024, 1, 15), None)
        assert not scans(plan(rows), "screen_event")  # the rows come from what was kept, the log is read once
        text = plan(run("2024-01-16", "2024-01-20", kept.kept(t.spark, f"{path}/{name}").state).added)
        found = scans(text, "screen_event")
        assert found and all("2024-01-16" in line for line in found) and "2023-01-01" not in text, name


def test_device_firsts_with_a_state_read_no_archive(prepared, tmp_path):
    t, path = prepared, str(tmp_path / "firsts")
    first = plan(scale.firsts_run(inputs(t), "2024-01-10", "2024-01-15", None).added)
    assert scans(first, "trip_archive_1") and scans(first, "heartbeat_day")
    kept.commit(t.spark, path, scale.firsts_run(inputs(t), "2024-01-10", "2024-01-15", None), dt.date(2024, 1, 15), None)
    text = plan(scale.firsts_run(inputs(t), "2024-01-16", "2024-01-20", kept.kept(t.spark, path).state).added)
    assert not scans(text, "trip_archive") and all("2024-01-16" in line for line in scans(text, "heartbeat_day"))


def test_rules_are_joined(prepared):
    """However many rules: no rule passes the driver, none is tried on every row."""
    for name in ("f4_attribution_contained_pieces", "f4_attribution_many_rules", "r1_content_play_day"):
        text = plan(all_queries()[name].build(prepared))
        assert "collect_list" not in text and "Subquery" not in text, name


def test_pieces_of_rules_are_folded_where_the_rule_is(spark):
    """However large the rules: what is exchanged and sorted is a rule, never a rule for each of its pieces."""
    table = spark.range(1000).select(F.struct(F.col("id").alias("priority"), F.lit("t").alias("target")).alias("__rule"),
                                     F.when(F.col("id") % 3 == 0, "s").alias("__r0"), F.when(F.col("id") % 2 == 0, "c").alias("__r1"),
                                     F.concat(F.lit("http://b/"), "id").alias("__r2"), F.when(F.col("id") >= 0, "contains").alias("__kind"))
    index = attribution._rule_index(table)
    text = plan(index)
    exchanged = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanged) == 2 and "SortMergeJoin" not in text  # the conditions, and the counts of the buckets
    assert [line for line in text.splitlines() if "HashAggregate" in line and "min(((n" in line]
    # a row asks for pieces of its content: every rule lies under one of those of its own text
    asked = F.transform(attribution._grams(F.col("__r2")), lambda g: F.xxhash64(F.lit(attribution.PIECE), g))
    assert index.filter(F.array_contains(asked, F.col("__file"))).count() == index.count() == 1000
    assert index.groupBy("__file").count().agg(F.max("count")).first()[0] < 100  # and not under one that all rules have
