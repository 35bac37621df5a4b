"""Time the headline queries; prints one JSON line.

The input tables are derived from the given data and written first, partitioned
by day as in a deployment; that is not timed.  ``queries`` are this library's
reports.  ``as_published`` times the shape that three
reports originally had on the same engine and data, with the same figures: one query per metric (28),
a range join for cumulative figures by city and car, and one aggregation per order measure of the scorecard (17).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from functools import reduce  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from testbed import all_queries  # noqa: E402
from testbed.q_events import PAIR, TRIP, TRIP_METRICS, V179, city  # noqa: E402
from testbed.q_retail import order_facts  # noqa: E402
from testbed.tables import END, LATE_START, START, Tables, prepare  # noqa: E402
from tidemark.functions import fixed_values as V  # noqa: E402
from tidemark.functions import predicates as P  # noqa: E402
from tidemark.operators.frames import day_spine  # noqa: E402
from testbed.registry import scratch_dir  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "r1_content_play_day", "r2_ad_play_day", "r2a_ad_play_total", "r4_ad_plan_day", "r5_trip_day",
    "r9_interaction_day", "r10_taxi_interaction_day", "r11_content_interaction", "r13_device_scale", "r14_agent_day",
    "d1_order_lines", "d2_order_facts", "d3_order_comments", "d4_scan_log", "d5_m2_m18_order_measures", "d5_scorecard",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build) -> float:
    t0 = time.perf_counter()
    run(build())
    return round(time.perf_counter() - t0, 3)


def one_query_per_metric(t: Tables):
    """The interaction report as 28 queries joined on the day."""
    rows = P.prod_events(t.screen_event, t.excluded, START, END)
    parts = [rows.filter(w).groupBy("p_date").agg(F.count_distinct("traceid").alias(m)) for m, w in TRIP_METRICS.items()]
    parts.append(rows.filter(f"{PAIR} AND tag = 'SCREEN_OTHER_CONTENT_BEGIN'").groupBy("p_date").agg(
        F.count_distinct(F.concat("traceid", "contentid")).alias("daily_play_trip_content_cnt")))
    content = f"{PAIR} AND event IN ('CLICK', 'SLIDE') AND NOT coalesce(tag IN ({', '.join(repr(x) for x in V.NOT_CONTENT_TOUCH)}), false)"
    parts.append(rows.filter(content).groupBy("p_date").agg(F.count_distinct(F.concat("traceid", "contentid")).alias("inter_trip_content_cnt")))
    return reduce(lambda a, b: a.join(b, "p_date", "full"), parts)


def range_join(t: Tables):
    """Devices on the road up to each day, city and car as calendar >= event day."""
    rows = P.prod_events(t.screen_event, t.excluded, "2023-01-01", END).filter(f"{TRIP} AND {V179}")
    spine = day_spine(t.spark, LATE_START, END)
    placed = rows.join(city(t), rows.devicename == F.col("third_code"))
    return spine.join(placed, spine.day >= placed.p_date).groupBy("day", "city_sn", "car_type").agg(F.count_distinct("devicename").alias("n"))


def one_query_per_measure(t: Tables):
    """The 17 order measures of the scorecard as one aggregation each, joined on day and company."""
    facts = order_facts(t).filter("status = 1").withColumn("day", F.to_date("add_time"))
    parts = []
    for prefix, where in (("", "true"), ("gmv_", "price > 0"), ("free_", "price = 0")):
        for name, agg in (("driver", F.count_distinct("driver_id")), ("user", F.count_distinct("user_id")), ("cnt", F.count(F.lit(1))),
                          ("cost", F.sum("cost")), ("sku", F.sum("num"))):
            parts.append(facts.filter(where).groupBy("day", "company_sn").agg(agg.alias(prefix + name)))
    parts += [facts.groupBy("day", "company_sn").agg(F.sum(c).alias(c)) for c in ("price", "pay_amount")]
    return reduce(lambda a, b: a.join(b, ["day", "company_sn"], "full"), parts)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()
    t0 = time.perf_counter()
    tables = prepare(spark, sf_dir, f"{scratch_dir(spark)}/tables")
    run(registry["r8_scan_extract"].build(tables))  # start-up is not part of any query
    prepared = round(time.perf_counter() - t0, 3)
    queries = {name: timed(lambda: registry[name].build(tables)) for name in HEADLINE}
    published = {
        "r9_one_query_per_metric": timed(lambda: one_query_per_metric(tables)),
        "r5d_range_join": timed(lambda: range_join(tables)),
        "r5d_here": timed(lambda: registry["r5d_on_road_total"].build(tables)),
        "d5_one_query_per_measure": timed(lambda: one_query_per_measure(tables)),
        "d5_measures_here": queries["d5_m2_m18_order_measures"],
    }
    print(json.dumps({
        "metric": "headline_reports_total", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
        "as_published": published, "prepare": prepared, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
