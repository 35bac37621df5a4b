"""The one-pass forms against the plain forms they replace."""

from __future__ import annotations

import random
import datetime as dt

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st, HealthCheck

from tidemark.operators.cumulative import cumulative, first_seen, merge_first_seen, running
from tidemark.operators.flags import Where, distinct_counts
from tidemark.operators.frames import day_spine

D0 = dt.date(2024, 1, 1)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def log(spark):
    rnd = random.Random(7)
    rows = [(D0 + dt.timedelta(days=rnd.randrange(20)), rnd.choice(["a", "b", None]), f"d{min(rnd.randrange(30), 9)}",
             rnd.choice([None, 1, 2, 3])) for _ in range(3000)]
    return spark.createDataFrame(rows, "p_date date, g string, d string, n int").persist()


@pytest.mark.parametrize(("start", "end"), [("2024-01-01", "2024-01-20"), ("2024-01-08", "2024-01-25"), ("2024-02-01", "2024-02-03")])
def test_cumulative_equals_range_join(spark, log, start, end):
    got = cumulative(log, ["g"], start, end, counts=["n_rows"], sums={"s": F.col("n")}, distinct={"devs": F.col("d")})
    spine = day_spine(spark, start, end)
    naive = spine.join(log, F.col("day") >= F.col("p_date")).groupBy("g", "day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("s"), F.count_distinct("d").alias("devs"))
    assert as_rows(got.select("g", "p_date", "n_rows", "s", "devs")) == as_rows(naive.select("g", "day", "n_rows", "s", "devs"))


def test_running_needs_no_rows_after_a_change(spark):
    daily = spark.createDataFrame([("x", D0, 1), ("x", D0 + dt.timedelta(days=3), 2), ("y", dt.date(2023, 1, 1), 5)], "k string, day date, n int")
    got = as_rows(running(daily, ["k"], ["n"], "2024-01-01", "2024-01-05").select("k", "day", "n"))
    assert [(k, d.day, n) for k, d, n in got] == [
        ("x", 1, 1), ("x", 2, 1), ("x", 3, 1), ("x", 4, 3), ("x", 5, 3)] + [("y", i, 5) for i in range(1, 6)]


def test_kept_state_equals_whole_history(log):
    cut = F.col("p_date") < F.lit("2024-01-11").cast("date")
    state = first_seen(log.filter(cut), ["g", "d"], "p_date")
    assert as_rows(merge_first_seen(state, log.filter(~cut), ["g", "d"], "p_date")) == as_rows(first_seen(log, ["g", "d"], "p_date"))


VALUES = st.sampled_from([None, "a", "b", "c"])
SETS = st.dictionaries(st.sampled_from(["x", "y"]), st.sets(st.sampled_from(["a", "b", "z"]), min_size=1).map(tuple), max_size=2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(VALUES, VALUES, VALUES), max_size=12),
       wheres=st.lists(st.builds(Where, isin=SETS, notin=SETS, also=st.sampled_from([(), ("p",)])), min_size=1, max_size=4))
def test_masks_equal_filters(spark, rows, wheres):
    df = spark.createDataFrame([(1, *r) for r in rows], "k int, x string, y string, e string")
    metrics = {f"m{i}": w for i, w in enumerate(wheres)}
    got = distinct_counts(df, ["k"], {"e": (F.col("e"), metrics)}, {"p": F.col("x") == "a"}).collect()

    def holds(w, r):
        v = dict(zip("xy", r))
        return (all(v[c] in s for c, s in w.isin.items())
                and all(v[c] is not None and v[c] not in s for c, s in w.notin.items())
                and ("p" not in w.also or v["x"] == "a"))

    want = [len({r[2] for r in rows if r[2] is not None and holds(w, r)}) for w in wheres]
    assert [got[0][m] for m in metrics] == want if got else not any(want)
