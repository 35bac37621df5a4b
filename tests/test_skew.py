"""One key with a third of all rows: same results, and the hot partition is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.operators.cumulative import increments
from tidemark.operators.flags import Where, distinct_counts, row_counts
from tidemark.plans import retail

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def big_cluster(spark):
    """Settings that make small data look big."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_driver_is_split(big_cluster):
    spark = big_cluster
    lines = spark.range(120_000, numPartitions=8).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("order_sn"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("driver_id"), F.lit("t").alias("driver_tel"),
        F.when(F.col("id") % 3 == 1, None).otherwise((F.col("id") % 900).cast("string")).alias("user_tel"))
    drivers = spark.range(500).select(F.col("id").alias("driver_id"), F.lit(1).alias("city_sn"), F.lit("SH").alias("leasing_company_sn"), F.lit(1).alias("work_type"))
    users = spark.range(900).select(F.col("id").cast("string").alias("mobile"), F.lit("u").alias("driver_tag"))
    df = retail._enrich(lines, drivers, users)
    assert df.filter("leasing_company_sn = 'SH'").count() == 120_000
    rows = df.agg(F.count(F.lit(1)), F.count("driver_tag"), F.sum(F.crc32(F.col("order_sn").cast("binary"))))
    n, tagged, total = rows.collect()[0]
    assert (n, tagged) == (120_000, 80_000)
    assert total == lines.agg(F.sum(F.crc32(F.col("order_sn").cast("binary")))).collect()[0][0]
    run = df.select("order_sn", "driver_tag", "leasing_company_sn", "driver_tel")
    run.write.format("noop").mode("overwrite").save()
    run.count()
    plan = df.groupBy("driver_tag").agg(F.max("order_sn"), F.max("leasing_company_sn"))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text and "skew=true" in text


def test_hot_trip_and_hot_day(big_cluster):
    spark = big_cluster
    df = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).cast("date").alias("day"),
        F.when(F.col("id") % 3 == 1, "hot").otherwise((F.col("id") % 7000).cast("string")).alias("e"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("tag"))
    got = distinct_counts(df, ["day"], {"e": (F.col("e"), {"a": Where(isin={"tag": ("a",)}), "all": Where()})})
    want = df.groupBy("day").agg(F.count_distinct(F.expr("if(tag = 'a', e, null)")).alias("a"), F.count_distinct("e").alias("all"))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    inc = increments(df, ["tag"], "day", counts=["n"], distinct={"new": F.col("e")})
    assert inc.agg(F.sum("n")).collect()[0][0] == 60_000
    assert inc.groupBy("tag").agg(F.sum("new")).orderBy("tag").collect() == df.groupBy("tag").agg(F.count_distinct("e")).orderBy("tag").collect()


def test_exclusions_are_one_anti_join_whatever_their_number(spark):
    table = spark.range(50).select(F.concat(F.lit("d"), "id").alias("devicename"))
    events = spark.range(100).select(F.concat(F.lit("d"), "id").alias("devicename"))
    for excluded, left in ((P.exclusions(table.union(table)), 50), (P.exclusions(table.limit(0)), 100), (["d1", "d2"], 98), (None, 100)):
        assert P.known_devices(events, excluded).count() == left


def test_more_metrics_than_a_mask_has_bits(spark):
    df = spark.range(500).selectExpr("'k' AS k", "cast(id % 200 AS string) AS tag", "cast(id AS string) AS e")
    wheres = {f"m{i}": Where(isin={"tag": (str(i),)}) for i in range(150)}
    want = {f"m{i}": 3 if i < 100 else 2 for i in range(150)}
    got = distinct_counts(df, ["k"], {"e": (F.col("e"), wheres), "t": (F.col("tag"), {"all": Where()})}).first().asDict()
    assert got == want | {"k": "k", "all": 200}
    assert row_counts(df, ["k"], wheres).first().asDict() == want | {"k": "k"}
