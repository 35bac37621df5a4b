"""Spines, zero fill, NULL-aware joins and alignment of metric frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cells import Day, day_lit


def day_spine(spark: SparkSession, start: Day, end: Day, name: str = "day") -> DataFrame:
    """One row per day, both ends included; empty when end is before start."""
    one = spark.range(1).filter(day_lit(start) <= day_lit(end))
    return one.select(F.explode(F.sequence(day_lit(start), day_lit(end))).alias(name))


def zero_fill(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(measures))


def fill_keys(df: DataFrame, **defaults: object) -> DataFrame:
    """NULL keys become the given values."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on same-named keys in which NULL matches NULL."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(r, cond, "left").drop(*[f"__{k}" for k in keys])


def align(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer alignment of frames that each have one row per key; a frame with a key twice is an error.

    The frames are stacked and folded by one aggregation, so N frames cost one
    small shuffle and not a chain of N-1 full outer joins.  Keys are matched by
    value, NULL with NULL; a measure missing for a key is 0.
    """
    measures = [c for f in frames for c in f.columns if c not in keys]
    if len(set(measures)) != len(measures):
        raise ValueError("each measure must come from one frame only")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def only(m: str) -> Column:
        twice = F.raise_error(F.lit(f"a frame has a key with two values of {m}"))
        return F.when(F.count(m) > 1, twice).otherwise(F.coalesce(F.max(m), F.lit(0)))

    return stacked.groupBy(*keys).agg(*[only(m).alias(m) for m in measures])


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN`` with its NULL rules, as an ordinary hash-partitioned anti join.

    With a NULL in the list nothing qualifies; with an empty list everything
    does, also a NULL; otherwise a NULL on the left never qualifies.  Spark's
    own null-aware anti join has to broadcast the list, so it is not used.
    """
    values = listed.select(F.col(listed_column).alias("__v"))
    kept = df.join(values.filter(F.col("__v").isNotNull()).distinct(), F.col(column) == F.col("__v"), "left_anti")
    kept = kept.filter(~values.filter(F.col("__v").isNull()).exists())
    return kept.filter(F.col(column).isNotNull() | ~values.exists())
