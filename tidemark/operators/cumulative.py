"""Cumulative-to-date figures without a range join.

The figure for day D covers everything from the start of history to D.  An
entity counts from its first day on, so a cumulative distinct count is a running
sum of "first seen on this day" counts.  History before the reported window is
folded into the window's first day, so the cost per report is one pass over the
history plus groups x window days, not days x history.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cells import Day, day_lit


def first_seen(df: DataFrame, keys: Sequence[str], day: str = "day") -> DataFrame:
    """First day per key: the state a daily run can keep."""
    return df.groupBy(*keys).agg(F.min(day).alias(day))


def merge_first_seen(state: DataFrame, fresh: DataFrame, keys: Sequence[str], day: str = "day") -> DataFrame:
    """Fold newly loaded rows into a kept first-seen table, so that a daily run
    reads the state and the new day and not the whole history."""
    return first_seen(state.select(*keys, day).unionByName(fresh.select(*keys, day)), keys, day)


def running(
    daily: DataFrame, keys: Sequence[str], measures: Sequence[str], start: Day, end: Day, day: str = "day"
) -> DataFrame:
    """Running sums of ``measures`` for each day of [start, end].

    A group has rows from its first day on.  Each change is spread up to the day
    before the next one, so no spine join is needed.
    """
    folded = (
        daily.filter(F.col(day) <= day_lit(end))
        .withColumn(day, F.greatest(F.col(day), day_lit(start)))
        .groupBy(*keys, day)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )
    # Few rows per group: at most one for each day of the window.
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(day)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = folded.select(
        *keys, day,
        F.coalesce(F.date_sub(F.lead(day).over(w), 1), day_lit(end)).alias("__until"),
        *[F.sum(m).over(upto).alias(m) for m in measures],
    )
    return steps.select(*keys, F.explode(F.sequence(F.col(day), F.col("__until"))).alias(day), *measures)


def increments(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
) -> DataFrame:
    """What each day adds: rows, sums, and entities never seen before.

    See ``folded`` and ``added``.
    """
    return added(folded(df, keys, day, counts, sums, distinct), keys, day, counts, sums, distinct)


def folded(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A row per (keys, day) with its totals, and one per (keys, entity) with its first day.

    One scan also with several distinct entities: a row is split into one
    record for the day's totals and one per entity, and all records share one
    aggregation (totals by day, entities by their first day).
    """
    sums, distinct = dict(sums or {}), dict(distinct or {})
    records = [F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("e"), F.col(day).alias("d"),
                        F.lit(1).alias("n"), *[c.alias(f"s_{m}") for m, c in sums.items()])]
    types = df.select(*[c.alias(m) for m, c in sums.items()]).schema if sums else None
    for i, (_, c) in enumerate(distinct.items(), start=1):
        records.append(F.struct(
            F.lit(i).alias("k"), c.cast("string").alias("e"), F.lit(None).cast("date").alias("d"), F.lit(0).alias("n"),
            *[F.lit(None).cast(types[m].dataType).alias(f"s_{m}") for m in sums]))
    rows = df.select(*keys, F.col(day).alias("__day"), F.explode(F.array(*records)).alias("r"))
    rows = rows.filter((F.col("r.k") == 0) | F.col("r.e").isNotNull())
    return rows.groupBy(*keys, F.col("r.k").alias("__k"), F.col("r.e").alias("__e"), F.col("r.d").alias("__d")).agg(
        F.min("__day").alias("__first"),
        F.sum("r.n").alias("__n"),
        *[F.sum(f"r.s_{m}").alias(f"__s_{m}") for m in sums],
    )


def added(
    rows: DataFrame,
    keys: Sequence[str],
    day: str,
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
) -> DataFrame:
    """What each day adds, from the folded rows."""
    sums, distinct = dict(sums or {}), dict(distinct or {})
    return rows.groupBy(*keys, F.col("__first").alias(day)).agg(
        *[F.sum("__n").alias(c) for c in counts],
        *[F.coalesce(F.sum(f"__s_{m}"), F.lit(0)).alias(m) for m in sums],
        *[F.count_if(F.col("__k") == i).alias(m) for i, m in enumerate(distinct, start=1)],
    )


def cumulative(
    df: DataFrame,
    keys: Sequence[str],
    start: Day,
    end: Day,
    day: str = "p_date",
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Counts, sums and distinct counts from the start of ``df`` to each day."""
    df = df.filter(F.col(day) <= day_lit(end)).withColumn(day, F.greatest(F.col(day), day_lit(start)))
    measures = [*counts, *(sums or {}), *(distinct or {})]
    return running(increments(df, keys, day, counts, sums, distinct), keys, measures, start, end, day)


@dataclass(frozen=True)
class State:
    """What earlier runs have kept: every row they added (entities with their first day), and totals up to their last day."""

    seen: DataFrame
    totals: DataFrame | None


@dataclass(frozen=True)
class Step:
    """One run of a report that continues from a state.

    ``added`` are the rows that the run adds to the state.  ``finish`` takes them as they were written and gives the rows of the
    report and the totals after the run (None for a state without totals), so that the log itself is read once.
    """

    added: DataFrame
    finish: Callable[[DataFrame], tuple[DataFrame | None, DataFrame | None]]


def continued(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    start: Day,
    before: State | None,
    report: Callable[[DataFrame], DataFrame],
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
) -> Step:
    """A step of cumulative counts, sums and distinct counts; ``report`` makes its rows from what each day from ``start`` on
    adds, with everything before as an addition on ``start``.

    ``df`` has the new days if there is a state before, else the whole history.  An entity that the state has seen adds
    nothing again.
    """
    measures = [*counts, *(sums or {}), *(distinct or {})]
    rows = folded(df, keys, day, counts, sums, distinct)
    if before is not None:
        old = before.seen.filter("__k > 0").select(*[F.col(c).alias(f"o_{c}") for c in (*keys, "__k", "__e")])
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(old[f"o_{c}"]) for c in (*keys, "__k", "__e")])
        rows = rows.join(old, same, "left_anti")

    def finish(new: DataFrame) -> tuple[DataFrame, DataFrame]:
        daily = added(new, keys, day, counts, sums, distinct).withColumn(day, F.greatest(F.col(day), day_lit(start)))
        if before is not None:
            daily = daily.unionByName(before.totals.select(*keys, day_lit(start).alias(day), *measures))
        daily = daily.groupBy(*keys, day).agg(*[F.sum(m).alias(m) for m in measures])
        return report(daily), daily.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])

    return Step(rows, finish)


def entities(new: DataFrame, keys: Sequence[str], before: State | None, report: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that keeps the first day of entities: ``new`` has a row for each of its window, those that the state knows add
    nothing.  ``report`` makes its rows from all entities."""
    if before is not None:
        new = new.join(before.seen.select(*keys), list(keys), "left_anti")

    def finish(rows: DataFrame) -> tuple[DataFrame, None]:
        return report(rows if before is None else before.seen.unionByName(rows)), None

    return Step(new, finish)


def whole(step: Step) -> DataFrame:
    """The rows of a report that keeps nothing."""
    return step.finish(step.added)[0]
