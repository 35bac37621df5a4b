"""What cumulative reports keep between runs, so that a run reads new days only.

A run adds one commit: the rows it adds (entities never seen before, what each day adds) and, where a report has them, the totals up to
its last day.  Both go to folders of their own that nothing else writes; the row in ``commits`` that names them comes last, as one file.  So a
run that dies leaves folders that nobody reads, and the next run with that number overwrites them.  A commit names the one it builds
on; what the last commit builds on is the line that counts.  A run that goes back to an earlier day builds on the last commit
before that day, and the commits after it are left behind.  Commits are kept, so a run can go back as far as they go.

Every ``WHOLE_EVERY`` commits of a line one writes everything added so far, so that a reader opens a bounded number of folders.
The driver reads one small row for each run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cumulative import State, Step
from tidemark.sinks.days import read_report

COMMIT = "number long, upto date, base long, whole boolean, totals boolean"
WHOLE_EVERY = 64


@dataclass(frozen=True)
class Commit:
    """``base`` is the number of the commit before; ``whole`` tells that everything added so far is in one folder."""

    number: int
    upto: dt.date
    base: int | None
    whole: bool
    totals: bool


@dataclass(frozen=True)
class Kept:
    """The state up to a day and the commits it is read from, the last one first."""

    state: State
    upto: dt.date
    commits: tuple[Commit, ...]


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All commits, by number."""
    table = read_report(spark, f"{path}_state/commits")
    rows = [] if table is None else table.select("number", "upto", "base", "whole", "totals").collect()  # one row for each run
    return sorted((Commit(*r) for r in rows), key=lambda c: c.number)


def line(found: list[Commit]) -> list[Commit]:
    """The last commit and what it builds on, newest first."""
    by_number = {c.number: c for c in found}
    out, now = [], max(by_number, default=None)
    while now is not None:
        out.append(by_number[now])
        now = by_number[now].base
    return out


def kept(spark: SparkSession, path: str, limit: dt.date | None = None) -> Kept | None:
    """The newest state that covers no day after ``limit``, or None."""
    left = [c for c in line(commits(spark, path)) if limit is None or c.upto <= limit]
    if not left:
        return None
    read = left[:next((i + 1 for i, c in enumerate(left) if c.whole), len(left))]
    seen = spark.read.parquet(*[f"{path}_state/{'whole' if c.whole else 'added'}/{c.number}" for c in read])
    totals = spark.read.parquet(f"{path}_state/totals/{left[0].number}") if left[0].totals else None
    return Kept(State(seen, totals), left[0].upto, tuple(read))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commit(spark: SparkSession, path: str, step: Step, upto: dt.date, before: Kept | None) -> DataFrame | None:
    """Keep what a run adds and return the rows of its report, which come from the tables just written."""
    found = commits(spark, path)
    number = found[-1].number + 1 if found else 1
    added = _written(step.added, f"{path}_state/added/{number}")
    rows, totals = step.finish(added)
    if totals is not None:
        _written(totals, f"{path}_state/totals/{number}")
    whole = before is not None and len(before.commits) >= WHOLE_EVERY
    if whole:
        _written(before.state.seen.unionByName(added), f"{path}_state/whole/{number}")
    base = before.commits[0].number if before is not None else None
    one = spark.createDataFrame([(number, upto, base, whole, totals is not None)], COMMIT)
    one.coalesce(1).write.mode("append").parquet(f"{path}_state/commits")
    return rows
