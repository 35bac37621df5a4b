"""Day windows and the daily run.

The reports have no streaming form: new days arrive as whole partitions, and a
run loads the days after the table's high-water mark up to yesterday.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import fixed_values as V
from tidemark.operators.cumulative import State, Step
from tidemark.sinks.days import append_days, exists, high_water_mark, refresh, replace_days
from tidemark.sinks.layouts import LAYOUTS, to_layout
from tidemark.streaming import kept
from tidemark.streaming.shared import Shared

ONE_DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class DayWindow:
    start: dt.date
    end: dt.date

    @property
    def empty(self) -> bool:
        return self.start > self.end

    def __len__(self) -> int:
        return max(0, (self.end - self.start).days + 1)


def next_window(mark: dt.date, today: dt.date) -> DayWindow:
    """From the day after the mark to yesterday; empty when up to date."""
    return DayWindow(mark + dt.timedelta(days=1), today - dt.timedelta(days=1))


@dataclass(frozen=True)
class Report:
    """A named report: ``build(window)`` gives its rows."""

    name: str
    build: Callable[[DayWindow], DataFrame] | None
    day: str = "day"
    mode: str = "replace"  # replace | append | refresh | state (nothing but what is kept)
    default: dt.date | None = None
    after: tuple[str, ...] = field(default=())
    sort: tuple[str, ...] = field(default=())
    # With a state, ``run(window, state)`` gives the step of the run; what it adds is kept beside the report.
    run: Callable[[DayWindow, State | None], Step] | None = None
    # A report that does not go by days loads itself: ``own(path, today)`` gives the days it has loaded.
    own: Callable[[str, dt.date], DayWindow] | None = None
    # What the report shares with others of its run.
    shared: Shared | None = None


def load(spark: SparkSession, report: Report, path: str, today: dt.date, since: dt.date | None = None) -> DayWindow:
    """Bring one report table up to yesterday and return the window loaded.

    With ``since``, days that were loaded before are loaded again from there on.  A report with a state starts on the day after the
    newest state that is not ahead of its table, so the two never part: the state is committed first, and after a run that stopped
    in between the next one goes back to the state before.  Without any such state it reads the history.
    """
    if report.own is not None:
        return report.own(path, today)
    if report.mode == "refresh":
        window = DayWindow(today, today)
        refresh(report.build(window), path, report.sort)
        return window
    default = report.default or V.DEFAULT_HIGH_WATER_MARK[report.name]
    if report.mode == "state":
        before = kept.kept(spark, path, None if since is None else since - ONE_DAY)
        mark = before.upto if before is not None else default if since is None else since - ONE_DAY
    else:
        mark = high_water_mark(spark, path, default, report.day)
        mark = mark if since is None else min(mark, since - ONE_DAY)
        before = kept.kept(spark, path, mark) if report.run is not None else None
        mark = before.upto if before is not None else mark
    window = next_window(mark, today)
    if window.empty:
        return window
    if report.run is not None:
        rows = kept.commit(spark, path, report.run(window, before.state if before is not None else None), window.end, before)
    else:
        rows = report.build(window)
    if report.mode == "state":
        return window
    if report.name in LAYOUTS:
        rows = to_layout(rows, report.name)
    if report.mode == "append":
        append_days(rows, path, report.day, report.sort)
    else:
        replace_days(rows, path, window.start, window.end, report.day, report.sort)
    return window


def run_all(spark: SparkSession, reports: list[Report], root: str, today: dt.date) -> Mapping[str, DayWindow]:
    """Load the reports in the order given.

    A report that reads another one's table must come later, or the table must
    be there from an earlier run; this is checked.
    """
    done: dict[str, DayWindow] = {}
    shared = {id(r.shared): r.shared for r in reports if r.shared is not None}.values()
    for s in shared:
        s.begin()
    try:
        for r in reports:
            missing = [a for a in r.after if a not in done and not loaded_before(spark, f"{root}/{a}")]
            if missing:
                raise ValueError(f"{r.name} must run after {', '.join(missing)}")
            done[r.name] = load(spark, r, f"{root}/{r.name}", today)
    finally:
        for s in shared:
            s.end()
    return done


def loaded_before(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) or bool(kept.commits(spark, path))
