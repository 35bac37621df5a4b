"""Which devices showed up on which day, by kind of evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cells import as_day
from tidemark.operators.flags import bit_is_set

KINDS = ("heartbeat", "server", "client", "archive", "splash")


def union_trips(tables: Sequence[DataFrame]) -> DataFrame:
    """Distinct (device, day) over trip tables of the same shape."""
    rows = reduce(lambda a, b: a.unionByName(b), [t.select("device_name", "add_time") for t in tables])
    return rows.select("device_name", as_day(F.col("add_time")).alias("day")).distinct()


def marks(
    heartbeat: DataFrame | None = None,
    server: DataFrame | None = None,
    client: DataFrame | None = None,
    archive: Sequence[DataFrame] = (),
    splash: DataFrame | None = None,
) -> DataFrame:
    """(device, day, seen) rows of all sources; ``seen`` has the bit of its kind."""
    def marked(df: DataFrame, device: str, day: Column, kind: str) -> DataFrame:
        return df.select(F.col(device).alias("device"), day.alias("day"),
                         F.lit(1 << KINDS.index(kind)).cast("bigint").alias("seen"))

    parts = []
    if heartbeat is not None:
        parts.append(marked(heartbeat, "sn", F.col("day"), "heartbeat"))
    if server is not None:
        parts.append(marked(server, "device_name", as_day(F.col("add_time")), "server"))
    if client is not None:
        parts.append(marked(client, "device_name", as_day(F.col("add_time")), "client"))
    parts += [marked(t, "device_name", as_day(F.col("add_time")), "archive") for t in archive]
    if splash is not None:
        parts.append(marked(splash, "sn", F.col("day"), "splash"))
    return reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("device").isNotNull())


def presence(rows: DataFrame) -> DataFrame:
    """One row per (device, day) with the bits of everything seen that day and the number of heartbeat rows.

    All sources go through one aggregation, so a later "heartbeat and trip that
    day" is a bit test and needs no semi join.
    """
    return rows.groupBy("device", "day").agg(F.bit_or("seen").alias("seen"), F.count_if(seen("heartbeat")).alias("beats"))


def firsts(rows: DataFrame) -> DataFrame:
    """Per device its first trip day and first heartbeat day: one small row per
    device leaves each task, however long the history is."""
    trip = seen("server") | seen("client") | seen("archive")
    return rows.groupBy("device").agg(
        F.min(F.when(trip, F.col("day"))).alias("first_trip"),
        F.min(F.when(seen("heartbeat"), F.col("day"))).alias("first_beat"))


def seen(kind: str) -> Column:
    return bit_is_set("seen", KINDS.index(kind))


def count_devices(shown: DataFrame, dim: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Distinct devices per day and dimension attributes, one column per rule.

    ``shown`` has one row per (device, day).  The dimension is reduced to one row
    per device and attribute value, so a row count is the distinct count.
    """
    attrs = dim.select("third_code", *keys).distinct()
    return (
        shown.join(attrs, F.col("device") == F.col("third_code"), "inner")
        .groupBy("day", *keys)
        .agg(*[F.count_if(p).alias(m) for m, p in metrics.items()])
    )
