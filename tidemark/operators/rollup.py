"""Roll per-device figures up to the attributes of a device dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_up(
    per_device: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str] = (),
    count: str | None = None,
) -> DataFrame:
    """Sum per-device measures (and count rows) by dimension attributes.

    ``per_device`` has a ``devicename``; ``dim`` has a ``third_code`` and the
    attributes.  Devices missing from the dimension vanish, a device bound twice
    counts twice, a NULL key is dropped and a sum without values is 0.

    The facts arrive pre-aggregated, so the join moves device-day rows and not
    events.  No broadcast is forced: Spark broadcasts the dimension when its
    measured size allows and splits skewed partitions otherwise.
    """
    joined = per_device.join(dim, F.col("devicename") == F.col("third_code"), "inner").dropna(subset=list(keys))
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return joined.groupBy(*keys).agg(*aggs)
