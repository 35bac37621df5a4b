"""Bitmaps of hashed keys: a set of any size as one value of bounded size, without a miss."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col

#: A bitmap has at most 2^27 bits, 16 MB, whatever the size of the set; a fuller one lets more other keys pass.
MOST_LOG, LEAST_LOG, BITS_A_KEY = 27, 16, 16


def bitmap(keys: DataFrame, key: str, count: int) -> bytes:
    """The set of the 64-bit ``key``s of about ``count`` rows for ``wordstream.has``: one bit for each.

    Bits meet in 64-bit numbers by an aggregation with partial results, and only those numbers come to the driver."""
    log = min(MOST_LOG, max(LEAST_LOG, (max(1, count) * BITS_A_KEY - 1).bit_length()))
    at = F.shiftrightunsigned(col(key), 64 - log)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    got = keys.select(F.shiftrightunsigned(at, 6).alias("at"), one.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (log - 6), dtype="<i8")
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return out.tobytes()
