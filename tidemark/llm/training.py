"""Labelled rows to learn from: a bounded number of whole texts that never meet in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, stored, text_of


def labelled(docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(h, label, version, text) of at most ``rows`` labelled texts, chosen by a hash of their ids; written to the shared folder.

    ``learnable`` is a condition on ``labels``.  The chosen labels are at most ``rows`` rows without texts, so they are broadcast.  A text that
    is on several rows of one id is learned from once; where an id has several texts, those with the least hashes are taken."""
    chosen = labels.filter(learnable & col(label_col).isin(0, 1) & col(id_col).isNotNull()).select(
        col(id_col).alias("l_id"), col(label_col).cast("int").alias("label"), F.xxhash64(col(id_col).cast("string")).alias("h"))
    chosen = chosen.distinct().orderBy("h", "l_id", "label").limit(rows)
    found = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
    found = found.select("h", "label", F.xxhash64("text").alias("version"), "text").dropDuplicates(["h", "label", "version"])
    found = stored(found, "labelled")
    keys = F.struct("h", "version", "label")
    if found.count() > rows:
        last = found.select(keys.alias("key")).orderBy("key").limit(rows).agg(F.max("key").alias("last"))
        found = found.join(F.broadcast(last), keys <= F.col("last")).drop("last")
    return found
