"""Helpers the operators share: scratch tables, column names, words, running sums."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One white-space character of every word rule, and a run of them (regular expressions of Java and Python).
SPACE = r"[\x20\x09-\x0D]"
SPACES = SPACE + "+"
SPACE_CHARS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def give_back() -> None:
    """Free memory of this process goes back to the system.  Workers stay after their tasks, and what they hold is missing
    to the executor's next stage."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library on Linux
    if trim:
        trim(0)


def in_tasks(function, **params):
    """The generator ``function(batches, **params)`` for ``mapInArrow``.  Tasks import it by name, so what its module keeps
    (a tokenizer, a cache) serves all tasks of a worker; the package is found there or where the driver has it."""
    call = in_groups(function, **params)
    root = ROOT

    def run(batches):
        import sys

        yield from call(batches)
        if root not in sys.path:
            sys.path.append(root)
        from tidemark.llm.common import give_back

        give_back()

    return run


def in_groups(function, **params):
    """``function(rows, **params)`` for the groups of ``applyInArrow``, imported in the same way."""
    module, name, root = function.__module__, function.__name__, ROOT

    def run(rows):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(rows, **params)

    return run


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder.  A session that names none, as in tests on one machine, gets one and keeps it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read again: later steps neither repeat the work nor
    depend on what an executor holds."""
    path = f"{scratch_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores in front until no column of ``df`` has them (letters compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def col(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(column: str) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array: runs of anything but the six white-space characters."""
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def running_sum(df: DataFrame, groups: list[str], key: str, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of the same groups with a smaller 64-bit ``key`` (or an equal key in an earlier row).

    Two levels: 1,024 ranges of the key are summed first, so that a task sorts only one range of one group, even
    if a group holds a third of all rows.  ``key`` must be spread like a hash.  Groups may be NULL."""
    part, base = fresh(df, "part", "base")
    parts = df.withColumn(part, F.shiftrightunsigned(col(key), 54))
    sums = parts.groupBy(*map(col, groups), col(part)).agg(F.sum(col(value)).alias(base))
    before = Window.partitionBy(*map(col, groups)).orderBy(col(part)).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(base, F.coalesce(F.sum(col(base)).over(before), F.lit(0)))
    sums = sums.select(*[col(g).alias(f"g{i}") for i, g in enumerate(groups)], col(part).alias("gp"), col(base))
    on = parts[part] == sums["gp"]
    for i, g in enumerate(groups):
        on &= parts[g].eqNullSafe(sums[f"g{i}"])
    # orders as an unsigned number: the part first, the signed key inside it
    inside = Window.partitionBy(*map(col, groups), col(part)).orderBy(col(key)).rowsBetween(Window.unboundedPreceding, -1)
    joined = parts.join(sums, on).drop(*[f"g{i}" for i in range(len(groups))], "gp")
    return joined.withColumn(out, col(base) + F.coalesce(F.sum(col(value)).over(inside), F.lit(0))).drop(part, base)
