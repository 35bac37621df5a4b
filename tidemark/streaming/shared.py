"""Inputs that several reports of a run need: written once, read by all."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark.sql import DataFrame, SparkSession


class Shared:
    """Named inputs of a run.

    Inside a run the first report that asks for an input writes it to ``folder`` and the others read it.  Each
    run overwrites what the one before left.  A report that is loaded alone builds its inputs and writes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[tuple[str, Hashable], DataFrame] | None = None

    def begin(self) -> None:
        self._made = {}

    def end(self) -> None:
        self._made = None

    def get(self, name: str, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
        """The input ``name`` for ``key`` (a window, or None for what does not depend on days)."""
        if self._made is None:
            return build()
        if (name, key) not in self._made:
            place = f"{self.folder}/{name}/{sum(n == name for n, _ in self._made)}"
            df = build()
            df.write.mode("overwrite").parquet(place)
            self._made[name, key] = self.spark.read.schema(df.schema).parquet(place)
        return self._made[name, key]
