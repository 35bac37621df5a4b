"""Table readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cells import blank_to_zero, lenient_double


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """Parquet with the given schema, so that no file is opened to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_jdbc(spark: SparkSession, url: str, table: str, split_column: str, lower: object, upper: object,
              partitions: int, **options: str) -> DataFrame:
    """A database table in parallel: each task reads one range of ``split_column``.
    Filters and the column selection are sent to the database."""
    return (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", table)
        .option("partitionColumn", split_column).option("lowerBound", str(lower)).option("upperBound", str(upper))
        .option("numPartitions", partitions).load()
    )


def clean_cells(df: DataFrame, measures: Sequence[str] = ()) -> DataFrame:
    """Query results as the reports read them: empty text is '0', listed measure
    columns are doubles (text that is no number is NULL), the rest stays text."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    cols = {c: blank_to_zero(F.col(c)) for c in text if c not in measures}
    cols |= {m: lenient_double(F.col(m)) if m in text else F.col(m).cast("double") for m in measures}
    return df.withColumns(cols) if cols else df
