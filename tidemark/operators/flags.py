"""Many filtered counts from one scan.

Each metric is a ``Where``.  A row gets a bit per metric, in a bigint for each
block of metrics, built from one lookup per column: the lookup gives the metrics
that the column's value allows, and the lookups are AND-ed.  The cost per row grows with the number of
distinct values named, not with metrics x conditions, and the generated code
stays small enough to be compiled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cells import flag

BLOCK = 62  # bits of a bigint that are used


@dataclass(frozen=True)
class Where:
    """All must hold: columns within value sets, columns outside value sets
    (NULL fails both), and named predicates."""

    isin: Mapping[str, Collection[str]] = field(default_factory=dict)
    notin: Mapping[str, Collection[str]] = field(default_factory=dict)
    also: tuple[str, ...] = ()

    def allows(self, column: str, value: str | None) -> bool:
        """Whether the column's value lets the row through; None is NULL."""
        if column in self.isin and value not in self.isin[column]:
            return False
        if column in self.notin and (value is None or value in self.notin[column]):
            return False
        return True


def _bits(wheres: Sequence[Where], keep) -> int:
    return sum(1 << i for i, w in enumerate(wheres) if keep(w))


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def metric_mask(wheres: Sequence[Where], predicates: Mapping[str, Column]) -> Column:
    """Bit i is set when the i-th metric of a block holds.

    The lookups are written as SQL text: a Column per value would cost one call
    into the JVM each.
    """
    other = object()  # a value no metric names
    lookups = []
    for column in sorted({c for w in wheres for c in (*w.isin, *w.notin)}):
        named = sorted({v for w in wheres for s in (w.isin, w.notin) for v in s.get(column, ())})
        values = defaultdict(list)
        for v in named:
            values[_bits(wheres, lambda w: w.allows(column, v))].append(_text(v))
        cases = "".join(f" WHEN `{column}` IN ({', '.join(vs)}) THEN {bits}L" for bits, vs in values.items())
        null_bits = _bits(wheres, lambda w: w.allows(column, None))
        other_bits = _bits(wheres, lambda w: w.allows(column, other))
        lookups.append(F.expr(f"CASE WHEN `{column}` IS NULL THEN {null_bits}L{cases} ELSE {other_bits}L END"))
    for name, predicate in predicates.items():
        without = _bits(wheres, lambda w: name not in w.also)
        lookups.append(F.when(flag(predicate), F.expr("-1L")).otherwise(F.expr(f"{without}L")))
    return reduce(lambda a, b: a.bitwiseAND(b), lookups, F.lit((1 << len(wheres)) - 1).cast("bigint"))


def metric_masks(wheres: Sequence[Where], predicates: Mapping[str, Column], blocks: int | None = None) -> list[Column]:
    """A mask for each block of metrics, any number of them; ``blocks`` adds empty ones."""
    masks = [metric_mask(wheres[i:i + BLOCK], predicates) for i in range(0, len(wheres), BLOCK)]
    return masks + [F.lit(0).cast("bigint")] * ((blocks or 0) - len(masks))


def bit_is_set(mask: str, i: int) -> Column:
    return F.expr(f"({mask} & {1 << i}L) != 0")


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    entities: Mapping[str, tuple[Column, Mapping[str, Where]]],
    predicates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``COUNT(DISTINCT entity)`` under many filters, in one scan.

    ``entities`` maps a short name to (entity column, {metric: where}).  Masks
    are OR-ed per (keys, entity), which combines on the map side, and the set
    bits are summed per key.  A hot key is spread over its entities by the first
    shuffle, and the second one moves only partial sums.
    """
    names = list(entities)
    blocks = max(-(-len(metrics) // BLOCK) for _, metrics in entities.values())
    masks = [f"__m{b}" for b in range(blocks)]
    records = [
        F.struct(F.lit(n).alias("n"), entities[n][0].cast("string").alias("e"), *[
            m.alias(f"m{b}") for b, m in enumerate(metric_masks(list(entities[n][1].values()), predicates or {}, blocks))])
        for n in names
    ]
    # The masks are computed once, in the exploded record: a filter on a plain
    # column would be pushed down and compute them a second time.
    rows = df.select(*keys, F.explode(F.array(*records)).alias("__p")).selectExpr(
        *[f"`{k}`" for k in keys], "__p.n AS __n", "__p.e AS __e", *[f"__p.m{b} AS __m{b}" for b in range(blocks)])
    some = " OR ".join(f"{m} != 0" for m in masks)
    per_entity = (
        rows.filter(f"({some}) AND __e IS NOT NULL").groupBy(*keys, "__n", "__e").agg(*[F.bit_or(m).alias(m) for m in masks])
    )
    return per_entity.groupBy(*keys).agg(*[
        F.expr(f"count_if(__n = {_text(n)} AND (__m{i // BLOCK} & {1 << i % BLOCK}L) != 0) AS `{metric}`")
        for n in names for i, metric in enumerate(entities[n][1])
    ])


def row_counts(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Where],
               predicates: Mapping[str, Column] | None = None) -> DataFrame:
    """Row counts under many filters: one scan and one shuffle of partial counts.

    Rows are first counted per (keys, masks), which is a small map-side table,
    and the masks are then taken apart.
    """
    masks = [m.alias(f"__m{b}") for b, m in enumerate(metric_masks(list(metrics.values()), predicates or {}))]
    by_mask = df.select(*keys, *masks).groupBy(*keys, *[f"__m{b}" for b in range(len(masks))]).agg(F.count(F.lit(1)).alias("__n"))
    return by_mask.groupBy(*keys).agg(*[
        F.expr(f"coalesce(sum(__n) FILTER (WHERE (__m{i // BLOCK} & {1 << i % BLOCK}L) != 0), 0L) AS `{m}`")
        for i, m in enumerate(metrics)
    ])
