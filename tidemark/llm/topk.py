"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: whether the value is above zero.  A code of b bits is cut into m segments of about
log2(rows) bits.  If two codes differ in at most m (r + 1) - 1 bits, some segment differs in at most r; so after all
segments have been searched to radius r, every code within that distance has been seen.  Queries search radius 0 first;
those whose kth verified distance is not yet covered go on with radius 1, and so on.  A round probes only the new radius,
and takes a code only in the first of its segments that differs least, so no code is verified twice.

The index holds each distinct code once with its smallest ids, so a code that a third of all rows share is one entry, and
queries with equal codes are searched once.  Spark limits the candidates of a query before it exchanges them (a ranking with
a limit), and the best of each query are written to the shared folder after each round.

Results are exact for the codes: nearest by distance, then by id.  A vector is a neighbour of others, not of itself.
Defined results: NULL and empty vectors and rows without id have no code, are no neighbours and have no result; a NULL value
counts as not above zero, NaN as above; shorter vectors count as having zeros behind; repeated rows count once, an id with
several codes once for each; with fewer than k others, all are returned; an empty table gives an empty table; extra columns are ignored."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, stored

#: A radius that would ask for more values than this times the number of codes is not probed: to compare the queries that are left
#: with all codes, in blocks, takes less then.
MOST_PROBES = 1.0
BLOCK_CODES = 5_000


def segments(bits: int, rows: int) -> list[int]:
    """Lengths of the segments: about log2(rows) bits each, so that a bucket of spread codes holds a few."""
    length = min(max(8, math.ceil(math.log2(max(2, rows)))), 24, max(1, bits))
    m = max(1, round(bits / length))
    return [bits // m + (i < bits % m) for i in range(m)]


def code(vector: Column, lengths: list[int]) -> Column:
    """The segments of a vector's code, as an array of longs."""
    out, at = [], 0
    for n in lengths:
        bits = F.transform(F.sequence(F.lit(at), F.lit(at + n - 1)), lambda i: F.coalesce((F.get(vector, i) > 0).cast("long"), F.lit(0).cast("long")))
        out.append(F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x)))
        at += n
    return F.array(*out)


def differences(a: str, b: str, m: int) -> Column:
    """How many bits differ, segment by segment."""
    return F.array(*[F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(m)])


def distance(a: str, b: str, m: int) -> Column:
    return reduce(add, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(m)])


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best (query, distance, id) of each query."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``neighbor_id`` and ``distance`` of the k nearest of ``vectors`` to each row of ``queries``."""
    valid = col(id_col).isNotNull() & (F.size(col(vector_col)) > 0)
    rows, bits = vectors.filter(valid).agg(F.count(F.lit(1)), F.max(F.size(col(vector_col)))).first()
    lengths = segments(bits or 1, rows)
    m, want = len(lengths), k + 1  # a query's own row is among the nearest
    coded = vectors.filter(valid).select(col(id_col).alias("id"), code(col(vector_col), lengths).alias("code")).distinct()
    ranked = coded.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy("id"))).filter(F.col("rank") <= want)
    index = stored(ranked.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = stored(queries.filter(valid).select(col(id_col).alias("query_id"), code(col(vector_col), lengths).alias("query")).distinct(), "queries")
    # queries that are left, with the distance that a better neighbour must not exceed
    open_ = asked.select("query", F.lit(None).cast("int").alias("far")).distinct()
    places = index.select("code", "ids", F.posexplode("code").alias("segment", "value"))
    found, radius, codes = None, 0, index.count()
    while True:
        if sum(math.comb(n, radius) for n in lengths) > MOST_PROBES * codes:
            found = merged(found, in_blocks(open_, index, m, want), want)
            break
        probes = within(open_, lengths, radius)
        hits = probes.repartition("segment", "value").join(places.hint("shuffle_hash"), ["segment", "value"]).withColumn("parts", differences("query", "code", m))
        # only where no segment differs less, and in the first that differs so little
        hits = hits.filter((F.array_min("parts") == radius) & (F.array_position("parts", F.lit(radius)) == F.col("segment") + 1))
        hits = hits.select("query", "far", distance("query", "code", m).alias("distance"), F.explode("ids").alias("id"))
        found = merged(found, best(nearer(hits), want), want)
        sure = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        full = F.col("n") >= want
        left = asked.select("query").distinct().join(sure, "query", "left").filter(F.coalesce(~full | (F.col("far") > m * (radius + 1) - 1), F.lit(True)))
        open_ = stored(left.select("query", F.when(full, F.col("far")).alias("far")), "open")
        radius += 1
        if radius > max(lengths) or open_.isEmpty():
            break
    joined = asked.join(found, "query").filter(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id", "query").orderBy("distance", "id")
    return joined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("neighbor_id"), "distance")


def within(queries: DataFrame, lengths: list[int], radius: int) -> DataFrame:
    """(query, far, segment, value): all values that differ in ``radius`` bits from a query's segment, one flipped bit after the other.

    Few queries make many probes, so queries are dealt out first and probes are never broadcast."""
    n = F.get(F.array(*map(F.lit, lengths)), F.col("segment"))
    rows = queries.repartition("query").select("query", "far", F.posexplode("query").alias("segment", "value"))
    rows = rows.filter(n >= radius).withColumn("at", F.lit(-1))
    for k in range(radius):  # the next bit is above the last one and leaves room for those that follow
        rows = rows.withColumn("at", F.explode(F.sequence(F.col("at") + 1, n - (radius - k))))
        rows = rows.withColumn("value", F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))))
    return rows.drop("at")


def nearer(hits: DataFrame) -> DataFrame:
    """What is no farther than the worst of the neighbours that a query has; all, if it has too few."""
    return hits.filter(F.col("far").isNull() | (F.col("distance") <= F.col("far"))).drop("far")


def merged(found: DataFrame | None, new: DataFrame, k: int) -> DataFrame:
    return stored(new if found is None else best(found.union(new).distinct(), k), "best")


def in_blocks(queries: DataFrame, index: DataFrame, m: int, k: int) -> DataFrame:
    """The k best of all codes for the queries that are left: queries go to every block of codes, and every block keeps
    its best."""
    blocks = max(1, -(-index.count() // BLOCK_CODES))
    parts = index.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = sent.repartition("block").join(parts.hint("shuffle_hash"), "block")
    hits = nearer(hits.select("query", "far", distance("query", "code", m).alias("distance"), "ids"))
    return best(hits.select("query", "distance", F.explode("ids").alias("id")), k)


#: Brute force in SQL for ``op7_topk``: all pairs of queries and rows.
ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, [x > 0 for x in embedding] AS code FROM embeddings WHERE len(embedding) > 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
  CAST(len([i for i in range(1, 65) if q.code[i] <> v.code[i]]) AS INTEGER) AS distance
  FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= 10"""
