from __future__ import annotations

import random

import pytest

from tidemark.llm import topk


def brute(rows, queries, k):
    bits = max((len(v) for _, v in rows if v), default=1)
    codes = {(i, tuple(x is not None and x > 0 for x in v) + (False,) * (bits - len(v))) for i, v in rows if i is not None and v}
    out = {}
    for q, c in codes:
        if q in queries:
            near = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in codes if i != q)
            out[q] = [(d, i) for d, i in near[:k]]
    return out


def search(spark, rows, queries, k):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, code string, rank string").repartition(3)
    got = {}
    for r in topk.search(df, df.filter(df.vec_id.isin(*queries)), k=k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.neighbor_id))
    return got


def vectors(seed, n, bits):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(bits)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centres)]) for i in range(n)]
    return rows + [(n + i, list(centres[0])) for i in range(60)]  # many equal codes


@pytest.mark.parametrize("bits, k", [(64, 10), (33, 3), (7, 5)])
def test_equals_brute_force(spark, bits, k):
    rows = vectors(bits, 400, bits)
    queries = set(range(0, 460, 25))
    assert search(spark, rows, queries, k) == brute(rows, queries, k)


def test_queries_left_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "MOST_PROBES", 0.1)
    monkeypatch.setattr(topk, "BLOCK_CODES", 40)
    rows = vectors(5, 150, 40)
    assert search(spark, rows, {0, 50, 100, 160}, 10) == brute(rows, {0, 50, 100, 160}, 10)


def test_probes_are_all_values_of_a_radius(spark):
    lengths = [5, 4]
    asked = spark.createDataFrame([([19, 6], None)], "query array<long>, far int")
    for radius in range(6):
        got = sorted((r.segment, r.value) for r in topk.within(asked, lengths, radius).collect())
        assert got == sorted((s, v) for s, (n, q) in enumerate(zip(lengths, (19, 6))) for v in range(2**n) if bin(v ^ q).count("1") == radius)


def test_spread_codes_are_settled_by_the_index(spark, monkeypatch):
    """Random codes need a large radius; no query is left for the blocks."""
    monkeypatch.setattr(topk, "in_blocks", lambda *a: (_ for _ in ()).throw(AssertionError("blocks")))
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(40)]) for i in range(1500)]
    assert search(spark, rows, {0, 500, 1000}, 5) == brute(rows, {0, 500, 1000}, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, -1.0, None, 2.0]), (1, [1.0]), (2, None), (3, []), (None, [1.0, 1.0]), (4, [float("nan"), -1.0, 0.0, 1.0]), (4, [1.0, -1.0, 0.0, 1.0])]
    got = search(spark, rows, {0, 1, 2, 3}, 10)
    assert got == {0: [(0, 4), (1, 1)], 1: [(1, 0), (1, 4)]}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, df).collect() == []
