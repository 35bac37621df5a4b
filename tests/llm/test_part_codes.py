from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import part_codes


def brute(rows, entries=256, rounds=4):
    """rows of (vec_id, vector, label): [(vec_id, code, error, label, label_error)] and the books"""
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v, _ in kept]
    if not kept:
        return [], []
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = [(i, [max(-2**26, min(2**26, math.floor(1024 * c))) for c in v], x) for i, v, x in kept if len(v) == d]
    kept.sort(key=lambda k: (k[0] is None, k[0] or 0, np.array(k[1], dtype="<i4").tobytes()))
    cuts = [(p * d // 4, (p + 1) * d // 4) for p in range(4)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in cuts]

    def near(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, c)), e) for e, c in enumerate(book))

    for k in range(rounds + 1):
        codes = [[near(v[a:b], book) for (a, b), book in zip(cuts, books)] for _, v, _ in kept]
        if k < rounds:
            for p, (a, b) in enumerate(cuts):
                for e in range(len(books[p])):
                    mine = [v[a:b] for (_, v, _), c in zip(kept, codes) if c[p][1] == e]
                    if mine:
                        books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    sums = {}
    for (_, _, x), c in zip(kept, codes):
        sums[x] = sums.get(x, 0) + sum(s for s, _ in c)
    return sorted(((i, "".join(f"{e:02x}" for _, e in c), sum(s for s, _ in c), x, sums[x]) for (i, _, x), c in zip(kept, codes)), key=repr), books


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "x", "y", "z") for i, v, x in rows],
                                 "vec_id long, embedding array<double>, label int, codes string, error string, v string").repartition(3)


def encoded(spark, rows, **kw):
    coded = part_codes.encode(frame(spark, rows), **kw)
    got = part_codes.with_label_errors(coded.rows).collect()
    return sorted(((r.vec_id, bytes(r.codes).hex(), r.error, r.label, r.label_error) for r in got), key=repr), [b.tolist() for b in coded.books], coded


def clustered(seed, n, d, spread=0.4, size=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, size) for _ in range(d)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, spread * size) for x in rng.choice(centres)], rng.choice([0, 1, 2, None])) for i in range(n)]
    return rows + [(n + i, list(rows[i % 3][1]), 1) for i in range(20)]  # equal vectors


@pytest.mark.parametrize("d, entries, listed, rounds", [(16, 256, 16, 4), (8, 20, 3, 6), (12, 40, 2, 4), (7, 5, 16, 3), (4, 1, 16, 2), (16, 60, 30, 8)])
def test_equals_brute_force(spark, d, entries, listed, rounds):
    rows = clustered(d, 420, d)
    random.Random(1).shuffle(rows)
    want, books = brute(rows, entries, rounds)
    got, mine, coded = encoded(spark, rows, entries=entries, listed=listed, rounds=rounds)
    assert got == want and mine == books
    assert all(a >= b for a, b in zip(coded.listed, coded.listed[1:])) and coded.listed[0] == listed


def test_ties_go_to_the_lower_entry(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(8)], i % 2) for i in range(300)]
    want, books = brute(rows, 30)
    got, mine, _ = encoded(spark, rows, entries=30)
    assert got == want and mine == books


def test_large_components_are_exact(spark):
    """Squares beyond what double precision holds; components beyond the largest count as it."""
    rows = clustered(4, 200, 8, size=20_000.0) + [(900, [1e300, -1e300] * 4, 0), (901, [1e9, -1e9] * 4, 0)]
    want, books = brute(rows, 25)
    got, mine, _ = encoded(spark, rows, entries=25)
    assert got == want and mine == books


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(5, 60, 8) + [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [nan] * 8, 1), (103, [inf] * 8, None), (104, [-inf, 1.0] * 4, 2), (105, [], 1),
                                  (106, [1.0] * 4, 1), (None, [0.5] * 8, None), (None, [0.25] * 8, 3), (3, [0.1] * 8, 1), (3, [0.2] * 8, 1), (107, [-0.0, 1e-9] * 4, 1)]
    want, books = brute(rows, 50)
    got, mine, _ = encoded(spark, rows, entries=50)
    assert got == want and mine == books and len(got) == 60 + 20 + 5


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded = part_codes.encode(df)
    assert part_codes.with_label_errors(coded.rows).collect() == [] and len(coded.books_sha256()) == 64


def test_bounds_save_most_distances():
    """Of a round on clustered parts most are settled without any listed entry."""
    rng = np.random.default_rng(3)
    book = rng.integers(-400, 400, (64, 8))
    x = book[rng.integers(0, 64, 3000)] + rng.integers(-40, 40, (3000, 8))
    near, squares, ids, lows, outer = part_codes.tried(x, book, 8)
    moved = book + rng.integers(-2, 3, book.shape)
    moves = part_codes.reach(((moved - book) ** 2).sum(1))
    got = part_codes.settled(x, moved, near.copy(), ids.copy(), lows - moves[ids], outer - moves.max())
    want = part_codes.tried(x, moved, 8)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and (got[5] == 0).mean() > 0.9
