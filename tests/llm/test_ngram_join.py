from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from awkward import WORD, empty, frame, prose, texts

from tidemark.llm import ngram_join
from tidemark.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, size, num, den):
    """Size and smallest id of the component, by id (ids differ)."""
    sets = {}
    for i, t, _ in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = set(zip(*(w[k:] for k in range(size)))) if len(w) >= size else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    todo = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in todo:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near(seed, groups=12, most=25):
    """Groups of copies with a few words changed, cut or added, and passages that many texts share."""
    rng = random.Random(seed)
    hot = prose(rng, 30)
    rows = []
    for _ in range(groups):
        base = prose(rng, rng.randint(8, 150)).split()
        for _ in range(rng.randint(1, most)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = prose(rng, 1) + str(rng.randint(0, 9))
            if rng.random() < 0.3:
                w = w[: len(w) - rng.randint(0, 6)]
            if rng.random() < 0.2:
                w += hot.split()
            rows.append((len(rows) * 7 % 1009, " ".join(w), "s"))
    return rows


@pytest.mark.parametrize("seed, size, num, den", [(1, 3, 9, 10), (2, 5, 8, 10), (3, 3, 8, 10), (4, 2, 5, 10)])
def test_components_equal_brute_force(spark, seed, size, num, den):
    rows = near(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(spark, rows), size=size, num=num, den=den).collect()}
    assert got == brute(rows, size, num, den)


def test_large_clusters_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    rows = near(9, groups=3, most=40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(spark, rows), size=3, num=9, den=10).collect()}
    assert got == brute(rows, 3, 9, 10)


def test_near_copies_without_ids_are_linked(spark):
    rng = random.Random(5)
    base = prose(rng, 100).split()
    near_one, bridge = " ".join(base[:99] + ["x"]), " ".join(base[:98] + ["y", "z"])
    other = prose(rng, 50)
    rows = [(1, " ".join(base), "s"), (None, near_one, "s"), (None, near_one, "s"), (None, other, "s"), (None, other + " w", "s"), (7, other + " w v", "s")]
    got = ngram_join.join(frame(spark, rows), size=3, num=8, den=10).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in got if r.doc_id) == [(False, 1, 1), (False, 7, 7)]
    assert sorted(r.component_id for r in got if r.doc_id is None) == [1, 1, 7, 7] and bridge
    kept = ngram_join.representatives(frame(spark, rows), size=3).collect()
    assert sorted(r.doc_id for r in kept) == [1, 7]
    # linked through a text without an id only
    chain = [(5, " ".join(base), "s"), (None, " ".join(base[:96] + list("abcd")), "s"), (6, " ".join(base[:92] + list("efghabcd")), "s")]
    linked = {r.doc_id: r.component_id for r in ngram_join.join(frame(spark, chain), size=1, num=9, den=10).collect()}
    assert linked == {5: 5, None: 5, 6: 5}


def test_several_texts_of_one_id(spark):
    rng = random.Random(6)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a, "s"), (1, b, "s"), (2, a + " x", "s"), (3, b + " y", "s")]
    got = sorted((r.doc_id, r.component_id) for r in ngram_join.join(frame(spark, rows), size=3, num=8, den=10).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1)]


@pytest.mark.parametrize("pivots", [0, 1, 3])
def test_large_clusters_are_contracted(spark, monkeypatch, pivots):
    """Copies that link with a pivot, chains whose ends do not, and groups that only hang together by common passages."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "PIVOTS", max(1, pivots))
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", pivots)
    rng = random.Random(11)
    rows, word = [], [f"w{i}" for i in range(400)]
    for i in range(24):  # a chain: neighbours are similar, the ends have nothing in common
        rows.append((i, " ".join(word[3 * i: 3 * i + 60]), "s"))
    base = [f"v{i}" for i in range(80)]
    for i in range(30):  # copies of one text
        t = list(base)
        t[rng.randrange(80)] = f"n{i}"
        rows.append((100 + i, " ".join(t), "s"))
    for i in range(20):  # two groups with half of their words in common
        t = base[:40] + [f"u{i % 2}_{j}" for j in range(40)]
        t[rng.randrange(80)] = f"m{i}"
        rows.append((200 + i, " ".join(t), "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(spark, rows), size=3, num=7, den=10).collect()}
    assert got == brute(rows, 3, 7, 10)


def test_many_parts_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART_GRAMS", 40)
    rows = near(12)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(spark, rows), size=3, num=9, den=10).collect()}
    assert got == brute(rows, 3, 9, 10)


def test_representatives_with_columns_of_any_name(spark):
    df = frame(spark, [(1, "a b c d", "s"), (2, "a b c d", "s")]).selectExpr("*", *[f"'v' AS `{n}`" for n in ("kept_", "mine_", "hash_", "group_", "group", "text_hash", "component_id")])
    assert [(r.doc_id, r["kept_"], r["group"]) for r in ngram_join.representatives(df).collect()] == [(1, "v", "v")]


def test_partial_overlaps_sum_to_intersections(monkeypatch):
    for name, value in (("COLUMNS", 7), ("FEW", 3), ("FRAGMENT", 11)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(1)
    a, b = ([np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(n)] for n in (6, 9))
    assert ngram_join.overlaps(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    own = ngram_join.overlaps(a, None)  # the diagonal is not counted: n-grams of one set alone are left out
    assert all(own[i, j] == len(np.intersect1d(a[i], a[j])) for i, j in combinations(range(len(a)), 2))


def test_odd_rows(spark):
    got = {}
    for r in ngram_join.join(frame(spark), size=3, num=9, den=10).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert got[5] == [(0, 5)] and got[6] == [(0, 6)] and got[7] == [(0, 7)] and got[9] == [(1, 9)] and got[10] == [(1, 9)]
    assert [got[i][0][1] for i in (1, 2, 3, 4)] == [1, 1, 1, 1] and len(got[20]) == 3 and {c for _, c in got[20]} == {20}
    assert sorted(n for n, _ in got[None]) == [0, 5] and len(got) == len({i for i, _, _ in texts()})


def test_representatives(spark):
    out = ngram_join.representatives(frame(spark)).collect()
    ids = sorted(r.doc_id for r in out if r.doc_id is not None)
    assert len(ids) == len(set(ids)) and not {2, 3, 4, 10} & set(ids) and {1, 5, 6, 7, 8, 9, 12, 13, 14, 20} <= set(ids)
    assert len(out[0]) == len(frame(spark).columns)


def test_empty_table(spark):
    assert ngram_join.join(empty(spark)).collect() == [] and ngram_join.representatives(empty(spark)).collect() == []


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(900, x) for x in range(901, 950)]
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: m for x, m in label.items() if any(a != b and x in (a, b) for a, b in edges)}


def test_shared_passages_of_texts_of_other_sizes_make_no_cluster(spark, monkeypatch):
    """Every passage is in two texts, whose sizes rule a link out: nothing hangs together and no pair is compared."""
    compared, seen = ngram_join.compared, []
    monkeypatch.setattr(ngram_join, "compared", lambda known, pairs, num, den: (seen.append(pairs.count()), compared(known, pairs, num, den))[1])
    passage = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(30)]
    rows = [(i, " ".join(passage[k] for k in range(30) if i in (k % 5, 5 + k % 4)), "s") for i in range(9)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(spark, rows), size=3, num=9, den=10).collect()}
    assert got == brute(rows, 3, 9, 10) and seen == [0]


def test_frequent_n_grams_are_counted(spark):
    """Within a group of texts as between them."""
    rng = np.random.default_rng(4)
    every = rng.integers(0, 1 << 63, 120).astype(np.uint64) * np.uint64(2)
    sets = {i: np.unique(rng.choice(every, 30)) for i in range(60)}
    known = spark.createDataFrame([(i, len(g), g.tobytes()) for i, g in sets.items()], "node long, n long, grams binary").repartition(3)
    grams, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    _, frequent = ngram_join.crowded(known, None, 1.0, 9, 10, int(counts.sum()), tally=True)
    got = {c: n for c, n in frequent.groupBy("class").agg({"keys": "collect_list"}).collect()}
    expected = {}
    for n in counts[counts >= ngram_join.FREQUENT].tolist():
        expected[n.bit_length()] = expected.get(n.bit_length(), 0) + 1
    assert {c: sum(len(k) // 4 for k in keys) for c, keys in got.items()} == expected
    classes = ngram_join.frequency_classes(frequent)
    ends = (grams & np.uint64(len(classes) - 1)).astype(int)
    assert all(classes[e] == max(n.bit_length() if n >= ngram_join.FREQUENT else 0 for n in counts[ends == e].tolist()) for e in np.unique(ends).tolist())
