from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from awkward import WORD, empty, frame, texts

from tidemark.llm import mixing


def water(sizes, cap=3.0):
    """Targets by resharing the excess until none is above."""
    total, names = sum(sizes.values()), sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] * (1 + 1e-12)]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_sources_meet_their_targets(spark):
    got = mixing.mix(frame(spark), block_words=500).collect()
    size, taken = Counter(), Counter()
    for r in got:
        assert r["taken"] == sum(d.words for d in r["draws"]) <= 3 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    expected = water(dict(size))
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
    longest = Counter()
    for r in got:
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        assert all(d.words == r["size"] for d in r["draws"])  # whole documents
    for s, t in expected.items():
        assert abs(taken[s] - t) <= longest[s] / 2 + 1, s
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in texts())


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 1, None: 30}, {"a": 1}, {"a": 5, "b": 0}, {"x": 10, "y": 10, "z": 10, "w": 500}])
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "src string, source_size long")
    got = {r.src: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_reruns_agree_and_shards_are_even(spark):
    df = frame(spark, [(i, "w " * (i % 17 + 1), "abc"[i % 3]) for i in range(900)])
    first, again = (mixing.mix(x, block_words=64, shards=8) for x in (df, df.repartition(7)))
    assert {(r.doc_id, r.taken, str(r.draws)) for r in first.collect()} == {(r.doc_id, r.taken, str(r.draws)) for r in again.collect()}
    units = defaultdict(set)
    for r in first.collect():
        for d in r.draws:
            units[d.shard].add((r.source, d.copy))
    assert len(units) == 8
    rows = mixing.shards_of(first).collect()
    assert sum(r.words for r in rows) == sum(r.taken for r in first.collect())
    assert all(len(WORD.findall(r.text)) == r.words for r in rows)


def test_hot_source_and_empty_table(spark):
    assert mixing.mix(empty(spark)).collect() == []
    nothing = mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [r["taken"] for r in nothing] == [0, 0]


def test_the_mix_has_whole_texts(spark):
    rows = [(i, f"a  b\tc\n{'d ' * (i % 40)}", "xyz"[i % 3]) for i in range(200)]
    by = {i: t for i, t, _ in rows}
    out = mixing.shards_of(mixing.mix(frame(spark, rows), block_words=100)).collect()
    assert out and all(r.text == by[r.doc_id] for r in out)


def test_shards_grow_with_the_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 50)
    monkeypatch.setattr(mixing, "LEAST_SHARDS", 2)
    df = frame(spark, [(i, "w " * 10, "abc"[i % 3]) for i in range(300)])
    assert len({d.shard for r in mixing.mix(df, block_words=20).collect() for d in r.draws}) > 40


def test_columns_of_any_name(spark):
    names = ["words", "room", "part", "cut_id", "p_size", "draws", "shard", "copy", "src", "block", "h", "doc", "id", "size", "before", "key", "rank", "Target"]
    df = frame(spark, [(1, "a b", "x"), (2, "c", "y")]).select("doc_id", "text", "source").selectExpr("*", *[f"'v' AS `{n}`" for n in names])
    got = mixing.mix(df)
    assert {(r.words, r.room, r.part, r.cut_id, r.p_size, r.src, r.doc, r.id) for r in got.collect()} == {("v",) * 8}
    assert {r.room for r in mixing.shards_of(got).collect()} == {"v"}
