from __future__ import annotations

import random
import re

import pytest
from awkward import empty, frame, prose, texts

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[j:j + n]), set()).add(None if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out.append((i, len(w), sorted(hit), sorted(found, key=lambda x: (x is not None, x or ""))))
    return sorted(out, key=repr)


def got(docs, items):
    rows = decontaminate.hits(docs, items).collect()
    for r in rows:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted(((r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.end)], [i.item for i in r["items"]]) for r in rows), key=repr)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, doc_id string, w string").repartition(2)


def test_odd_rows_equal_brute_force(spark):
    rng = random.Random(3)
    rows = texts()
    long = prose(rng, 40)
    items = [(i, prose(rng, rng.randint(1, 60))) for i in range(12)] + [
        (50, long), (51, long + " more"), (52, "two words"), (52, "one"), (53, None), (54, " ., "), (None, prose(random.Random(5), 120)[:150]), (55, "to " * 30),
        (56, "Café café ΣΣ")]
    for k in range(12):  # whole items, beginnings, ends and torn ones inside other texts
        item = words(items[k][1] if k < 10 else long)
        a, b = sorted(rng.sample(range(len(item) + 1), 2)) if len(item) > 1 else (0, 1)
        rows += [(100 + k, f"{prose(rng, 15)} {'_'.join(item[a:b])}! {prose(rng, 9)}", "a"), (200 + k, " ".join(item).upper(), "b")]
    rows += [(300, long + " " + long, "a")] * 2 + [(None, long, None), (301, "x " + " ".join(long.split()[:9]), "a")]
    want = brute([(i, t) for i, t, _ in rows], items)
    assert got(frame(spark, rows), benchmark(spark, items)) == want
    assert sum(bool(r[2]) for r in want) > 20 and sum(not r[2] for r in want) > 20


def test_a_common_passage_in_most_texts(spark):
    rng = random.Random(4)
    passage = prose(rng, 30)
    rows = [(i, f"{prose(rng, 8)} {passage if i % 3 else ''} {prose(rng, 8)}", "a") for i in range(150)]
    items = [(1, passage), (2, passage + " " + prose(rng, 10)), (3, prose(rng, 30))]
    assert got(frame(spark, rows), benchmark(spark, items)) == brute([(i, t) for i, t, _ in rows], items)


@pytest.mark.parametrize("rows, items", [([], [(1, "a b c")]), ([(1, "a b c", "x")], []), ([], [])])
def test_empty_tables(spark, rows, items):
    docs = frame(spark, rows) if rows else empty(spark)
    assert got(docs, benchmark(spark, items)) == brute([(i, t) for i, t, _ in rows], items)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    from tidemark.llm import bitmaps

    monkeypatch.setattr(bitmaps, "MOST_LOG", 6)
    rng = random.Random(9)
    items = [(i, prose(rng, 30)) for i in range(8)]
    rows = [(i, prose(rng, 20) + " " + items[i % 8][1][:100], "a") for i in range(40)]
    assert got(frame(spark, rows), benchmark(spark, items)) == brute([(i, t) for i, t, _ in rows], items)
