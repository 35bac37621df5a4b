from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from awkward import SCHEMA, empty, prose

from tidemark.llm import bitmaps, collocations

CUT, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least=10, share=50, top=2000, longest=3):
    """rows of (text, lang)"""
    out = []
    for lang in {x or ("und" if x is None else x) for _, x in rows}:
        f = Counter()
        for text, x in rows:
            if (x if x is not None else "und") != lang:
                continue
            for piece in CUT.split(lowered(text)):
                w = WORD.findall(piece)
                for m in range(1, longest + 1):
                    f.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((" ".join(p), a, l, r, n, score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(found[:top], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(8)
    words = [prose(rng, 1).strip(".").lower() for _ in range(40)] + ["a", "the", "the", "the", "éa", "ΣΣ", "\x01x", "w" * 1500, " ", "a\x00b"]
    rows = [(" ".join(rng.choice(words) + rng.choice(["", "", "", "", ".", "\t", "\n", ", "]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None, ""]))
            for _ in range(120)]
    rows += [("New York Stock exchange is new york again: new york!", "en")] * 30 + [("to " * 4000, "long"), (None, "en"), (None, None), ("", "de"), ("lone", "xx")]
    rows += [("A B C A B C\x0bA b c", "abc")] * 12 + [("x y", "x")] * 9 + [("x y", "y")] * 10
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, None, None, *["x"] * 11) for i, (t, x) in enumerate(rows)], SCHEMA).repartition(3)


def mined(spark, rows, **kw):
    got = collocations.mine(frame(spark, rows), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_odd_rows_equal_brute_force(spark):
    want = brute(corpus())
    assert mined(spark, corpus()) == want and {x[0] for x in want} >= {"en", "abc", "long", "y"} and "x" not in {x[0] for x in want}
    assert any(x[2].count(" ") == 2 for x in want) and any(x[2].count(" ") == 1 for x in want)


def test_small_filters_and_full_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "KEPT", 60)
    monkeypatch.setattr(collocations, "BUCKET", 50)
    monkeypatch.setattr(bitmaps, "MOST_LOG", 8)
    monkeypatch.setattr(bitmaps, "LEAST_LOG", 8)
    assert mined(spark, corpus(), least=3, top=15) == brute(corpus(), least=3, top=15)


def test_longer_phrases(spark):
    assert mined(spark, corpus(), least=4, longest=4, share=70) == brute(corpus(), least=4, longest=4, share=70)


@pytest.mark.parametrize("rows", [[], [(None, "en")], [("a b", "en")]])
def test_nothing_frequent(spark, rows):
    docs = frame(spark, rows) if rows else empty(spark)
    assert collocations.mine(docs).collect() == []


def test_equal_ids_take_the_next_seed(spark, monkeypatch):
    seeds = []
    monkeypatch.setattr(collocations, "in_tasks", lambda f, **kw: (seeds.append(kw.get("seed")), real(f, **kw))[1])
    monkeypatch.setattr(collocations.math, "ceil", lambda x: 1)  # ids of 8 bits
    words = spark.createDataFrame([("en", f"w{i}", 20) for i in range(14)], "lang string, word string, n long")
    common, _, seed, width = collocations.word_ids(words, 10)
    assert width == 8 and common.select("w1").distinct().count() == 14 and seed in seeds


from tidemark.llm.common import in_tasks as real  # noqa: E402


@pytest.mark.parametrize("n, width, quotient", [(2, 24, 3), (3, 48, 11), (3, 64, 5), (4, 40, 0)])
def test_filters_lose_nothing(n, width, quotient):
    rng = np.random.default_rng(n)
    lanes = [rng.integers(0, 2**width - 1, 500, dtype=np.uint64, endpoint=True) for _ in range(n)]
    there = collocations.permuted(lanes, width)
    assert all(int(x.max()).bit_length() <= width for x in there) and any((a != b).any() for a, b in zip(lanes, there))
    assert all((a == b).all() for a, b in zip(lanes, collocations.permuted(there, width, back=True)))
    counts = rng.integers(1, 600, 500)
    rest = width - quotient
    there[0] = there[0] & np.uint64(2**rest - 1) | np.uint64(((1 << quotient) - 1) << rest)
    blob = collocations.packed(there, counts, width, rest)
    back, again = collocations.unpacked(blob, 500, n, width, rest, (1 << quotient) - 1)
    assert all((a == b).all() for a, b in zip(there, back)) and (counts == again).all()


def test_large_numbers_are_exact(spark):
    """Products beyond 64 bits."""
    expr = "CAST(1000000 * CAST(a AS DECIMAL(18,0)) * CAST(a AS DECIMAL(18,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)"
    a, l, r = 999_999_999_989, 1_000_000_000_039, 1_000_000_000_061
    assert spark.sql(f"SELECT {expr} AS s FROM VALUES (CAST({a} AS BIGINT), CAST({l} AS BIGINT), CAST({r} AS BIGINT)) t(a, l, r)").first().s == 10**6 * a * a // (l * r)
