from __future__ import annotations

import random

import numpy as np
from awkward import empty, frame, prose, texts

from tidemark.llm import chunks


def pieces(text):
    raw = text.encode()
    ends = chunks.cuts(np.frombuffer(raw, np.uint8)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def test_chunks_cover_a_text_and_resist_insertions():
    text = prose(random.Random(1), 4000) + " éü" * 50
    parts = pieces(text)
    assert b"".join(parts) == text.encode() and all(p.decode() for p in parts)
    assert max(map(len, parts)) <= chunks.MOST + 3
    moved = set(pieces("inserted words " + text[:9000] + " more inserted " + text[9000:]))
    assert sum(p not in moved for p in parts) <= 12


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(2)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 150), "s") for i in range(20)]
    rows += [(100 + i, prose(rng, 50) + " " + passage + " " + prose(rng, 50), "s") for i in range(10)]
    df = frame(spark, rows)
    spans = chunks.repeats(df)
    got = spans.collect()
    assert {r.doc_id for r in got} == set(range(101, 110)) and all(r.first_ids == [100] for r in got)
    by = {i: t for i, t, _ in rows}
    for r in got:
        assert by[r.doc_id][r.start:r.start + r.length] in by[100]
    out = {r.doc_id: r for r in chunks.without_repeats(df, spans).collect()}
    assert out[100].text == by[100] and out[0].text == by[0] and out[0].score == "x"
    for r in got:
        assert out[r.doc_id].text == by[r.doc_id][:r.start] + by[r.doc_id][r.start + r.length:]


def test_digests_equal_brute_force(spark):
    """A chunk repeats if a document with a smaller id has the same bytes in a chunk."""
    rows = texts()
    first = {}
    for i, t, _ in rows:
        for p in pieces(t or "") if t else []:
            if i is not None:
                first[p] = min(first.get(p, i), i)
    expected = {}
    for i, t, _ in rows:
        expected.setdefault(i, set()).update(p for p in (pieces(t) if t else []) if p in first and (i is None or first[p] < i))
    got = chunks.repeats(frame(spark), min_words=0).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r.doc_id for r in got} == {i for i, v in expected.items() if v}


def test_each_text_of_an_id_is_cut_by_its_own_spans(spark):
    rng = random.Random(6)
    passage, clean, other = prose(rng, 60), prose(rng, 90), prose(rng, 60)
    rows = [(1, passage + " " + other, "s"), (2, "x " + passage + " y", "s"), (2, clean, "s"), (2, "x " + passage + " y", "s"),
            (None, "z " + other, "s"), (None, clean + " more", "s")]
    df = frame(spark, rows)
    out = sorted((str(r.doc_id), r.text) for r in chunks.without_repeats(df, chunks.repeats(df)).collect())
    assert (("2", clean) in out and ("1", passage + " " + other) in out and ("None", clean + " more") not in out) is True
    cut = [t for i, t in out if i == "2" and t != clean]
    assert len(cut) == 2 and cut[0] == cut[1] and len(cut[0]) < 12 and len(next(t for i, t in out if i == "None" and t.startswith("z"))) < 12


def test_passages_of_the_threshold_have_seeds():
    """Pairs of equal passages between other words: how many share a whole chunk."""
    rng, found = random.Random(12), 0
    for _ in range(400):
        passage = prose(rng, chunks.MIN_WORDS)
        a, b = (set(pieces(f"{prose(rng, 20)} {passage} {prose(rng, 20)}")) for _ in range(2))
        found += bool(a & b)
    assert found >= 396


def test_empty_table(spark):
    spans = chunks.repeats(empty(spark))
    assert spans.collect() == [] and chunks.without_repeats(empty(spark), spans).collect() == []


def test_passages_just_over_the_threshold_are_found_whole(spark, monkeypatch):
    """Many passages of 51 to 55 words, and of short words: each is found from its first to its last character."""
    rng = random.Random(8)

    def short(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(2, 6))) for _ in range(n))

    rows, passages = [], {}
    for i in range(150):
        passage = (short if i % 2 else lambda n: prose(rng, n).replace("\n", " "))(rng.randint(51, 55))
        passages[1000 + i] = passage
        rows += [(i, f"{short(40)} A{passage}B {short(40)}", "s"), (1000 + i, f"{short(30)} C{passage}D {short(30)}", "s")]
    texts_of = {i: t for i, t, _ in rows}
    for width in (chunks.AROUND, 4):  # also in many rounds
        monkeypatch.setattr(chunks, "AROUND", width)
        got = {r.doc_id: r for r in chunks.repeats(frame(spark, rows), min_words=45).collect()}
        assert set(got) == set(passages)
        for i, r in got.items():
            found = texts_of[i][r.start:r.start + r.length]
            # the first word has another letter in front, so it begins outside
            assert found == passages[i] and r.first_ids == [i - 1000] and r.words == len(found.split()) - 1


def test_texts_around_stretches_are_not_broadcast(spark):
    """Thousands of long copies are a few KB on disk; a broadcast of them goes through the driver."""
    text = prose(random.Random(8), 3000)
    docs = [(i, i, text) for i in range(40)]
    seeds = [(i, i, 0, 0, 0, 9000, 9100, 1400, 1420, 9000, 9100) for i in range(1, 40)]
    columns = ["id", "version", "first", "first_version", "shift", "lo", "hi", "lo_words", "hi_words", "seed_lo", "seed_hi"]
    got = chunks.extended(spark.createDataFrame(docs, "id long, version long, text string"), spark.createDataFrame(seeds, ", ".join(f"{c} long" for c in columns)), 4096)
    assert [(r.lo, r.hi, r.open) for r in got.collect()] == [(9000 - 4096, 9100 + 4096, True)] * 39
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
