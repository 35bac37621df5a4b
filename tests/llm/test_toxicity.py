from __future__ import annotations

from random import Random

from awkward import empty, frame, labels, prose, texts
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def rows(n=400):
    rng = Random(6)
    out = []
    for i in range(n):
        words = prose(rng, rng.randint(30, 120)).split()
        if i % 5 == 0:
            for w in rng.choice([["idiot", "moron"], ["zorkling", "zorkest"]]) * 2:
                words.insert(rng.randrange(len(words)), w)
        out.append((i, " ".join(words), "s"))
    return out


def test_held_out_accuracy_with_learned_terms(spark):
    known = labels(spark, [(i, 1, int(i % 5 == 0)) for i in range(400)])
    got = toxicity.classify(frame(spark, rows()), known, F.col("doc_id") < 300).collect()
    held = [r for r in got if r.doc_id >= 300]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 97 and all(0 <= r.score <= 1 for r in got)


def test_features():
    read = toxicity.Reader({"zork*": 2.0})
    f = read.features("You are an IDIOT, zorking id1ot!")
    assert f[1] == 1 and f[3] == 3 and f[6] == 3 and f[12] == 1 and f[8] > 0
    assert read.features("") == [0.0] * toxicity.N_FEATURES == read.features(" \n ") and not any(read.features("kind words only")[:7])


def test_long_words_are_looked_at():
    read = toxicity.Reader({"zork*": 2.0})
    for mark in "!", "?", "#":
        for n in (1, 199, 200, 5_000):
            f = read.features("you idiot" + mark * n)
            assert f[1] == 1 and f[6] == 1, (mark, n)
    assert read.features("you zork" + "x" * 1_000)[3] == 1 and max(map(len, read.known)) < toxicity.KEPT_CHARS


def test_the_lexicon_has_every_term_that_reaches_the_odds(spark):
    rows = [(f"bad{i:04} " * 2, 1) for i in range(1_500) for _ in range(4)] + [(f"fine{i}", 0) for i in range(9_000)]
    learned = toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert sum(t.startswith("bad") and not t.endswith("*") for t in learned) == 1_500


def test_training_rows_are_bounded(spark, monkeypatch):
    """Also where a labelled id is on many rows."""
    seen = []
    real = toxicity.lexicon
    monkeypatch.setattr(toxicity, "lexicon", lambda r: (seen.append(r.count()), real(r))[1])
    docs = frame(spark, [(i % 10, f"text {i}", "s") for i in range(400)])
    toxicity.train(docs, labels(spark, [(i, 1, i % 2) for i in range(10)]), F.lit(True), train_rows=30)
    assert 0 < seen[0] <= 30


def test_odd_rows(spark):
    known = labels(spark, [(1, 1, 0), (12, 1, 0), (15, 0, 1), (None, 1, 1), (2, None, None), (4, 7, 7)])
    got = toxicity.classify(frame(spark), known, F.lit(True)).collect()
    assert len(got) == len(texts()) and all(0 <= r.score <= 1 for r in got) and {r.words_ for r in got} == {"x"}


def test_no_labels_and_empty_table(spark):
    assert {r.score for r in toxicity.classify(frame(spark), labels(spark, []), F.lit(True)).collect()} == {0.0}
    known = labels(spark, [(i, 1, int(i % 5 == 0)) for i in range(400)])
    assert toxicity.classify(empty(spark), known, F.lit(True)).collect() == []
