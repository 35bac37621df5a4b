from __future__ import annotations

from itertools import product

import numpy as np
from awkward import empty, frame, labels, prose, texts
from pyspark.sql import functions as F

from tidemark.llm import line_crf, training


def test_marginals_and_moves_equal_enumeration():
    rng = np.random.default_rng(3)
    first = np.array([0, 4, 5, 8])
    design = rng.normal(size=(8, 3))
    model = line_crf.Model(weights=rng.normal(size=3), moves=rng.normal(size=(2, 2)), begin=rng.normal(size=2))
    marginal, moved, started, total = line_crf.forward_backward(model, design, line_crf.steps(first))
    logs = 0.0
    score = design @ model.weights
    moves, begun = np.zeros((2, 2)), np.zeros(2)
    for a, b in zip(first, first[1:]):
        weights, paths = [], list(product((0, 1), repeat=b - a))
        for path in paths:
            s = model.begin[path[0]] + sum(score[a + t] * y for t, y in enumerate(path)) + sum(model.moves[x, y] for x, y in zip(path, path[1:]))
            weights.append(np.exp(s))
        logs += np.log(sum(weights))
        weights = np.array(weights) / sum(weights)
        for t in range(b - a):
            assert np.isclose(marginal[a + t, 1], sum(w for w, p in zip(weights, paths) if p[t]))
        for w, p in zip(weights, paths):
            begun[p[0]] += w
            for x, y in zip(p, p[1:]):
                moves[x, y] += w
    assert np.allclose(moved, moves) and np.allclose(started, begun) and np.isclose(total, logs)


def test_the_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    width = 3 * line_crf.OWN
    x, first, good = rng.normal(size=(9, width)), np.array([0, 4, 5, 9]), np.array([1, 0, 1])

    def at(p):
        return line_crf.Model(weights=p[:width + 1], moves=p[width + 1:width + 5].reshape(2, 2), begin=p[width + 5:])

    p = rng.normal(size=width + 7) * 0.3
    value, gradient = line_crf.learned_from(at(p), x, first, good)
    for k in [*range(0, width + 1, 7), *range(width + 1, width + 7)]:
        d = np.zeros(len(p))
        d[k] = 1e-5
        slope = (line_crf.learned_from(at(p + d), x, first, good)[0] - line_crf.learned_from(at(p - d), x, first, good)[0]) / 2e-5
        assert np.isclose(slope, gradient[k], atol=1e-4)
    assert value < 0


def test_the_least_place_of_a_convex_function():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(12, 12))
    a = a @ a.T + np.eye(12)
    b = rng.normal(size=12)
    calls = []
    p = line_crf.least(lambda x: (calls.append(1), (0.5 * x @ a @ x - b @ x, a @ x - b))[1], np.zeros(12), 80)
    assert np.allclose(a @ p, b, atol=1e-3) and len(calls) <= 80


def test_rows_of_one_id_are_bounded(spark):
    """Many rows of one labelled id, of one text and of several."""
    docs = frame(spark, [(1, "same text", "s")] * 50 + [(2, f"text {i}", "s") for i in range(50)] + [(3, "other", "s")])
    known = labels(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0), (3, 1, 0)])
    got = training.labelled(docs, known, F.lit(True), id_col="doc_id", text_col="text", label_col="quality", rows=20).collect()
    assert len(got) == 20 and len({(r.h, r.text) for r in got}) == 20
    every = training.labelled(docs, known, F.lit(True), id_col="doc_id", text_col="text", label_col="quality", rows=1000).collect()
    assert len(every) == 52 and {(r.h, r.text) for r in got} <= {(r.h, r.text) for r in every}


def test_repeats_equal_brute_force():
    rng = np.random.default_rng(1)
    words, doc = rng.integers(0, 4, 400), np.sort(rng.integers(0, 30, 400))
    got = line_crf.repeats(words.astype(np.int64), doc)
    for d in range(30):
        w = words[doc == d].tolist()
        seen = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        again = {j for i, x in enumerate(seen) if seen.count(x) > 1 for j in (i, i + 1, i + 2)}
        assert [int(x) for x in got[doc == d]] == [int(i in again) for i in range(len(w))]


def test_held_out_accuracy(spark):
    from random import Random

    rng = Random(4)
    rows = []
    for i in range(300):
        good = i % 3 > 0
        text = prose(rng, rng.randint(30, 200))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "s"))
    known = labels(spark, [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)])
    got = line_crf.classify(frame(spark, rows), known, F.col("doc_id") % 4 == 0).collect()
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in got) >= 297 and all(0 <= r.score <= 1 for r in got)


def test_odd_rows_and_lines(spark):
    known = labels(spark, [(1, 1, 0), (12, 1, 0), (15, 0, 0), (16, 0, 1), (99, 1, 1), (None, 1, 1), (2, None, None), (4, 7, 7)])
    got = line_crf.classify(frame(spark), known, F.lit(True), lines=True).collect()
    assert len(got) == len(texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(len(r.lines) == (r.text or "").count("\n") + 1 for r in got)


def test_no_labels_and_empty_table(spark):
    nothing = labels(spark, [])
    assert {r.score for r in line_crf.classify(frame(spark), nothing, F.lit(True)).collect()} == {0.5}
    assert line_crf.classify(empty(spark), labels(spark, [(1, 1, 0)]), F.lit(True)).collect() == []


def test_bad_lines_late_in_a_long_text_are_learned(spark):
    from random import Random

    rng = Random(6)

    def lines(n):
        return [prose(rng, 12).replace("\n", " ") for _ in range(n)]

    junk = ["BUY NOW!! $$ | ## WIN | 100% %% <<>> !!"] * 400
    texts_ = ["\n".join(lines(220) + junk) if i % 2 else "\n".join(lines(300)) for i in range(20)]
    model = line_crf.fit(spark.createDataFrame([(i, 1 - i % 2, t) for i, t in enumerate(texts_)], "h long, label int, text string"))
    bad, good = line_crf.qualities(model, ["\n".join(junk[:50]), "\n".join(lines(50))])[0]
    late = line_crf.qualities(model, ["\n".join(lines(220) + junk)])[0][0]
    assert bad < 0.1 and late < 0.5 < good
