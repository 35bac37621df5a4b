from __future__ import annotations

from collections import Counter

from awkward import WORD, empty, frame, texts
from pyspark.sql import functions as F

from tidemark.llm import cascade


def figures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_base_figures_equal_brute_force(spark):
    got = Counter(tuple(r) for r in cascade.judge(frame(spark)).select("doc_id", *cascade.FIGURES, "base_failed").collect())
    expected = Counter()
    for i, text, _ in texts():
        f = figures(text)
        expected[i, *f, f[0] < 50 or 100 * f[4] > 50 * f[0]] += 1
    assert got == expected


def test_verdicts(spark):
    rows = {r.doc_id: r for r in cascade.judge(frame(spark)).collect()}
    assert rows[1].kept and rows[12].kept and not rows[5].kept and not rows[8].kept
    assert [rows[i].rejected_by for i in (5, 14, 16)] == ["base"] * 3
    assert not rows[15].kept


def test_order_does_not_change_verdicts_and_short_circuits(spark):
    df = frame(spark)
    verdict = lambda rules: {(r.doc_id, r.kept) for r in cascade.judge(df, rules=rules).collect()}
    assert verdict(cascade.RULES) == verdict(cascade.RULES[::-1]) == {(r.doc_id, r.kept) for r in cascade.judge(df, sample_rows=1).collect()}


def test_greedy_order_prefers_rejections_per_cost(spark):
    rules = (cascade.Rule("dear", lambda c: c["n_words"] > 0, lambda c: F.lit(1000.0)),
             cascade.Rule("idle", lambda c: F.lit(False), lambda c: F.lit(1.0)),
             cascade.Rule("cheap", lambda c: c["n_words"] > 0, lambda c: F.lit(1.0)))
    df, names = cascade.figures(frame(spark).select("doc_id", "text"))
    df = df.withColumn("base_failed", F.lit(False))
    assert [r.name for r, _, _ in cascade.ordered(df, names, "doc_id", rules, 10_000, 100)][0] == "cheap"


def test_filters_on_results_are_not_pushed_into_the_arrays(spark):
    plan = cascade.judge(frame(spark)).filter("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1


def test_empty_table_and_columns(spark):
    got = cascade.judge(empty(spark))
    assert got.collect() == [] and {"words_", "text_", "score", "kept"} <= set(got.columns)
