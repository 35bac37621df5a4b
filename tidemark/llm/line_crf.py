"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text is good or bad.  A line's score comes from its own features and those of the lines before and
after it (rates of capitals, symbols, digits, exclamation marks, how much of it repeats elsewhere in the text, word
length); a transition score ties neighbouring lines.  Forward-backward gives every line its marginal probability of being
good, and a document's quality is their mean, weighted by the lengths of the lines.

Labels exist for documents only, so in training every line has the label of its document.  The model is fitted on at most
``train_rows`` labelled rows, chosen by a hash of their ids, and on every line of them, by quasi-Newton steps: tasks add up the
gradient of their texts, the driver sees sums only.  Scoring covers every line of every text.

Defined results: a NULL text is empty; an empty text is one empty line and gets the marginal of such a line; labels other than
0 and 1 and NULL ids are not learned from; without labels of both kinds every score is 0.5; repeated rows score alike; an
empty table gives an empty table; extra columns are kept, unless they have the name of a result column."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROOT, col, in_tasks, stored
from tidemark.llm.training import labelled

#: Bound of the rows that the model is fitted on; their texts are whole.
TRAIN_ROWS = 3_000
SCORED_CHARS = 1 << 18
#: Tasks that hold the rows while the model is fitted.
MOST_TASKS = 64

# classes of bytes: 0 other, 1 capital, 2 small letter, 3 digit, 4 symbol, 5 bar, 6 exclamation mark, 7 part of an earlier character
CLASSES = np.zeros(256, dtype=np.int64)
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58] = 1, 2, 3
CLASSES[[ord(c) for c in "#*$%&<>"]] = 4
CLASSES[ord("|")], CLASSES[ord("!")] = 5, 6
CLASSES[0x80:0xC0], CLASSES[0xC0:] = 7, 2
OWN = 13


@dataclass
class Lines:
    """Features of the lines of some texts, the first line of each text (and the end), and the lines' lengths."""

    x: np.ndarray
    first: np.ndarray
    chars: np.ndarray


def lines_of(texts: list[str]) -> Lines:
    counts = np.array([t.count("\n") + 1 for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    raw = np.frombuffer("\n".join(texts).encode("utf-8", "replace"), dtype=np.uint8)
    n = int(first[-1])
    ends = raw == 10
    line = np.cumsum(ends) - ends
    kinds = np.bincount(line * 8 + CLASSES[raw], minlength=8 * n)[: 8 * n].reshape(n, 8).astype(float)
    kinds[:, 0] -= np.bincount(line[ends], minlength=n)[:n]
    chars = kinds[:, :7].sum(axis=1)
    words = [w.split() for t in texts for w in t.split("\n")]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    hashes = np.fromiter((hash(w) for ws in words for w in ws), dtype=np.int64, count=int(sizes.sum()))
    of_line = np.repeat(np.arange(n), sizes)
    again = repeats(hashes, np.searchsorted(first, of_line, side="right"))
    covered = np.bincount(of_line, weights=again, minlength=n)[:n]
    per_char = 1.0 / np.maximum(chars, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    share, size = covered / np.maximum(sizes, 1), np.log1p(chars)
    marks = kinds[:, 3:7].sum(axis=1) * per_char
    own = np.stack([
        size, kinds[:, 1] / letters, kinds[:, 4] * per_char, kinds[:, 5] * per_char, kinds[:, 6] * per_char, kinds[:, 3] * per_char,
        share, chars / np.maximum(sizes, 1) / 10, (sizes == 0).astype(float),
        # a long line says more than a short one
        share > 0.5, (share > 0.5) * size, (marks > 0.1) * size, (kinds[:, 1] > 0.4 * letters) * size], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return Lines(np.concatenate([own, before, after], axis=1), first, chars)


def repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word whether it is in a 3-word window that its text has twice or more."""
    out = np.zeros(len(words), dtype=float)
    if len(words) < 3:
        return out
    with np.errstate(over="ignore"):
        w = words[:-2] * np.int64(0x9E3779B97F4A7C1) + words[1:-1] * np.int64(0x27D4EB2F165667C5) + words[2:] * np.int64(0x165667B19E3779F9)
        w ^= (doc[:-2] * np.int64(0x2545F4914F6CDD1D)) >> 7 ^ doc[:-2] << 40
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    order = inside[np.argsort(w[inside], kind="stable")]
    equal = w[order[1:]] == w[order[:-1]]
    twice = np.zeros(len(w), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    for k in range(3):
        out[k: k + len(w)][twice] = 1
    return out


@dataclass
class Model:
    """Standardization of features, weights of a good line, transitions between (bad, good), scores of the first line."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(3 * OWN))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3 * OWN))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * OWN + 1))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)


def steps(first: np.ndarray) -> list[np.ndarray]:
    """For each position t, the t-th lines of the texts that have one, longest texts first."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    starts, size = first[:-1][order], size[order]
    active = np.searchsorted(-size, -np.arange(size[0]), side="left") if len(size) else []
    return [starts[:k] + t for t, k in enumerate(active)]


def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(model: Model, design: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Marginals of the lines, expected moves, marginals of the first lines (both summed over texts), and the sum of the texts' log totals."""
    score = np.zeros((len(design), 2))
    score[:, 1] = design @ model.weights
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    for t, rows in enumerate(at):
        alpha[rows] = score[rows] + (model.begin if t == 0 else log_sum(alpha[at[t - 1][: len(rows)]][:, :, None] + model.moves, 1))
    moved = np.zeros((2, 2))
    for t in range(len(at) - 2, -1, -1):
        nxt = at[t + 1]
        beta[at[t][: len(nxt)]] = log_sum(model.moves + (score[nxt] + beta[nxt])[:, None, :], 2)
    both = alpha + beta
    total = log_sum(both, 1)
    marginal = np.exp(both - total[:, None])
    for t in range(len(at) - 1):
        nxt, now = at[t + 1], at[t][: len(at[t + 1])]
        pair = alpha[now][:, :, None] + model.moves + (score[nxt] + beta[nxt])[:, None, :]
        pair = np.exp(pair - total[now][:, None, None])
        moved += pair.sum(axis=0)
    if not at:
        return marginal, moved, np.zeros(2), 0.0
    return marginal, moved, marginal[at[0]].sum(axis=0), float(total[at[0]].sum())


def learned_from(model: Model, x: np.ndarray, first: np.ndarray, good: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood of some texts whose lines are all good or all bad, and its gradient (weights, moves, begin)."""
    design, at = model.design(x), steps(first)
    sizes = np.diff(first)
    y = np.repeat(good.astype(float), sizes)
    told = np.diag([float((sizes - 1)[good == k].sum()) for k in (0, 1)])
    begun = np.array([float((good == k).sum()) for k in (0, 1)])
    marginal, moved, started, total = forward_backward(model, design, at)
    own = float((design @ model.weights) @ y + (told * model.moves).sum() + begun @ model.begin)
    return own - total, np.concatenate([design.T @ (y - marginal[:, 1]), (told - moved).ravel(), begun - started])


def prepared(batches):
    """(label, text) to lists of texts of bounded length: features of their lines, first lines, labels."""
    for batch in batches:
        at = 0
        for held in batches_of(batch.column("text").to_pylist()):
            lines = lines_of(held)
            good = np.array(batch.column("label").slice(at, len(held)).to_pylist(), dtype=np.uint8)
            at += len(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lines.x.astype("<f4").tobytes()], pa.binary()), pa.array([lines.first.astype("<i8").tobytes()], pa.binary()), pa.array([good.tobytes()], pa.binary())],
                names=["x", "first", "good"])


def unpacked(batches):
    for batch in batches:
        for x, first, good in zip(*(c.to_pylist() for c in batch.columns)):
            yield (np.frombuffer(x, dtype="<f4").reshape(-1, 3 * OWN).astype(float), np.frombuffer(first, dtype="<i8"), np.frombuffer(good, dtype=np.uint8))


def summed(rows) -> pa.RecordBatch:
    """One row with the sum of some arrays of numbers."""
    return pa.RecordBatch.from_arrays([pa.array([np.sum(rows, axis=0).astype("<f8").tobytes()], pa.binary())], names=["sums"])


def moments(batches):
    """Numbers of texts, good texts and lines, sums and sums of squares of the features."""
    rows = [np.concatenate([[len(good), good.sum(), len(x)], x.sum(axis=0), (x * x).sum(axis=0)]) for x, _, good in unpacked(batches)]
    if rows:
        yield summed(rows)


def gradients(batches, model: Model):
    rows = [np.concatenate([[value], gradient]) for value, gradient in (learned_from(model, *one) for one in unpacked(batches))]
    if rows:
        yield summed(rows)


def added(rows: DataFrame) -> np.ndarray | None:
    """The sum of the rows that tasks have made: some dozens of numbers from each."""
    got = [np.frombuffer(r["sums"], dtype="<f8") for r in rows.collect()]
    return np.sum(got, axis=0) if got else None


def fit(rows: DataFrame, rounds: int = 40, ridge: float = 1e-3) -> Model:
    """The model of most likelihood, with a ridge, of (h, label, text).  Tasks keep the texts: each round they add up likelihood and
    gradient of theirs, and the driver takes a quasi-Newton step with some dozens of numbers."""
    tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, MOST_TASKS))
    dealt = rows.select("h", "label", "text").repartition(tasks, "h").sortWithinPartitions("h", F.xxhash64("text"))
    features = stored(dealt.mapInArrow(in_tasks(prepared), "x binary, first binary, good binary"), "features")
    sums = added(features.mapInArrow(in_tasks(moments), "sums binary"))
    if sums is None or not 0 < sums[1] < sums[0]:
        return Model()
    texts, n, width = sums[0], sums[2], 3 * OWN
    mean = sums[3: 3 + width] / n
    base = Model(mean=mean, scale=np.sqrt(np.maximum(sums[3 + width:] / n - mean**2, 0)) + 1e-6)

    def at(p: np.ndarray) -> Model:
        return Model(base.mean, base.scale, p[: width + 1], p[width + 1: width + 5].reshape(2, 2), p[width + 5:])

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        got = added(features.mapInArrow(in_tasks(gradients, model=at(p)), "sums binary"))
        return 0.5 * ridge * float(p @ p) - got[0] / texts, ridge * p - got[1:] / texts

    return at(least(loss, np.zeros(width + 7), rounds))


def least(loss, p: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """The place of the least of a smooth convex function that gives value and gradient: limited-memory quasi-Newton steps, halved
    until they lead down enough; ``rounds`` evaluations at most."""
    value, grad = loss(p)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < rounds and np.abs(grad).max() > 1e-5:
        q, alphas = grad.copy(), []
        for s, y in reversed(pairs):
            alphas.append((s @ q) / (s @ y))
            q -= alphas[-1] * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1.0 / max(1.0, float(np.abs(grad).max()))
        for (s, y), a in zip(pairs, reversed(alphas)):
            q += s * (a - (y @ q) / (s @ y))
        step, slope = 1.0, float(grad @ q)
        while used < rounds:
            new_value, new_grad = loss(p - step * q)
            used += 1
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = -step * q, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        p, value, grad = p - step * q, new_value, new_grad
    return p


def qualities(model: Model, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Quality of each text and the marginals of its lines."""
    lines = lines_of(texts)
    marginal = forward_backward(model, model.design(lines.x), steps(lines.first))[0][:, 1]
    doc = np.repeat(np.arange(len(texts)), np.diff(lines.first))
    weight = np.where(np.bincount(doc, weights=lines.chars, minlength=len(texts))[doc] > 0, lines.chars, 1.0)
    score = np.bincount(doc, weights=weight * marginal, minlength=len(texts)) / np.bincount(doc, weights=weight, minlength=len(texts))
    return np.round(np.clip(score, 0.0, 1.0), 12), np.split(marginal, lines.first[1:-1])


def batches_of(texts: list[str]):
    """Texts in order, in lists of bounded length."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) + 64
        if size > SCORED_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def quality(model: Model, text: Column, lines: bool = False) -> Column:
    """Quality of a text column; with ``lines`` a struct of the quality and the marginal of every line."""
    root = ROOT

    def run(series: pd.Series):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from tidemark.llm import common, line_crf

        got = [line_crf.qualities(model, part) for part in line_crf.batches_of(["" if t is None else t for t in series])]
        scores = np.concatenate([g[0] for g in got]) if got else np.zeros(0)
        common.give_back()
        if not lines:
            return pd.Series(scores)
        return pd.DataFrame({"score": scores, "lines": [m for g in got for m in g[1]]})

    def plain(series: pd.Series) -> pd.Series:
        return run(series)

    def whole(series: pd.Series) -> pd.DataFrame:
        return run(series)

    return F.pandas_udf(whole, "score double, lines array<double>")(text) if lines else F.pandas_udf(plain, "double")(text)


def train(docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_rows: int = TRAIN_ROWS) -> Model:
    """``learnable`` is a condition on ``labels``; rows are bounded as ``training.labelled`` says."""
    return fit(labelled(docs, labels, learnable, id_col=id_col, text_col=text_col, label_col=label_col, rows=train_rows))


def classify(docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             train_rows: int = TRAIN_ROWS, lines: bool = False) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good), ``predicted`` and, if asked for, ``lines``: each line's marginal."""
    model = train(docs, labels, learnable, id_col=id_col, text_col=text_col, label_col=label_col, train_rows=train_rows)
    keep = [col(c) for c in docs.columns if c.lower() not in ("score", "predicted", "lines")]
    got = quality(model, col(text_col).cast("string"), lines)
    out = docs.select(*keep, got.alias("got_")) if lines else docs.select(*keep, got.alias("score"))
    if lines:
        out = out.select(*keep, "got_.score", "got_.lines")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
