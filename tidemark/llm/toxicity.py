"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a fixed list of insults and of a learned lexicon (whole words and word beginnings that
labelled toxic texts have far more often than others), how near hits stand to a second-person word, capitals,
punctuation, exclamation and obfuscation rates (words that mix letters with digits or signs, and those that turn into
an insult when the signs are read as letters).  Spark's own trees are fitted on most of the learnable rows and their margin
is mapped to a probability on the others, so the score is calibrated on rows the trees have not seen.

Training reads at most ``train_rows`` labelled rows, chosen by a hash of their ids; scoring covers every word of every
text, of any length.  The lexicon has every term of these rows that reaches the odds, so it is bounded by them and travels
with the function.

Defined results: a NULL text is empty and has only zeros as features; labels other than 0 and 1 and NULL ids are not learned
from; without labels of both kinds every score is the share of toxic labels (0 without any); repeated rows score alike; an
empty table gives an empty table; extra columns are kept, unless they have the name of a result column."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROOT, col, stored
from tidemark.llm.training import labelled

TRAIN_ROWS = 12_000
#: Words of more characters are looked at each time they come.
KEPT_CHARS = 200
#: A learned term is in at least so many toxic texts and so many times likelier there.
MIN_TOXIC, MIN_ODDS = 4, 8.0
#: Fixed list: insults of everyday use in the four languages of the corpus.
INSULTS = frozenset("""
idiot moron stupid dumb scum trash loser pathetic worthless disgusting clown fool imbecile jerk pig garbage filth vermin
idiote stupide imbécile crétin ordure débile minable dégoûtant
trottel dumm dummkopf arschloch abschaum müll versager erbärmlich wertlos widerlich
estúpido imbécil basura escoria perdedor patético asqueroso payaso
""".split())
#: Fixed list: second-person words of the same languages.
SECOND = frozenset("you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine euch ihr tú ti usted ustedes vosotros su".split())
#: Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
STEMS = (4, 5, 6, 7)
NEAR = 5
N_FEATURES = 13


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bare(word: str) -> str:
    return word.strip(".,;:!?()[]{}\"'<>|*#$%&")


def terms_of(text: str) -> set[str]:
    """Whole words, and beginnings of words with a star behind."""
    words = {bare(w) for w in set(words_of(text))}
    words.discard("")
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms of toxic texts with their log odds; ``rows`` has text and toxic.  Counted in parts, then summed."""
    root = ROOT

    def count(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from tidemark.llm import toxicity

        for batch in batches:
            yield toxicity.counted(batch)

    totals = rows.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    if not n.get(0) or not n.get(1):
        return {}
    terms = rows.select("text", "toxic").mapInPandas(count, "term string, pos long, neg long").groupBy("term").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(F.col("pos") >= MIN_TOXIC)
    odds = F.log((F.col("pos") + 0.5) / (n[1] + 1.0)) - F.log((F.col("neg") + 0.5) / (n[0] + 1.0))
    best = terms.withColumn("odds", odds).filter(F.col("odds") >= float(np.log(MIN_ODDS)))
    return {r["term"]: float(r["odds"]) for r in best.collect()}


def counted(batch: pd.DataFrame) -> pd.DataFrame:
    pos, neg = Counter(), Counter()
    for text, toxic in zip(batch["text"], batch["toxic"]):
        (pos if toxic else neg).update(terms_of(text))
    terms = list(pos.keys() | neg.keys())
    return pd.DataFrame({"term": terms, "pos": [pos[t] for t in terms], "neg": [neg[t] for t in terms]}).astype({"pos": "int64", "neg": "int64"})


class Reader:
    """Features of texts with a lexicon; what it finds out about a word is kept, within bounds."""

    def __init__(self, learned: dict[str, float]):
        self.learned = learned
        self.known: dict[str, tuple] = {}

    def look(self, raw: str) -> tuple:
        """(insult, learned odds, second person, obfuscated, obfuscated insult) of a word as it stands."""
        word = bare(raw)
        odds = self.learned.get(word, 0.0)
        for k in STEMS:
            if len(word) > k:
                odds = max(odds, self.learned.get(word[:k] + "*", 0.0))
        mixed = any(c.isalpha() for c in word) and any(c in "0134578@$!*" for c in word)
        plain = word.translate(SIGNS) if mixed else word
        hidden = mixed and (plain in INSULTS or self.learned.get(plain, 0.0) > 0)
        return (word in INSULTS, odds, word in SECOND, mixed, hidden)

    def features(self, text: str) -> list[float]:
        words = words_of(text)
        if not words:
            return [0.0] * N_FEATURES
        known = self.known
        if len(known) > 400_000:
            known.clear()
        hits, second, insults, obfuscated, hidden, odds = [], [], 0, 0, 0, 0.0
        for i, w in enumerate(words):
            seen = known.get(w)
            if seen is None:
                seen = self.look(w)
                seen = seen if any(seen) else False
                if len(w) < KEPT_CHARS:
                    known[w] = seen
            if seen:
                if seen[0] or seen[1] or seen[4]:
                    hits.append(i)
                    insults += seen[0]
                    odds += seen[1]
                    hidden += seen[4]
                if seen[2]:
                    second.append(i)
                obfuscated += seen[3]
        near = 0
        if hits and second:
            at = np.searchsorted(second, hits)
            s = np.array(second)
            gap = np.minimum(np.abs(s[np.minimum(at, len(s) - 1)] - hits), np.abs(s[np.maximum(at - 1, 0)] - hits))
            near = int((gap <= NEAR).sum())
        n, raw = len(words), len(text)
        capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        signs = sum(map(text.count, ".,;:?!"))
        return [100.0 * insults / n, float(insults), 100.0 * len(hits) / n, float(len(hits)), odds / n * 100, odds, near, 100.0 * len(second) / n,
                capitals / raw, signs / raw, text.count("!") / raw, 100.0 * obfuscated / n, float(hidden)]


def features(text: Column, learned: dict[str, float]) -> Column:
    root = ROOT

    def run(series: pd.Series) -> pd.Series:
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from tidemark.llm import toxicity

        reader = toxicity.Reader(learned)
        return pd.Series([reader.features("" if t is None else t) for t in series])

    return array_to_vector(F.pandas_udf(run, "array<double>")(text))


@dataclass
class Model:
    learned: dict[str, float]
    trees: object
    calibration: object
    share: float


def train(docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS) -> Model:
    """``learnable`` is a condition on ``labels``; rows are bounded as ``training.labelled`` says."""
    rows = labelled(docs, labels, learnable, id_col=id_col, text_col=text_col, label_col=label_col, rows=train_rows)
    rows = rows.select("text", F.col("label").alias("toxic"), "h")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    # a quarter for the calibration; the lexicon is learned from the rows of the trees alone
    fold = F.pmod(F.shiftright("h", 7), F.lit(4)) == 0
    learned = lexicon(rows.filter(~fold))
    known = stored(rows.select("h", F.col("toxic").cast("double").alias("label"), vector_to_array(features(F.col("text"), learned)).alias("f")), "toxic-features")
    known = known.select("h", "label", array_to_vector("f").alias("features"))
    parts = [{r["label"]: r["count"] for r in known.filter(c).groupBy("label").count().collect()} for c in (~fold, fold)]
    if any(len(p) < 2 for p in parts):
        return Model(learned, None, None, share)
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, minInstancesPerNode=5, seed=3).fit(known.filter(~fold))
    margins = trees.transform(known.filter(fold)).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    return Model(learned, trees, IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins), share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic) and ``predicted``."""
    keep = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    if model.trees is None:
        out = docs.select(*map(col, keep), F.lit(model.share).alias("score"))
    else:
        # names of the ML columns cannot clash: the row travels as one struct
        row = docs.select(F.struct(*map(col, keep)).alias("row_"), features(col(text_col).cast("string"), model.learned).alias("features"))
        got = model.trees.transform(row).select("row_", vector_to_array("rawPrediction")[1].alias("margin"))
        got = model.calibration.transform(got)
        out = got.select(*[F.col("row_").getField(c).alias(c) for c in keep], F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, learnable, id_col=id_col, text_col=text_col, label_col=label_col, train_rows=train_rows), text_col)
