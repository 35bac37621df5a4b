"""Quality rules as a short-circuit cascade.

The base figures of a text are part of the result and computed for every row.  Beyond them, each rule has an
expression that rejects and an expression for its work (characters or elements it touches, times the cost of one).
On a sample, rows are grouped by the set of rules that reject them; from these counts and the mean work, the rules
are ordered greedily by rejections per cost among the rows that no earlier rule has rejected.  The cascade is one
CASE: a later rule is only evaluated where all earlier ones pass.  The order changes the cost, never a verdict.

Built from Spark's own functions only; no shuffle but that of the sample's counts.  A text of n words needs memory
for a few arrays of n elements.

Defined results: a NULL text is empty, has no words and fails; repeated rows are judged alike; an empty table gives an
empty table; extra columns are kept unless they have the name of a result column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS, col, fresh, text_of, words_of

SYMBOLS = "[#*$%&|<>]"
#: Rows whose rules are tried out to order them: about so many.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """``rejects`` and ``work`` are functions of the columns by name (text, words, n_words, word_chars, ...)."""

    name: str
    rejects: object
    work: object


def count_of(text: Column, pattern: str) -> Column:
    """How many times a pattern of one character occurs."""
    return (F.size(F.split(text, pattern)) - 1).cast("long")


#: Public heuristics for web text; bounds far beyond what prose shows.  One unit of work: one character scanned.
RULES = (
    Rule("symbols", lambda c: 10 * c["n_symbols"] > c["n_words"], lambda c: F.lit(1.0)),
    Rule("word_length", lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"]), lambda c: F.lit(1.0)),
    Rule("repeated_lines", lambda c: 2 * c["n_dup_lines"] > c["n_lines"], lambda c: F.lit(1.0)),
    Rule("shouting", lambda c: 5 * count_of(c["text"], r"\p{Lu}") > 2 * count_of(c["text"], r"\p{L}"), lambda c: 2.5 * F.length(c["text"])),
    Rule("exclamations", lambda c: 2 * count_of(c["text"], "!") > c["n_words"], lambda c: 1.0 * F.length(c["text"])),
    Rule("digits", lambda c: 2 * count_of(c["text"], "[0-9]") > c["word_chars"], lambda c: 1.2 * F.length(c["text"])),
    Rule("no_letters", lambda c: 10 * F.size(F.filter(c["words"], lambda w: ~w.rlike(r"\p{L}"))) > 4 * c["n_words"],
         lambda c: 1.5 * F.length(c["text"]) + 12 * c["n_words"]),
)


def shift_left(number: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", number, bits)


def shift_right(number: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", number, bits)


def windows(words: Column, n: Column, bits: Column) -> Column:
    """Sorted array with one number for each 3-word window: its hash above, its position in the low ``bits``."""
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(at, lambda i: shift_left(F.xxhash64(words[i], words[i + 1], words[i + 2]), bits).bitwiseOR(i.cast("long"))))


def figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column of the base figures and what the rules read; its name is the second result."""
    text, words, lines, n, bits, wins, again = fresh(docs, "text_", "words_", "lines_", "n_", "bits_", "wins_", "again_")
    docs = docs.drop(*(c for c in docs.columns if c.lower() in FIGURES))
    df = docs.withColumn(text, text_of(text_col))
    df = df.withColumn(words, words_of(col(text))).withColumn(
        lines, F.filter(F.split(col(text), "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != ""))
    df = df.withColumn(n, F.size(words))
    df = df.withColumn(bits, F.ceil(F.log2(col(n) + 2)).cast("int"))
    df = df.withColumn(wins, windows(col(words), col(n), col(bits)))

    def same(a: Column, b: Column) -> Column:
        """The two windows have equal words; the hashes are compared first."""
        i, j = (F.when(b.isNotNull(), x.bitwiseAND(shift_left(F.lit(1).cast("long"), col(bits)) - 1)).cast("int") for x in (a, b))
        equal = shift_right(a, col(bits)) == shift_right(b, col(bits))
        for k in range(3):
            equal &= F.get(col(words), i + k) == F.get(col(words), j + k)
        return F.coalesce(equal, F.lit(False))

    found = F.filter(col(wins), lambda x, k: same(x, F.get(col(wins), k + 1)) | same(x, F.get(col(wins), k - 1)))
    low = shift_left(F.lit(1).cast("long"), col(bits)) - 1
    df = df.withColumn(again, F.sort_array(F.transform(found, lambda x: x.bitwiseAND(low))))
    covered = F.aggregate(F.transform(col(again), lambda x, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(col(again), k + 1) - x, F.lit(3).cast("long")))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    # The figures come out of a generator of one row: a later filter on them is not pushed below, where Spark would
    # put their whole expressions in place of the names, once for each element of an array.
    return df.select(*map(col, docs.columns), text, words, F.inline(F.array(F.struct(
        F.size(lines).cast("long").alias(lines), col(n).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"), count_of(col(text), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), covered.alias("n_repeat_words"),
    )))), {"text": text, "words": words, "n_lines": lines}


def ordered(df: DataFrame, names: dict[str, str], id_col: str, rules: tuple[Rule, ...], sample_rows: int, rows: int) -> list[tuple[Rule, float, float]]:
    """Rules by rejections per cost, each with the share it rejects (of what reaches it) and its mean work."""
    c = {k: col(v) for k, v in names.items()} | {k: col(k) for k in FIGURES}
    every = max(1, rows // sample_rows)
    seen = df.filter(F.pmod(F.xxhash64(col(id_col).cast("string")), F.lit(every)) == 0)
    mask = F.when(~col("base_failed"), sum((F.when(r.rejects(c), F.lit(1 << i)).otherwise(0) for i, r in enumerate(rules)), F.lit(0)))
    got = seen.select(mask.alias("mask"), *[r.work(c).alias(f"w{i}") for i, r in enumerate(rules)]).groupBy("mask").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(rules))]).collect()  # a row for each set of rules at most
    got = [g for g in got if g["mask"] is not None]
    total = max(1, sum(g["n"] for g in got))
    cost = [max(1e-9, sum(g[f"w{i}"] for g in got) / total) for i in range(len(rules))]
    left, out, open_rules = [(g["mask"], g["n"]) for g in got], [], list(range(len(rules)))
    while open_rules:
        reach = max(1, sum(n for _, n in left))
        share = {i: sum(n for m, n in left if m >> i & 1) / reach for i in open_rules}
        best = max(open_rules, key=lambda i: (share[i] / cost[i], -cost[i], -i))
        out.append((rules[best], share[best], cost[best]))
        open_rules.remove(best)
        left = [(m, n) for m, n in left if not m >> best & 1]
    return out


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the base figures, ``base_failed``, ``kept`` and ``rejected_by``: the first rule of the cascade that
    rejects (``base`` for the base, NULL where kept).  The ids only choose the sample."""
    results = (*FIGURES, "base_failed", "kept", "rejected_by")
    keep = [c for c in docs.columns if c.lower() not in results or c in (id_col, text_col)]
    df, names = figures(docs.select(*map(col, keep)), text_col)
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    order = ordered(df, names, id_col, rules, sample_rows, docs.count())
    c = {k: col(v) for k, v in names.items()} | {k: col(k) for k in FIGURES}
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule, _, _ in order:
        verdict = verdict.when(rule.rejects(c), F.lit(rule.name))
    df = df.withColumn("rejected_by", verdict)
    return df.select(*map(col, keep), *FIGURES, "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")


#: The figures and verdicts in SQL, rule by rule, for ``op2_quality_rules``.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  [l for l in string_split(t, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT r, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) AS three,
  unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
c AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, three) > 1),
n AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM c) x GROUP BY r),
f AS (SELECT doc_id, t, ws, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines FROM w LEFT JOIN n USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines
    OR 5 * len(regexp_extract_all(t, '\p{Lu}')) > 2 * len(regexp_extract_all(t, '\p{L}')) OR 2 * len(regexp_extract_all(t, '!')) > n_words
    OR 2 * len(regexp_extract_all(t, '[0-9]')) > word_chars OR 10 * len([x for x in ws if NOT regexp_matches(x, '\p{L}')]) > 4 * n_words) AS kept
FROM b"""
