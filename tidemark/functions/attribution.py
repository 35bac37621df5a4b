"""Campaign attribution by ordered rules: the matching rule of the lowest priority number wins."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "else "  # fixed value: target of a row that no rule matches (with the blank)
PARTS = ("utmsource", "utmcampaign", "utmcontent")
GRAM, PIECE, SHORT = 3, 100, 101  # characters of a piece; marks that keep the kinds of keys apart
BUCKETS = 1 << 16  # counts of pieces: a bounded table, whatever the rules
RULE_SCHEMA = "priority int, target string, utm_source string, utm_campaign string, content_match string, match_kind string"


@dataclass(frozen=True)
class Rule:
    """All parts that are given must match; ``kind`` is 'eq' or 'contains' and tells how the content matches."""

    priority: int
    target: str
    source: str | None = None
    campaign: str | None = None
    content: str | None = None
    kind: str = "eq"


Rules = DataFrame | Iterable[Rule]


def rule_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """Rules as a table (priority, target, utm_source, utm_campaign, content_match, match_kind) of any size."""
    if isinstance(rules, DataFrame):
        return rules
    rows = [astuple(r) for r in rules]
    for priority, _, *parts, _ in rows:
        if all(p is None for p in parts):
            raise ValueError(f"rule {priority} has no condition")
    # a list is small: in one partition its index needs no shuffle
    return spark.createDataFrame(rows, RULE_SCHEMA).coalesce(1)


def _grams(text: Column) -> Column:
    """The pieces of three characters of a text, each once; none of a shorter one or of NULL."""
    n = F.coalesce(F.length(text), F.lit(0))
    at = F.when(n >= GRAM, F.sequence(F.lit(1), n - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substr(text, i, F.lit(GRAM))))


def _bucket(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS))


def _rule_index(table: DataFrame) -> DataFrame:
    """Each rule that can win, under one key that every row it matches asks for.

    Of the rules with one and the same condition only the first can win.  A rule of equality is filed under its parts, one of
    containment under the rarest among the rules of the pieces of its text, so that pieces which many rules have lead to few of
    them; one whose text is too short for a piece under SHORT.  Pieces are counted by buckets: the counts are few, however many the
    rules, and every task gets them, so a rule's pieces are looked up and folded where the rule is and never exchanged or sorted.
    """
    parts = ("__r0", "__r1", "__r2")
    shape = sum(F.when(F.col(r).isNotNull(), 1 << i).otherwise(0) for i, r in enumerate(parts))
    by_text = (F.col("__kind") == "contains") & F.col("__r2").isNotNull()
    pieces = _grams(F.col("__r2"))
    often = table.filter(by_text).select(F.explode(pieces).alias("piece")).groupBy(_bucket(F.col("piece")).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = table.filter(shape > 0).groupBy(*parts, "__kind").agg(F.min("__rule").alias("__rule"))
    asked = rules.withColumn("__bucket", F.explode_outer(F.when(by_text, F.transform(pieces, _bucket))))
    # count and bucket in one number: it is folded in place, while a text would have every piece sorted
    rarest = asked.join(F.broadcast(often), "__bucket", "left").groupBy("__rule", *parts, "__kind").agg(
        F.min(F.col("n") * BUCKETS + F.col("__bucket")).alias("__least"))
    piece = F.get(F.filter(pieces, lambda g: _bucket(g) == F.pmod("__least", F.lit(BUCKETS))), F.lit(0))
    filed = F.when(F.col("__least").isNotNull(), F.xxhash64(F.lit(PIECE), piece)).otherwise(F.xxhash64(F.lit(SHORT)))
    return rarest.withColumn("__file", F.when(by_text, filed).otherwise(F.xxhash64(shape, *parts))).drop("__least")


def attributed(rows: DataFrame, rules: Rules, out: str = "video", other: str = OTHER, where: Column | None = None) -> DataFrame:
    """``rows``, which must differ from each other, with their target; rows beside ``where`` ask for nothing.

    Rows should be counted by source, campaign and content (and a day) before, so that the log itself does not pass through
    here.  A row asks the rule index for each of the seven choices of its three parts and for the pieces of its content, in one hash
    join; what it finds is tested, and the lowest priority wins.  A rule without any condition matches nothing.
    """
    table = rule_table(rows.sparkSession, rules).select(
        F.struct("priority", "target").alias("__rule"), F.col("utm_source").alias("__r0"), F.col("utm_campaign").alias("__r1"),
        F.col("content_match").alias("__r2"), F.coalesce("match_kind", F.lit("eq")).alias("__kind"))
    index = _rule_index(table)
    none = F.lit(None).cast("string")
    asked = [F.xxhash64(F.lit(k), *[F.col(p) if k >> i & 1 else none for i, p in enumerate(PARTS)]) for k in range(1, 8)]
    keys = F.concat(F.array(*asked, F.xxhash64(F.lit(SHORT))),
                    F.transform(_grams(F.col("utmcontent")), lambda g: F.xxhash64(F.lit(PIECE), g)))
    long = rows.withColumn("__key", F.explode(keys) if where is None else F.explode_outer(F.when(where, keys)))
    matches = [F.col("__r0").isNull() | (F.col("utmsource") == F.col("__r0")), F.col("__r1").isNull() | (F.col("utmcampaign") == F.col("__r1")),
               F.col("__r2").isNull() | F.when(F.col("__kind") == "contains", F.col("utmcontent").contains(F.col("__r2"))).otherwise(
                   F.col("utmcontent") == F.col("__r2"))]
    same = F.col("__key") == F.col("__file")
    for m in matches:
        same &= F.coalesce(m, F.lit(False))
    found = long.join(index, same, "left").groupBy(*rows.columns).agg(F.min("__rule").alias("__hit"))
    return found.select(*rows.columns, F.coalesce(F.col("__hit")["target"], F.lit(other)).alias(out))
