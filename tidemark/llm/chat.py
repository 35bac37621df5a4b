"""Chat formatting: one rendering of a dialogue for every participant.

For each participant, the whole dialogue is rendered with that speaker as the assistant and all others as named users, and
the mask covers what the assistant says: contents and end marks, as spans of characters.  System turns stay system turns in
every rendering and are never in a mask.

``renderings`` writes each rendering in chunks of ``part_turns`` turns by position.  Every participant has every chunk, also
those in which they are silent; texts joined in the order of ``part`` are the full rendering, and spans count characters from
the start of the full rendering.  The turns are range-sorted and numbered by sums over ranges, the chunks' lengths are summed in
two levels, so no task or array holds a dialogue, whatever its length and turn numbers; only turns that are also equal in
speaker and the first ``PREFIX`` characters are sorted in one task.  The output grows with turns times participants.

Defined results: rows that are equal in dialogue, turn, speaker and text are one turn; turns with the same number stand in
order of speaker and text; a NULL text is empty; a NULL or empty speaker is the user ``unknown`` and has no rendering of its
own; NULL turns stand last; rows without a dialogue id make up one dialogue; an
empty table gives an empty table; extra columns are ignored.  Marks in a text are text: ``<|`` in contents and names is written ``< |``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, stored

#: Fixed marks of the rendering.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
PART_TURNS = 64
#: Characters of a text that ranges are cut by, and chunks that are summed before the dialogue is.
PREFIX, BLOCK_PARTS = 256, 1_024
SYSTEM = ("system",)


def plain(text: Column) -> Column:
    """A text in which no mark can begin."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def head(speaker: Column, assistant: Column, system: tuple[str, ...]) -> Column:
    """The line that opens a turn, as the assistant's rendering shows it."""
    return (F.when(speaker.isin(*system), F.lit(BEGIN + "system\n"))
            .when(speaker == assistant, F.lit(BEGIN + "assistant\n"))
            .otherwise(F.concat(F.lit(BEGIN + "user name="), plain(speaker), F.lit("\n"))))


def said_by(turns: DataFrame, conv_col: str, turn_col: str, speaker_col: str, text_col: str) -> DataFrame:
    """The different turns: ``conv``, ``turn``, ``who``, ``said``."""
    speaker = F.when(F.coalesce(col(speaker_col).cast("string"), F.lit("")) == "", "unknown").otherwise(col(speaker_col).cast("string"))
    return turns.select(col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"), speaker.alias("who"),
                        plain(F.coalesce(col(text_col).cast("string"), F.lit(""))).alias("said")).distinct()


def rendered(parts: DataFrame, system: tuple[str, ...], begin: Column, *keep: str) -> DataFrame:
    """``turns`` as ``speaker`` sees them; spans count from ``begin``."""
    lines = parts.withColumn("lines", F.transform("turns", lambda t: F.struct(
        head(t["who"], F.col("speaker"), system).alias("head"), F.concat(t["said"], F.lit(END)).alias("body"), (t["who"] == F.col("speaker")).alias("mine"))))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, line: Column) -> Column:
        start = (done["at"] + F.length(line["head"])).cast("long")
        end = (start + F.length(line["body"])).cast("long")
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(line["mine"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    mask = F.aggregate("lines", F.struct(begin.cast("long").alias("at"), none.alias("spans")), add, lambda d: d["spans"])
    return lines.select(
        "conv", "part", "speaker", *keep, F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("lines", lambda x: x["mine"])).cast("long").alias("n_spoken"),
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "").alias("text"), mask.alias("mask"))


def numbered(rows: DataFrame, part_turns: int) -> DataFrame:
    """Turns with ``dialogue`` (a number for each ``conv``), ``at`` (turns of the dialogue before it) and ``part``."""
    turn = F.col("turn").asc_nulls_last()
    ranges = rows.repartitionByRange("conv", turn, "who", F.substring("said", 1, PREFIX)).sortWithinPartitions("conv", turn, "who", "said")
    ranges = stored(ranges.select("conv", "who", "said", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("range")), "turns")
    # a row for each dialogue in each range: rows of a dialogue follow one another there
    sums = ranges.groupBy("conv", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv")
    ahead = F.coalesce(F.sum("n").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("conv").alias("its_conv"), F.col("range").alias("its_range"), (F.col("first") - ahead).alias("shift"),
                       F.min("first").over(whole).alias("dialogue"))
    joined = ranges.join(sums, ranges["conv"].eqNullSafe(sums["its_conv"]) & (ranges["range"] == sums["its_range"]))
    at = F.col("row") - F.col("shift")
    return joined.select("dialogue", "conv", "who", "said", at.alias("at"), F.floor(at / part_turns).cast("long").alias("part"))


def begins(turns: DataFrame, system: tuple[str, ...]) -> DataFrame:
    """``dialogue``, ``part``, ``speaker`` and ``begin``, the characters of the speaker's rendering before the part."""
    size = F.length(head(F.col("who"), F.lit(None).cast("string"), system)) + F.length("said") + len(END)
    told = turns.groupBy("dialogue", "part", "who").agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("chars"))
    told = stored(told.withColumn("block", F.floor(F.col("part") / BLOCK_PARTS)), "told")
    parts = told.groupBy("dialogue", "block", "part").agg(F.sum("chars").alias("chars"))
    speakers = told.filter(~F.col("who").isin("unknown", *system)).select("dialogue", F.col("who").alias("speaker")).distinct()
    pairs = told.select("dialogue", "block").distinct().join(speakers, "dialogue")
    mine = told.select("dialogue", "block", "part", F.col("who").alias("speaker"), "n")
    grid = parts.join(pairs, ["dialogue", "block"]).join(mine, ["dialogue", "block", "part", "speaker"], "left")
    # the head of an own turn is another one than others see
    other, own = (F.length(head(F.col("speaker"), a, system)) for a in (F.lit(None).cast("string"), F.col("speaker")))
    grid = grid.withColumn("length", F.col("chars") - F.coalesce("n", F.lit(0)) * (other - own))
    key = ["dialogue", "speaker", "block"]
    ahead = Window.partitionBy("dialogue", "speaker").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = grid.groupBy(*key).agg(F.sum("length").alias("base")).select(*key, F.coalesce(F.sum("base").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return grid.join(base, key).select("dialogue", "part", "speaker", (F.col("base") + F.coalesce(F.sum("length").over(inside), F.lit(0))).alias("begin"))


def renderings(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
               part_turns: int = PART_TURNS, system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """``conv``, ``part``, ``speaker`` (the assistant of this rendering), ``turn_at`` and ``begin`` (turns and characters of the
    rendering before this part), ``n_turns``, ``n_spoken`` (turns of the assistant in the part), ``text`` and ``mask``: an array of
    (start, end) in characters of the whole rendering, ends exclusive."""
    rows = numbered(said_by(turns, conv_col, turn_col, speaker_col, text_col), part_turns)
    parts = rows.groupBy("dialogue", "conv", "part").agg(F.sort_array(F.collect_list(F.struct("at", "who", "said"))).alias("turns"))
    parts = parts.join(begins(rows, system), ["dialogue", "part"]).withColumn("turn_at", F.col("part") * part_turns)
    return rendered(parts, system, F.col("begin"), "turn_at", "begin")


def listed(mask: Column) -> Column:
    """start:end of the spans, joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Whole dialogues rendered in SQL, turn by turn, and cut into parts by position, for ``op6_chat_formatting``.
ORACLE = """
WITH d AS (SELECT DISTINCT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS who,
  replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, who, said) - 1 AS pos FROM d),
p AS (SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who NOT IN ('system', 'unknown')),
l AS (SELECT p.conv_id, t.pos // 64 AS part, t.pos, p.speaker, t.who = p.speaker AS mine,
  '<|im_start|>' || CASE WHEN t.who = 'system' THEN 'system' WHEN t.who = p.speaker THEN 'assistant'
    ELSE 'user name=' || replace(t.who, '<|', '< |') END || chr(10) AS head, t.said || '<|im_end|>' || chr(10) AS body
  FROM p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY pos) AS upto FROM l)
SELECT conv_id, part, speaker, count(*) AS n_turns, count(*) FILTER (mine) AS n_spoken, string_agg(head || body, '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || ':' || CAST(upto AS BIGINT), ',' ORDER BY pos) FILTER (mine), '') AS mask
FROM s GROUP BY conv_id, part, speaker"""
