"""Mixing sources to target weights.

Each source is cut into blocks by a hash of its rows.  A source takes whole passes over its blocks and, for the
rest of its target, the first blocks of one more pass in a permuted order; the last of these blocks is cut at a row, which is
taken whole or not at all, whatever is nearer: a source misses its target by half a document at most.  The blocks to draw are
dealt to the output shards by a splitting tree: a random permutation of all draws is halved again and again, which
gives every node an exact number of blocks and a multivariate hypergeometric number of each source.  Shards draw
disjoint blocks and shuffle their rows locally.

Only counts per (source, block) are ever shuffled; ranks and running sums have two levels, so no task gets all
blocks of a source.  Per source there is one row, and these rows alone meet in one task.

Defined results: a NULL text has size 0; NULL is a source of its own, the last; a document without words takes 0 and
is drawn nowhere; repeated rows of one id and source are separate documents, which are drawn alike (those at the cut count as one
there); an empty table gives an empty table; extra columns are kept unless they have the name of a result column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, running_sum, stored, text_of, words_of

WEIGHTS = (1.0, 2.0, 3.0)
#: Words of a shard, and the fewest shards.
SHARD_WORDS, LEAST_SHARDS = 1 << 22, 64
RESULTS = ("size", "source_size", "target", "taken", "draws")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """``target`` for each row of ``(src, source_size)``: sources in code-point order, NULL last, weigh ``weights`` in
    turn and share the sum of all sizes; a target stops at ``cap`` times its size and the excess is shared by weight
    among the rest until none is above.  Closed form: with the sources by cap per weight, the first k are capped."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("src").isNull(), "src")
    ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("src").isNull(), "src")
    upto, after = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / F.sum("w").over(after)
    return (
        sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int")))
        .withColumn("most", cap * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("w"))
        .withColumn("level", level)
        # the share of one unit of weight: that of the first source which its share does not fill
        .withColumn("share", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(
            ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("src", "source_size", F.coalesce(F.least("most", F.col("share") * F.col("w")), "most").alias("target"))
    )


def plan(rows: DataFrame, seed: int, weights: tuple[float, ...], cap: float, shards: int) -> DataFrame:
    """Of the blocks ``(src, block, words)``: size and target of the source, the draws of the block and, for the block
    that is cut, ``room``, the words it may still give.  A draw is (copy, shard); a cut block's last draw is partial."""
    blocks = rows.groupBy("src", "block").agg(F.sum("size").alias("words"))
    blocks = stored(blocks.withColumn("key", F.xxhash64(F.lit(seed), F.lit("block"), "src", "block")), "blocks")
    goal = targets(blocks.groupBy("src").agg(F.sum("words").alias("source_size")), weights, cap)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("passes", passes.cast("long")).withColumn(
        "rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    goal = goal.withColumnRenamed("src", "goal_src")
    drawn = running_sum(blocks, ["src"], "key", "words", "before")
    drawn = drawn.join(goal, drawn["src"].eqNullSafe(goal["goal_src"])).drop("goal_src")
    room = F.when(F.col("words") == 0, 0).otherwise(F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), "words"))
    drawn = drawn.withColumn("room", room.cast("long"))
    draws = F.col("passes") + (F.col("room") > 0).cast("long")
    units = drawn.select("src", "block", F.explode(F.when((draws > 0) & (F.col("words") > 0), F.sequence(F.lit(1).cast("long"), draws))).alias("copy"))
    units = stored(units.withColumn("key", F.xxhash64(F.lit(seed), F.lit("unit"), "src", "block", "copy")).withColumn("one", F.lit(1)), "draws")
    total = units.count()
    ranked = running_sum(units, [], "key", "one", "rank")
    dealt = ranked.groupBy("src", "block").agg(F.sort_array(F.collect_list(F.struct(
        "copy", F.floor(F.col("rank") * F.lit(shards) / F.lit(max(total, 1))).cast("int").alias("shard")))).alias("draws"))
    dealt = dealt.select(F.col("src").alias("d_src"), F.col("block").alias("d_block"), "draws")
    return drawn.join(dealt, drawn["src"].eqNullSafe(dealt["d_src"]) & (drawn["block"] == dealt["d_block"]), "left").select(
        "src", "block", "source_size", "target", "words", "room", "draws")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
        cap: float = 3.0, shards: int | None = None, block_words: int = 1 << 18, seed: int = 17) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``draws``:
    an array of (copy, shard, words), one for each time the mix takes the document.  ``block_words`` is the size that
    a block would have if there were one source; smaller sources have smaller blocks.  Without a number of ``shards``, each has
    about ``SHARD_WORDS`` words."""
    # the row travels as one column, so that no name of it meets one of the plan's
    rows = docs.select(
        F.struct(*map(col, docs.columns)).alias("doc"), col(source_col).cast("string").alias("src"), col(id_col).alias("id"),
        F.xxhash64(F.lit(seed), col(source_col), col(id_col)).alias("h"), F.size(words_of(text_of(text_col))).cast("long").alias("size"))
    small = stored(rows.select("src", "id", "h", "size"), "sizes")
    total = small.agg(F.sum("size")).first()[0] or 0
    bits = min(40, max(1, math.ceil(math.log2(max(2, total / block_words)))))
    small = small.withColumn("block", F.shiftrightunsigned("h", 64 - bits))
    blocks = stored(plan(small, seed, weights, cap, shards or max(LEAST_SHARDS, -(-total // SHARD_WORDS))), "plan")
    # the row at which a cut block ends: rows by hash, equal ones together
    cut = blocks.filter((F.col("room") > 0) & (F.col("room") < F.col("words"))).select(F.col("src").alias("c_src"), F.col("block").alias("c_block"), "room")
    inside = small.filter("size > 0").join(cut, small["src"].eqNullSafe(cut["c_src"]) & (small["block"] == cut["c_block"])).groupBy(
        "c_src", "c_block", "room", "h", F.col("id").alias("cut_id")).agg(F.sum("size").alias("has"))
    inside = inside.withColumn("upto", F.sum("has").over(Window.partitionBy("c_src", "c_block").orderBy("h", F.col("cut_id"))))
    ends = inside.filter((F.col("upto") >= F.col("room")) & (F.col("upto") - F.col("has") < F.col("room"))).select(
        "c_src", "c_block", F.col("h").alias("cut_h"), "cut_id", (2 * (F.col("room") - F.col("upto") + F.col("has")) >= F.col("has")).alias("taken_whole"))
    full = blocks.join(ends, blocks["src"].eqNullSafe(ends["c_src"]) & (blocks["block"] == ends["c_block"]), "left").select(
        F.col("src").alias("p_src"), F.col("block").alias("p_block"), "source_size", "target", F.col("draws").alias("p_draws"), "words", "room",
        "cut_h", "cut_id", "taken_whole")
    rows = rows.withColumn("block", F.shiftrightunsigned("h", 64 - bits))
    joined = rows.join(full, rows["src"].eqNullSafe(full["p_src"]) & (rows["block"] == full["p_block"]))
    before = (F.col("h") < F.col("cut_h")) | ((F.col("h") == F.col("cut_h")) & (F.col("id") < F.col("cut_id")))
    at = (F.col("h") == F.col("cut_h")) & F.col("id").eqNullSafe(F.col("cut_id"))
    # of a draw that is the last and partial
    last = (F.col("room") == 0) | (F.col("room") == F.col("words")) | F.coalesce(before, F.lit(False)) | F.coalesce(at & F.col("taken_whole"), F.lit(False))
    every = F.coalesce(F.col("p_draws"), F.array().cast("array<struct<copy:bigint,shard:int>>"))
    draws = F.transform(F.filter(every, lambda d, i: (F.col("size") > 0) & ((i + 1 < F.size("p_draws")) | last)), lambda d: F.struct(
        d["copy"].alias("copy"), d["shard"].alias("shard"), F.col("size").alias("words")))
    out = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in RESULTS]
    # names of the documents' columns come in a step of their own, so that nothing above can mean one of them
    mixed = joined.select("doc", "size", "source_size", "target", draws.alias("draws"))
    return mixed.select(*out, "size", "source_size", "target", "draws", (F.size("draws") * F.col("size")).alias("taken"))


def shards_of(mixed: DataFrame, id_col: str = "doc_id", seed: int = 17) -> DataFrame:
    """The mix itself: a row for each draw, whole texts, dealt by shard and shuffled inside it; with ``shard``, ``copy`` and
    ``words`` (in place of columns of these names).  A hot shard does not exist: all have as many blocks."""
    d, order = fresh(mixed, "draw", "order")
    rows = mixed.withColumn(d, F.explode("draws")).withColumns({f: col(d)[f] for f in ("shard", "copy", "words")})
    rows = rows.withColumn(order, F.xxhash64(F.lit(seed), F.lit("row"), "copy", col(id_col)))
    return rows.repartition("shard").sortWithinPartitions("shard", order).drop(d, order, "draws")
