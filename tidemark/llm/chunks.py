"""Substring dedup by content-defined chunks.

A gear hash of the last 16 bytes rolls over the UTF-8 bytes of a text; where it is less than at all places up to 23 bytes away,
a chunk ends.  A cut depends on the bytes around it and not on the cuts before, so after an insertion the cuts are the same
again a few words later, and a passage gives the same chunks in every text.  Chunks are digested; a digest's first holder is the document with the smallest id, and chunks of other
documents with that digest are repeats.  They are seeds: a chunk and its first place in its first holder are extended to both
sides as far as the two texts are equal, character by character, whatever the cuts.  Stretches that overlap or adjoin make a
span, and spans of at least ``min_words`` words that begin in them count: short lines that many texts share for good reasons stay.
A shorter passage without a single common chunk has no seed.

One row for each chunk (digest, document, place) is exchanged; holders are found by partial minima, and the join of
chunks with digests of several documents is an equi-join.  Holders and first places are written before they are joined, so that Spark
can split the copies of one very common chunk over several tasks.  Adjoining chunks with the same place in the same holder are extended together.  Only the characters around
a stretch's ends are exchanged, ``AROUND`` at first; where all of them are equal, 16 times as many in the next round, until none are.
They are never broadcast: copies compress so well that the size of their file says nothing of the memory they need.

Defined results: NULL and empty texts have no chunks; rows of the same id are one document and no repeats of each
other; with NULL ids, chunks that a document with an id holds are repeats; an empty table gives an empty table; a text of any
length is chunked as a whole; rows of one id with different texts have spans of their own; extra columns are kept by
``without_repeats`` and ignored by ``repeats``."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, in_tasks, let, stored, text_of

#: Bytes that a hash depends on; least and greatest size of a chunk.
WINDOW, LEAST, MOST = 16, 24, 96
#: Passages of fewer words may have no chunk in common (of 30 random words 1 in 400 had none, of 20 one in five), and are not looked for.
MIN_WORDS = 30
AROUND = 96
_GEAR = np.random.default_rng(20_011).integers(0, 1 << 16, 256, dtype=np.uint16)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def rolled(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of G[byte] << age over the last 16 bytes, in 16 bits, by doubling."""
    h = _GEAR[raw]
    step = 1
    while step < WINDOW:
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint16(step)
        h = h + older
        step *= 2
    return h


def cuts(raw: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text: places with the least hash of all that are less than ``LEAST`` bytes away.  No cut inside a
    character.  Where no place cuts for ``MOST`` bytes, as in a text of one word again and again, the last place with the
    least hash does: it, too, depends on the bytes around it alone."""
    n, r = len(raw), LEAST - 1
    if not n:
        return np.zeros(0, dtype=np.int64)
    starts = np.ones(n, dtype=bool)
    starts[:-1] = (raw[1:] & 0xC0) != 0x80
    h = np.where(starts, rolled(raw), 65_535).astype(np.int64)
    # of equal hashes the later place is the lesser number
    number = h << 40 | (1 << 40) - 1 - np.arange(n)
    beyond = np.full(r, np.iinfo(np.int64).max)
    least, size = np.concatenate([beyond, number, beyond]), 1
    while 2 * size <= 2 * r + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[2 * r + 1 - size:][:n])
    marks = np.flatnonzero((least == number) & starts) + 1
    out, last = [], 0
    for mark in [*marks[(marks >= LEAST) & (marks < n)].tolist(), n]:
        while mark - last > MOST:
            # neither part is shorter than LEAST
            a, b = last + r, min(last + MOST, mark - LEAST)
            last = b - int(h[a:b][::-1].argmin())
            out.append(last)
        out.append(mark)
        last = mark
    return np.array(out, dtype=np.int64)


def chunk_rows(batches):
    """(id, version, text) to a row for each chunk: id, version, start and length in characters, words that begin before it and
    in it, digest of 128 bits."""
    import xxhash

    def out(rows, start, length, before, words, high, low, batch):
        rows = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(start)), pa.array(np.concatenate(length)),
            pa.array(np.concatenate(before)), pa.array(np.concatenate(words)),
            pa.array(np.array(high, dtype=np.uint64).view(np.int64)), pa.array(np.array(low, dtype=np.uint64).view(np.int64)),
        ], names=["id", "version", "start", "length", "before", "words", "high", "low"])

    for batch in batches:
        rows, start, length, before, words, high, low = [], [], [], [], [], [], []
        for k, text in enumerate(batch.column(2).to_pylist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            if not data:
                continue
            raw = np.frombuffer(data, dtype=np.uint8)
            ends = cuts(raw)
            begins = np.concatenate([[0], ends[:-1]])
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            blank = _BLANK[raw]
            begun = np.concatenate([[0], np.cumsum(~blank & np.concatenate([[True], blank[:-1]]))])
            rows.append(np.full(len(ends), k)), start.append(chars[begins]), length.append(chars[ends] - chars[begins])
            before.append(begun[begins]), words.append(begun[ends] - begun[begins])
            for a, b in zip(begins.tolist(), ends.tolist()):
                d = xxhash.xxh3_128_intdigest(data[a:b])
                high.append(d >> 64), low.append(d & 0xFFFFFFFFFFFFFFFF)
            if len(high) > 1 << 16:
                yield out(rows, start, length, before, words, high, low, batch)
                rows, start, length, before, words, high, low = [], [], [], [], [], [], []
        if rows:
            yield out(rows, start, length, before, words, high, low, batch)


def surroundings(batches, width: int):
    """(id, version, text, places as a list of (side, at)) to a row for each place: the ``width`` characters before it (side 0) or
    after it (side 1), and one more that shows whether a word begins there."""
    for batch in batches:
        rows, sides, places, found = [], [], [], []
        for k, (text, asked) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            for one in asked:
                side, at = one["side"], one["at"]
                rows.append(k), sides.append(side), places.append(at)
                found.append(text[max(at - 1, 0): at + width] if side else text[max(at - width - 1, 0): at])
                if len(found) > 1 << 14:
                    yield _around(batch, rows, sides, places, found)
                    rows, sides, places, found = [], [], [], []
        if rows:
            yield _around(batch, rows, sides, places, found)


def _around(batch, rows, sides, places, found):
    rows = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sides, pa.int32()), pa.array(places, pa.int64()),
                                       pa.array(found, pa.string())], names=["id", "version", "side", "at", "around"])


def equal_ends(a: str, b: str, most: int, side: int) -> int:
    """Characters at the ends (side 0) or beginnings (side 1) of two texts that are equal, up to ``most``."""
    low, high = 0, min(len(a), len(b), most)
    while low < high:
        k = (low + high + 1) // 2
        if (a[:k] == b[:k]) if side else (a[len(a) - k:] == b[len(b) - k:]):
            low = k
        else:
            high = k - 1
    return low


def grown(batches, side: int, width: int):
    """Adds ``more`` (equal characters on this side), ``told`` (words that begin in them) and ``open`` (all ``width`` are equal)
    in place of the two texts, the last two columns."""
    blank = " \t\n\x0b\x0c\r"
    for batch in batches:
        more, told = [], []
        for own, their in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            n = equal_ends(own[1:], their[1:], width, 1) if side else equal_ends(own, their, width, 0)
            piece = own[: n + 1] if side else own[max(len(own) - n - 1, 0):]
            first = 1 if side or len(own) > n else 0  # 0: the text begins there
            more.append(n)
            told.append(sum(piece[i] not in blank and (i == 0 or piece[i - 1] in blank) for i in range(first, len(piece))))
        kept = [batch.column(i) for i in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(more, pa.int64()), pa.array(told, pa.int64()), pa.array([n == width for n in more], pa.bool_())],
                                         names=[*batch.schema.names[:-2], "more", "told", "open"])


def joined_up(batches):
    """(id, version, lo, hi, lo_words, hi_words, seed_lo, seed_hi, first) in order of id, version and lo, to a row for each span of
    stretches that overlap or adjoin: id, version, start, length, words, first_ids."""
    key, held, ids, out = None, [], None, []

    def row():
        lo, hi = min(h[0] for h in held), max(h[1] for h in held)
        return ids, key[1], lo, hi - lo, max(h[3] for h in held) - min(h[2] for h in held), sorted({h[6] for h in held})

    def rows():
        nonlocal held
        every, held = counted(held), []
        for stretch in sorted(every):
            if held and stretch[0] > max_hi:
                yield row()
                held = []
            max_hi = max(max_hi, stretch[1]) if held else stretch[1]
            held.append(stretch)
        yield row()
        held = []

    def batch_of(rows, kind):
        columns = list(zip(*rows)) or [()] * 6
        kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(kind)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "version", "start", "length", "words", "first_ids"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for id_, version, *stretch in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (key != (id_, version) or stretch[0] > reach):
                out.extend(rows())
            reach = max(reach, stretch[1]) if held else stretch[1]
            key, ids = (id_, version), id_
            held.append(stretch)
        yield batch_of(out, kind)
        out = []
    if held:
        yield batch_of(list(rows()), kind)


def counted(held: list) -> list:
    """Without the stretches whose seed is in stretches of earlier holders and that add no whole word to those."""
    if len({h[6] for h in held}) == 1:
        return held
    places = sorted({p for h in held for p in (h[0], h[1], h[4], h[5])})
    by_start, heap, earliest, k = sorted(held, key=lambda h: h[0]), [], [], 0
    for p in places:
        while k < len(by_start) and by_start[k][0] <= p:
            heappush(heap, (by_start[k][6], by_start[k][1]))
            k += 1
        while heap and heap[0][1] <= p:
            heappop(heap)
        earliest.append(heap[0][0] if heap else None)
    out, others = [], []
    for h in held:
        own = h[6] in earliest[bisect_left(places, h[4]): bisect_left(places, h[5])]
        (out if own else others).append(h)
    # what has own seeds, joined up: start, end, words before both
    joined: list[list] = []
    for h in sorted(out):
        if joined and h[0] <= joined[-1][1]:
            joined[-1][1], joined[-1][3] = max(joined[-1][1], h[1]), max(joined[-1][3], h[3])
        else:
            joined.append(list(h[:4]))
    begins = [j[0] for j in joined]
    for h in others:
        at = bisect_right(begins, h[4]) - 1
        inside = at >= 0 and joined[at][1] >= h[5]
        # the last word that begins on the right may be a part of one
        if not inside or joined[at][2] > h[2] or h[3] > joined[at][3] + 1:
            out.append(h)
    return out


def extended(texts: DataFrame, seeds: DataFrame, width: int) -> DataFrame:
    """``seeds`` with ``lo``, ``hi`` and their words moved outwards by up to ``width`` equal characters, and ``open``."""
    ends = [(0, "lo"), (1, "hi")]
    asked = [seeds.select(F.col(i).alias("id"), F.col(v).alias("version"), F.lit(side).alias("side"), (F.col(end) + shift).alias("at"))
             for side, end in ends for i, v, shift in (("id", "version", F.lit(0)), ("first", "first_version", F.col("shift")))]
    places = asked[0].union(asked[1]).union(asked[2]).union(asked[3]).distinct()
    # at most two places for each chunk of a text
    places = places.groupBy(F.col("id").alias("p_id"), F.col("version").alias("p_version")).agg(F.collect_list(F.struct("side", "at")).alias("places"))
    found = texts.join(places, texts["id"].eqNullSafe(places["p_id"]) & (texts["version"] == places["p_version"])).select("id", "version", "text", "places")
    kind = texts.schema["id"].dataType.simpleString()
    found = found.mapInArrow(in_tasks(surroundings, width=width), f"id {kind}, version long, side int, at long, around string")
    found = stored(found, "around")
    out = seeds.withColumn("open", F.lit(False))
    for side, end in ends:
        here = found.filter(F.col("side") == side).dropDuplicates(["id", "version", "at"])
        own = here.select(F.col("id").alias("o_id"), F.col("version").alias("o_version"), F.col("at").alias("o_at"), F.col("around").alias("own"))
        their = here.select(F.col("id").alias("first"), F.col("version").alias("first_version"), F.col("at").alias("t_at"), F.col("around").alias("their"))
        # a small file may hold many texts that are alike: they must not meet in the driver, which a broadcast goes through
        both = out.join(own.hint("merge"), F.col("id").eqNullSafe(F.col("o_id")) & (F.col("version") == F.col("o_version")) & (F.col(end) == F.col("o_at")))
        both = both.withColumn("t_at", F.col(end) + F.col("shift")).join(their.hint("merge"), ["first", "first_version", "t_at"])
        both = both.select(*[c for c in out.columns if c != "open"], F.col("open").alias("was_open"), "own", "their")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema.fields[:-2]) + ", more long, told long, open boolean"
        sign = 1 if side else -1
        both = both.mapInArrow(in_tasks(grown, side=side, width=width), schema)
        out = both.withColumn(end, F.col(end) + sign * F.col("more")).withColumn(f"{end}_words", F.col(f"{end}_words") + sign * F.col("told")).withColumn(
            "open", F.col("open") | F.col("was_open")).select(*out.columns)
    return out


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each span that repeats an earlier document: ``id_col`` and ``text_hash`` (of the text that it stands in), ``start``
    and ``length`` in characters, ``words`` and ``first_ids``, the documents that hold its chunks first (a chunk in a stretch of an earlier holder is that one's, unless
    its own stretch goes on for a whole word)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col).cast("string")).alias("version"), col(text_col).cast("string").alias("text"))
    chunks = stored(rows.mapInArrow(in_tasks(chunk_rows), f"id {kind}, version long, start long, length long, before long, words long, high long, low long"), "chunks")
    holders = chunks.groupBy("high", "low").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("nameless"))
    holders = stored(holders.filter("first <> last or (nameless and first is not null)").select("high", "low", "first"), "holders")
    held = stored(chunks.join(holders, ["high", "low"]), "held")
    places = stored(held.filter("id = first").groupBy("high", "low").agg(F.min(F.struct("version", "start")).alias("place")), "first-places")
    twice = held.filter(F.col("id").isNull() | (F.col("id") != F.col("first"))).join(places, ["high", "low"])
    twice = twice.select("id", "version", "start", "length", "before", "words", "first", F.col("place.version").alias("first_version"),
                         (F.col("place.start") - F.col("start")).alias("shift")).distinct()
    # runs of chunks that adjoin, inside one document
    order = Window.partitionBy("id", "version").orderBy("start")
    opens = F.coalesce(F.lag(F.col("start") + F.col("length")).over(order) != F.col("start"), F.lit(True))
    runs = twice.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(order))
    seeds = runs.groupBy("id", "version", "run", "first", "first_version", "shift").agg(
        F.min("start").alias("lo"), F.max(F.col("start") + F.col("length")).alias("hi"),
        F.min("before").alias("lo_words"), F.max(F.col("before") + F.col("words")).alias("hi_words")).drop("run")
    seeds = seeds.withColumn("seed_lo", F.col("lo")).withColumn("seed_hi", F.col("hi"))
    width, parts = AROUND, []
    seeds = stored(seeds, "seeds")
    while True:
        got = stored(extended(rows, seeds, width), "extended")
        parts.append(got.filter(~F.col("open")))
        seeds = got.filter("open").drop("open")
        if seeds.isEmpty():
            break
        width *= 16
    stretches = parts[0]
    for one in parts[1:]:
        stretches = stretches.union(one)
    stretches = stretches.select("id", "version", "lo", "hi", "lo_words", "hi_words", "seed_lo", "seed_hi", "first")
    stretches = stretches.repartition("id", "version").sortWithinPartitions("id", "version", "lo", "hi")
    spans = stretches.mapInArrow(in_tasks(joined_up), f"id {kind}, version long, start long, length long, words long, first_ids array<{kind}>")
    return spans.filter(F.col("words") >= min_words).select(F.col("id").alias(id_col), F.col("version").alias("text_hash"), "start", "length", "words", "first_ids")


def without_repeats(docs: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of their texts."""
    key, of, cut, mine = fresh(docs, "key_", "of_", "cut_", "mine_")
    found = spans.groupBy(col(id_col).alias(key), F.col("text_hash").alias(of)).agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias(cut))
    rows = docs.withColumn(mine, F.xxhash64(col(text_col).cast("string")))
    joined = rows.join(found, rows[id_col].eqNullSafe(found[key]) & (rows[mine] == found[of]), "left")
    text = text_of(text_col)

    def rest(parts: Column) -> Column:
        def end(i: Column) -> Column:
            return F.coalesce(F.get(parts, i)["start"] + F.get(parts, i)["length"], F.lit(0).cast("long")).cast("int")

        kept = F.transform(parts, lambda p, i: F.substring(text, end(i - 1) + 1, p["start"].cast("int") - end(i - 1)))
        return F.concat(F.array_join(kept, ""), F.substring(text, end(F.size(parts) - 1) + 1, F.length(text)))

    return joined.withColumn(text_col, F.when(col(cut).isNull(), col(text_col)).otherwise(let(col(cut), rest))).select(
        *[joined[c] if c != text_col else col(text_col) for c in docs.columns])
