"""Phrase collocations, counted in quotient filters.

Words get ids of ``width`` bits: the first bits of a hash whose seed is chosen so that no two words that may stand in a phrase
share an id (this is verified for the corpus, by language).  So a phrase of n words is a number of n * ``width`` bits without any
dictionary in the tasks.  That number is permuted invertibly; its first bits, the quotient, name a bucket, and the bucket keeps the
full remainder in order, with a counter of one byte for most: a sorted filter that loses nothing.  Each task makes filters of its texts;
the filters of a bucket are merged by sorting, and the permutation is undone to read the ids off again.  Quotients are spread evenly,
whatever the phrases are, and a phrase is one entry of a filter however often it occurs, so buckets of about ``BUCKET`` occurrences
bound the memory.

Phrases are counted by length: a phrase of n words is looked at only if both its parts of n - 1 words reach the least count, which a bitmap of
bounded size tells (it may let more pass, and never less).  Words are counted as texts.  Joins with word counts are salted, since a
few words begin very many phrases.  All arithmetic is on integers and decimals.

Defined results: a NULL text is empty; a NULL language is ``und``; repeated rows count each time; an empty table, or one without
a frequent phrase, gives an empty table; texts of any length are read whole; other columns are not looked at."""

from __future__ import annotations

import math
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import wordstream as W
from tidemark.llm.bitmaps import LEAST_LOG, MOST_LOG, bitmap
from tidemark.llm.common import col, in_groups, in_tasks, stored

#: Blanks between words, and the characters at which a text is cut.
CLASSES = W.classes(" \t", ".,;:!?\n\x0b\x0c\r")
BLOCK = 1 << 22
#: Occurrences of phrases in a bucket, and entries that a task keeps before it passes its filters on.
BUCKET, KEPT = 1 << 22, 1 << 20
SALTS = 8


def by_language(batch: pa.RecordBatch):
    coded = pc.dictionary_encode(batch.column("lang"))
    for i, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, batch.column("text").filter(pc.equal(coded.indices, i))


def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


def phrase_key(lanes: list[np.ndarray], lang: str) -> np.ndarray:
    """The hash of a phrase's ids for bitmaps."""
    out = np.full(len(lanes[0]), language_key(lang), dtype=np.uint64)
    for lane in lanes:
        out = W.mix(out ^ lane) + np.uint64(0x9E3779B97F4A7C15)
    return W.mix(out)


def word_counts(batches):
    """Words of the texts with their counts, by block and language."""
    for batch in batches:
        for lang, texts in by_language(batch):
            for _, data, _ in W.blocks(texts, BLOCK):
                starts, ends, _ = W.words(data, CLASSES)
                _, first, n = np.unique(W.hashes(data, starts, ends), return_index=True, return_counts=True)
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first)), W.texts_of(data, starts[first], ends[first]), pa.array(n)],
                                                     names=["lang", "word", "n"])


def identified(batches, seed: int, width: int):
    """Words with their ids and the keys of the ids."""
    for batch in batches:
        words = [w.encode() for w in batch.column("word").to_pylist()]
        data = b"\n".join([b"", *words, b""])
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(lengths + 1)
        ids = W.hashes(data, ends - lengths, ends, seed) >> np.uint64(64 - width)
        key = np.empty(len(ids), dtype=np.uint64)
        langs = pc.dictionary_encode(batch.column("lang"))
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            mine = langs.indices.to_numpy() == i
            key[mine] = phrase_key([ids[mine]], lang)
        yield pa.RecordBatch.from_arrays([*batch.columns, W.signed(ids), W.signed(key)], names=["lang", "word", "n", "w1", "key"])


def passing(batches, bits: bytes):
    for batch in batches:
        yield batch.filter(pa.array(W.has(bits, batch.column("key").to_numpy().view(np.uint64))))


def permuted(lanes: list[np.ndarray], width: int, back: bool = False) -> list[np.ndarray]:
    """A permutation of the numbers made of lanes of ``width`` bits: each lane in turn is changed by what the others are."""
    lanes = list(lanes)
    for k in sorted(range(len(lanes)), reverse=back):
        f = np.full(len(lanes[0]), 0x51ED270B35AE62F1 + k, dtype=np.uint64)
        for j, lane in enumerate(lanes):
            if j != k:
                f = W.mix(f ^ lane) + np.uint64(j)
        lanes[k] = lanes[k] ^ (f >> np.uint64(64 - width))
    return lanes


def summed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones as one."""
    if not len(counts):
        return lanes, counts
    order = np.lexsort(lanes[::-1])
    lanes = [x[order] for x in lanes]
    new = np.ones(len(order), dtype=bool)
    new[1:] = reduce(np.logical_or, [x[1:] != x[:-1] for x in lanes])
    at = np.flatnonzero(new)
    return [x[at] for x in lanes], np.add.reduceat(counts[order], at)


def packed(lanes: list[np.ndarray], counts: np.ndarray, width: int, rest: int) -> bytes:
    """The entries of a bucket: remainders (``rest`` bits of the first lane), counters of one byte, larger counters in full."""
    first = lanes[0] & np.uint64((1 << rest) - 1)
    parts = [lane.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()
             for lane, size in zip([first, *lanes[1:]], sizes(len(lanes), width, rest))]
    return b"".join([*parts, np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()])


def sizes(n: int, width: int, rest: int) -> list[int]:
    return [-(-rest // 8), *[width // 8] * (n - 1)]


def unpacked(blob: bytes, entries: int, n: int, width: int, rest: int, bucket: int) -> tuple[list[np.ndarray], np.ndarray]:
    lanes, at = [], 0
    raw = np.frombuffer(blob, dtype=np.uint8)
    for size in sizes(n, width, rest):
        lane = np.zeros((entries, 8), dtype=np.uint8)
        lane[:, :size] = raw[at:at + entries * size].reshape(entries, size)
        lanes.append(lane.view("<u8").reshape(entries).astype(np.uint64))
        at += entries * size
    lanes[0] |= np.uint64(bucket << rest)
    counts = raw[at:at + entries].astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob[at + entries:], dtype="<i8")
    return lanes, counts


def filters(batches, n: int, seed: int, width: int, bits: bytes, quotient: int):
    """Sorted filters of the phrases of ``n`` words whose parts pass the bitmap, cut into buckets."""
    kept: dict[str, list] = {}
    rest = width - quotient

    def passed_on(lang: str):
        lanes, counts = kept.pop(lang)[0]
        bucket = (lanes[0] >> np.uint64(rest)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
        last = np.append(first[1:], len(bucket))
        blobs = [packed([x[a:b] for x in lanes], counts[a:b], width, rest) for a, b in zip(first.tolist(), last.tolist())]
        if blobs:
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(blobs)), pa.array(bucket[first]), pa.array(last - first), pa.array(blobs, type=pa.binary())],
                                             names=["lang", "bucket", "entries", "blob"])

    def merged(parts: list) -> list:
        return [summed([np.concatenate(x) for x in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))]

    for batch in batches:
        for lang, texts in by_language(batch):
            for _, data, _ in W.blocks(texts, BLOCK):
                starts, ends, piece = W.words(data, CLASSES)
                ids = W.hashes(data, starts, ends, seed) >> np.uint64(64 - width)
                m = len(ids) - n + 1
                if m < 1:
                    continue
                good = W.has(bits, phrase_key([ids[j:j + m + 1] for j in range(n - 1)], lang)) & (piece[:m + 1] == piece[n - 2:n - 2 + m + 1])
                at = np.flatnonzero(good[:-1] & good[1:] & (piece[:m] == piece[n - 1:]))
                parts = kept.setdefault(lang, [])
                parts.append(summed(permuted([ids[at + j] for j in range(n)], width), np.ones(len(at), dtype=np.int64)))
                if sum(len(p[1]) for p in parts) > KEPT:
                    kept[lang] = merged(parts)
                    if len(kept[lang][0][1]) > KEPT // 2:
                        yield from passed_on(lang)
        while sum(len(p[1]) for parts in kept.values() for p in parts) > 2 * KEPT:  # many languages
            lang = max(kept, key=lambda k: sum(len(p[1]) for p in kept[k]))
            kept[lang] = merged(kept[lang])
            yield from passed_on(lang)
    for lang in list(kept):
        kept[lang] = merged(kept[lang])
        yield from passed_on(lang)


def bucket_merged(rows: pa.Table, n: int, width: int, quotient: int, least: int) -> pa.Table:
    """One filter of all that a bucket has, read as ids: the phrases that reach the least count."""
    bucket, lang = rows["bucket"][0].as_py(), rows["lang"][0].as_py()
    parts = [unpacked(blob.as_py(), k.as_py(), n, width, width - quotient, bucket) for blob, k in zip(rows["blob"], rows["entries"])]
    lanes, counts = summed([np.concatenate(x) for x in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))
    enough = counts >= least
    lanes = permuted([x[enough] for x in lanes], width, back=True)
    return pa.table({"lang": pa.array([lang] * int(enough.sum()), pa.string()), **{f"w{i}": W.signed(x) for i, x in enumerate(lanes, 1)},
                     "n": pa.array(counts[enough]), "key": W.signed(phrase_key(lanes, lang))})


def bits_for(n: int) -> int:
    return max(0, (max(1, n) - 1).bit_length())


def word_ids(words: DataFrame, least: int) -> tuple[DataFrame, bytes, int, int]:
    """Frequent words with ids, the bitmap of their keys, the seed and the width of the ids.

    Ids differ among all words that pass the bitmap, frequent or not; else the next seed is tried."""
    frequent, distinct = words.filter(F.col("n") >= least).count(), words.count()
    log = min(MOST_LOG, max(LEAST_LOG, bits_for(16 * max(1, frequent))))
    may_pass = frequent + distinct * min(1.0, frequent / 2**log) + 1
    width = min(64, 8 * math.ceil((2 * math.log2(may_pass) + 6) / 8))
    for seed in range(1, 33):
        found = words.mapInArrow(in_tasks(identified, seed=seed, width=width), "lang string, word string, n long, w1 long, key long")
        common = stored(found.filter(F.col("n") >= least), "words")
        bits = bitmap(common, "key", frequent)
        may = found.mapInArrow(in_tasks(passing, bits=bits), found.schema)
        if may.groupBy("lang", "w1").count().filter("count > 1").isEmpty():
            return common, bits, seed, width
    raise RuntimeError(f"no seed gives {distinct} words ids of {width} bits of their own")


def counted(rows: DataFrame, n: int, total: int, seed: int, width: int, bits: bytes, least: int) -> DataFrame:
    """(lang, w1 .. wn, n, key) of the phrases of ``n`` words with at least ``least`` occurrences."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quotient = min(width - 8, max(bits_for(-(-total // BUCKET)), bits_for(partitions)))
    made = rows.mapInArrow(in_tasks(filters, n=n, seed=seed, width=width, bits=bits, quotient=quotient), "lang string, bucket long, entries long, blob binary")
    ids = ", ".join(f"w{i} long" for i in range(1, n + 1))
    merged = made.groupBy("lang", "bucket").applyInArrow(
        in_groups(bucket_merged, n=n, width=width, quotient=quotient, least=least), f"lang string, {ids}, n long, key long")
    return stored(merged, f"phrases{n}")


def looked_up(phrases: DataFrame, table: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    """``phrases`` with columns of the row of ``table`` (w1, w2, ...) that has the ids ``keys``.  Salted: a word may stand in very many phrases."""
    ids = [f"w{i}" for i in range(1, len(keys) + 1)]
    other = table.select(F.col("lang").alias("lang_"), *[F.col(i).alias(f"{i}_") for i in ids], *[F.col(c).alias(name) for name, c in columns.items()],
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_"))
    mine = phrases.withColumn("salt", F.pmod(F.xxhash64(*[c for c in phrases.columns if c[0] == "w"]), F.lit(SALTS)).cast("int"))
    on = (mine["lang"] == other["lang_"]) & (mine["salt"] == other["salt_"])
    for k, i in zip(keys, ids):
        on &= mine[k] == other[f"{i}_"]
    return mine.join(other, on).drop("salt", "salt_", "lang_", *[f"{i}_" for i in ids])


def mine(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words with at least ``least`` occurrences: lang, rank, phrase, a, l, r, n, score.

    A phrase inside a longer one that has at least ``share`` per cent of its occurrences is left out."""
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("string").alias("text"))
    words = stored(rows.mapInArrow(in_tasks(word_counts), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common, bits, seed, width = word_ids(words, least)
    tables = {1: common}
    for n in range(2, longest + 1):
        tables[n] = counted(rows, n, total, seed, width, bits, least)
        if n < longest:
            bits = bitmap(tables[n], "key", tables[n].count())

    parts = []
    for m in range(2, longest + 1):
        ids = [f"w{i}" for i in range(1, m + 1)]
        scored = tables[m].select("lang", *ids, F.col("n").alias("a"))
        if m < longest:  # those inside longer ones
            inside = reduce(DataFrame.unionByName, [
                tables[big].select("lang", *[F.col(f"w{i + s}").alias(f"w{i}") for i in range(1, m + 1)], "n")
                for big in range(m + 1, longest + 1) for s in range(big - m + 1)])
            held = inside.groupBy("lang", *ids).agg(F.max("n").alias("held"))
            scored = scored.join(held, ["lang", *ids], "left").filter(F.coalesce(100 * F.col("held") < share * F.col("a"), F.lit(True))).drop("held")
        for i, k in enumerate(ids, 1):
            scored = looked_up(scored, common, [k], **{f"word{i}": "word", f"f{i}_{i}": "n"})
        for a in range(1, m + 1):  # counts of the parts, named by their first and last word
            for b in range(a + 1, m + 1):
                if (a == 1 or b == m) and (a, b) != (1, m):
                    scored = looked_up(scored, tables[b - a + 1], ids[a - 1:b], **{f"f{a}_{b}": "n"})
        cuts = [F.struct(F.expr(f"CAST(1000000 * CAST(a AS DECIMAL(18,0)) * CAST(a AS DECIMAL(18,0)) div "
                                f"(CAST(f1_{k} AS DECIMAL(18,0)) * CAST(f{k + 1}_{m} AS DECIMAL(18,0))) AS BIGINT)").alias("score"), F.lit(k).alias("k"),
                         F.col(f"f1_{k}").alias("l"), F.col(f"f{k + 1}_{m}").alias("r")) for k in range(1, m)]
        cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        parts.append(scored.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(1, m + 1)]).alias("phrase"), "a", cut.alias("cut")))
    every = reduce(DataFrame.unionByName, parts).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: Every word and run of two and three words counted as texts, for ``op13_collocations``.
ORACLE = r"""
WITH pieces AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) x),
w AS (SELECT lang, p, unnest(ws) AS w1, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
runs AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY p ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS n FROM runs GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS n FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w1, w2, w3, count(*) AS n FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.n AS a, 1 AS k, f.n AS l, g.n AS r
  FROM two t JOIN one f ON f.lang = t.lang AND f.w1 = t.w1 JOIN one g ON g.lang = t.lang AND g.w1 = t.w2
  WHERE t.n >= 10 AND NOT EXISTS (FROM three h WHERE h.lang = t.lang AND 100 * h.n >= 50 * t.n
    AND (h.w1 = t.w1 AND h.w2 = t.w2 OR h.w2 = t.w1 AND h.w3 = t.w2))
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 1, f.n, g.n
  FROM three t JOIN one f ON f.lang = t.lang AND f.w1 = t.w1 JOIN two g ON g.lang = t.lang AND g.w1 = t.w2 AND g.w2 = t.w3
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 2, f.n, g.n
  FROM three t JOIN two f ON f.lang = t.lang AND f.w1 = t.w1 AND f.w2 = t.w2 JOIN one g ON g.lang = t.lang AND g.w1 = t.w3),
best AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM one GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
