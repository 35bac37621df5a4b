"""Benchmark decontamination by a prefix-filtered join of sets of shingles.

Every run of ``size`` consecutive words of a benchmark item is a window (an item of fewer words is one window), seen as the set
of its shingles of ``shingle`` words.  Shingles are ordered by rarity: how often each occurs in all documents.  A document
contains a window only if it contains the whole set, so the prefix that is necessary has one token, the window's rarest
shingle; windows whose rarest shingle occurs nowhere are out at once.  Documents send the places where they have a prefix
token, with the words around; these are joined with the tokens by hash.  A candidate must have room for the window before and
behind the token (the bounds of position and length), and then its words are compared one by one, so that hashes decide nothing.

Documents are read twice, once to count and once to send.  In both passes a bitmap of bounded size drops what no window
has; the benchmark itself is only joined, so it may be of any size.  Rows that leave a document: one with its number of
words, and its candidates.

Defined results: a NULL or empty text, or one without words, has no words and no hits; an item without words has no windows; rows with
the same id, or without one, are judged on their own; items with the same id are one item, items without an id are one
that is not listed; an empty table of documents gives an empty table, and without items nothing is hit; other columns are not looked at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import wordstream as W
from tidemark.llm.bitmaps import bitmap
from tidemark.llm.common import col, in_tasks, stored

#: The ASCII characters that are no part of a word, once letters are lower-cased.
CLASSES = W.classes("", "".join(chr(b) for b in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
BLOCK = 1 << 20
COUNTS = "shingle long, n long"
SENT = "h1 long, h2 long, n_words long, at long, shingle long, before int, around string"
WINDOWS = "item string, w string, n int, shingles array<long>"


def shingles(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    out = np.full(max(0, len(hashed) - n + 1), n, dtype=np.uint64)
    for j in range(n):
        out = (out + hashed[j:j + len(out)]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return W.mix(out)


def found(data: bytes, begins: np.ndarray, lengths: list[int], bits: bytes):
    """The places in a block that have a token of the bitmap: the words, their texts' numbers, and (length, places, hashes) of the tokens."""
    starts, ends, _ = W.words(data, CLASSES)
    hashed = W.hashes(data, starts, ends)
    row = np.searchsorted(begins, starts, side="right") - 1
    hits = []
    for n in lengths:
        key = shingles(hashed, n)
        at = np.flatnonzero(W.has(bits, key))
        at = at[row[at] == row[at + n - 1]]  # all words are of one text
        hits.append((n, at, key[at]))
    return starts, ends, row, hits


def counted(batches, bits: bytes, lengths: list[int]):
    """How often the tokens of the bitmap occur."""
    for batch in batches:
        for _, data, begins in W.blocks(batch.column(0), BLOCK):
            keys = np.concatenate([k for _, _, k in found(data, begins, lengths, bits)[3]] or [np.empty(0, np.uint64)])
            key, n = np.unique(keys, return_counts=True)
            if len(key):
                yield pa.RecordBatch.from_arrays([W.signed(key), pa.array(n)], names=["shingle", "n"])


def sent(batches, bits: bytes, lengths: list[int], size: int):
    """A row for each text with its number of words, and one for each place with a prefix token and the words around it."""
    for batch in batches:
        ids = batch.select(["doc_id", "h1", "h2"])
        for first, data, begins in W.blocks(batch.column("text"), BLOCK):
            starts, ends, row, hits = found(data, begins, lengths, bits)
            texts = len(begins)
            n_words = np.bincount(row, minlength=texts)
            yield pa.RecordBatch.from_arrays(
                [*ids.slice(first, texts).columns, pa.array(n_words), *[pa.nulls(texts, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.string())]],
                names=[*ids.schema.names, "n_words", "at", "shingle", "before", "around"])
            a = np.searchsorted(row, np.arange(texts))  # the first word of each text
            for n, at, key in hits:
                low = np.maximum(a[row[at]], at - (size - n))
                high = np.minimum(a[row[at]] + n_words[row[at]], at + size)
                around = [b" ".join([data[s:e] for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist())]) for i, j in zip(low.tolist(), high.tolist())]
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [*ids.take(pa.array(first + row[at])).columns, pa.nulls(len(at), pa.int64()), pa.array(at - a[row[at]]), W.signed(key),
                         pa.array((at - low).astype(np.int32)), pa.array(around, type=pa.binary()).cast(pa.string())],
                        names=[*ids.schema.names, "n_words", "at", "shingle", "before", "around"])


def windows(batches, size: int, shingle: int):
    """The windows of all items with their shingles."""
    for batch in batches:
        for first, data, begins in W.blocks(batch.column("text"), BLOCK):
            starts, ends, _ = W.words(data, CLASSES)
            hashed = W.hashes(data, starts, ends)
            row = np.searchsorted(begins, starts, side="right") - 1
            rows = {"item": [], "w": [], "n": [], "shingles": []}
            for i in range(len(begins)):
                a, b = np.searchsorted(row, [i, i + 1])
                n = min(size, int(b - a))
                k = min(n, shingle)
                key = W.signed(shingles(hashed[a:b], k)).to_pylist() if n else []
                parts = [data[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                for j in range(len(parts) - n + 1 if n else 0):
                    rows["item"].append(batch.column("item")[first + i].as_py())
                    rows["w"].append(b" ".join(parts[j:j + n]).decode())
                    rows["n"].append(n)
                    rows["shingles"].append(key[j:j + n - k + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["item"], pa.string()), pa.array(rows["w"], pa.string()), pa.array(rows["n"], pa.int32()), pa.array(rows["shingles"], pa.list_(pa.int64()))],
                names=list(rows))


def hits(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         size: int = 10, shingle: int = 5) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, ``spans`` (disjoint [start, end) of hit words, in order) and ``items``
    (struct<item string>: the items with a window in the text, sorted)."""
    text = col(text_col).cast("string")
    # rows with the same id are told apart by hashes of their texts
    rows = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("text"))
    item = benchmark.select(col(item_col).cast("string").alias("item"), col(text_col).cast("string").alias("text"))
    listed = stored(item.mapInArrow(in_tasks(windows, size=size, shingle=shingle), WINDOWS), "windows")
    window = listed.select("w", "n", "shingles").dropDuplicates(["w"])
    places = window.select("w", "n", F.posexplode("shingles").alias("p", "shingle"))

    every = places.select("shingle").distinct()
    lengths = sorted(r.k for r in window.select(F.least("n", F.lit(shingle)).alias("k")).distinct().collect())  # ``shingle`` values at most
    bits = bitmap(every, "shingle", every.count())
    seen = rows.select("text").mapInArrow(in_tasks(counted, bits=bits, lengths=lengths), COUNTS).groupBy("shingle").agg(F.sum("n").alias("n_seen"))
    prefix = places.join(seen, "shingle").groupBy("w", "n").agg(
        F.min(F.struct("n_seen", "shingle", "p")).alias("rarest"), F.count(F.lit(1)).alias("present"))
    # a window is possible if each of its shingles occurs somewhere
    prefix = prefix.filter(F.col("present") == F.greatest(F.lit(1), F.col("n") - F.lit(shingle - 1)))
    prefix = stored(prefix.select("rarest.shingle", "rarest.p", "w", "n"), "prefix")

    bits = bitmap(prefix.select("shingle").distinct(), "shingle", prefix.count())
    out = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SENT}"
    here = stored(rows.mapInArrow(in_tasks(sent, bits=bits, lengths=lengths, size=size), out), "places")
    around = here.filter("shingle IS NOT NULL").withColumn("around", F.split("around", " "))
    first = F.col("before") - F.col("p")
    same = F.array_join(F.slice("around", F.greatest(first, F.lit(0)) + 1, F.col("n")), " ") == F.col("w")
    hit = around.join(prefix, "shingle").filter((first >= 0) & (first + F.col("n") <= F.size("around")) & same).select(
        "doc_id", "h1", "h2", (F.col("at") - F.col("p")).alias("start"), (F.col("at") - F.col("p") + F.col("n")).alias("end"), "w")
    hit = stored(hit, "hits")

    text_key = ["doc_id", "h1", "h2"]
    items = hit.select(*text_key, "w").distinct().join(listed.select("w", "item").distinct(), "w").select(*text_key, "item").distinct()

    def part(df: DataFrame, n_words: Column, span: Column, item: Column) -> DataFrame:
        return df.select(*text_key, n_words.alias("n_words"), span.alias("span"), item.alias("item"))

    none_span, none_item = F.lit(None).cast("struct<start:bigint,end:bigint>"), F.lit(None).cast("struct<item:string>")
    merged = part(here.filter("shingle IS NULL"), F.col("n_words"), none_span, none_item).unionByName(
        part(islands(hit, text_key), F.lit(None).cast("long"), F.struct("start", "end"), none_item)).unionByName(
        part(items, F.lit(None).cast("long"), none_span, F.struct("item")))
    got = merged.groupBy(*text_key).agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"), F.sort_array(F.collect_list("span")).alias("spans"),
        F.sort_array(F.collect_list("item")).alias("items"))
    got = got.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return got.select("doc_id", "n_words", "spans", "items")


def islands(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Disjoint stretches that cover the same words as the [start, end) of each key."""
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.select(*keys, "start", "end", F.when(F.coalesce(F.col("start") > before, F.lit(True)), 1).otherwise(0).alias("new"))
    numbered = new.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


#: Windows of the items looked up among all runs of words of the documents, for ``op12_decontamination``.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0) x),
runs AS (SELECT r, i, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS i FROM d, (SELECT DISTINCT n FROM w) ns WHERE len(ws) >= n) x),
hit AS (SELECT r, i, runs.n, item FROM runs JOIN w USING (w)),
places AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, CAST(i + n AS BIGINT))) AS p FROM (SELECT DISTINCT r, i, n FROM hit) y) x GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) x GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)"""
