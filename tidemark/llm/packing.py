"""Packing along a space-filling curve.

Documents are tokenized once.  A document's vector is the hashed sum of its ids, each id hashed to a fixed random
direction of few dimensions (hashing and projection in one table); its mean is cut to a grid, and the grid point's
Hilbert number is the document's place on the curve.  Documents are range-sorted by that number and laid end to end, so
that neighbours on the curve share a sequence; the stream is cut every ``length`` ids.  Only the very last sequence
has padding.

Sorted are rows of a few numbers.  A running sum of lengths (within each range, on top of the sums of the ranges) gives
every document its place in the stream; the ids are then joined with their place by row number and cut in parallel.
Copies share a curve number, but not a row number, so ranges split a group of copies of any size.  The ids are written
once to the shared folder, so a lost executor costs no second tokenization.

Defined results: a NULL text is empty and has the end id only; repeated rows are separate documents; an empty table gives an
empty table; a text of any length is cut into as many pieces as it needs; extra columns are ignored."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, in_tasks, stored

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 15
#: Python splits at these as well, tokenizers do not: texts with them are tokenized as a whole.
ONLY_PYTHON = "\x1c\x1d\x1e\x1f"
#: A sign that stands between words to encode many at once; words with it are encoded alone.
MARK = "\x01"
#: Words of at most so many letters are kept with their ids, and so many of them, in a worker (about 200 bytes each).
LONG_WORD, MANY_WORDS = 40, 1_200_000

_loaded: dict = {}


class Words:
    """Ids of whole texts, put together from the ids of their words, which are kept.  Right for tokenizers that drop
    white space and never join across it; that is tried out, and texts of others, or with the string of a special token,
    are tokenized as a whole."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        a, b, mark = self.encode(["The", "end", MARK])
        self.folds = self.encode(["THE Él ÀÇÜ"]) == self.encode(["the él àçü"])
        self.apart = self.encode(["The  end\n"]) == [a + b]
        self.mark = mark[0] if self.encode([f"The {MARK} end"]) == [a + mark + b] and len(mark) == 1 else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(self, ids) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def words(self, words: list[str], together: int = 200):
        """Ids of each word, as bytes."""
        if self.mark is None:
            yield from map(self.packed, self.encode(words))
            return
        groups = [words[i: i + together] for i in range(0, len(words), together)]
        for group, ids in zip(groups, self.encode([f" {MARK} ".join(g) for g in groups])):
            found = np.array(ids, dtype=self.kind)
            cuts = np.flatnonzero(found == self.mark)
            if len(cuts) + 1 != len(group):  # a word with the mark's id in it
                yield from map(self.packed, self.encode(group))
                continue
            raw, size = found.tobytes(), self.kind.itemsize
            begins, ends = (np.append(-1, cuts) + 1) * size, np.append(cuts, len(found)) * size
            yield from (raw[i:j] for i, j in zip(begins.tolist(), ends.tolist()))

    def folded(self, text: str) -> str:
        """Small letters where that is safe to do beforehand, for fewer different words: in texts of Latin-1."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower() if self.folds else text

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        known, new, split = self.known, set(), []
        for text in texts:
            whole = not self.apart or any(s in text for s in self.special) or any(c in text for c in ONLY_PYTHON)
            split.append(None if whole else self.folded(text).split())
            if not whole:
                new.update(set(split[-1]).difference(known))
        new = list(new)
        known.update(zip(new, self.words(new)))
        out = []
        for text, words in zip(texts, split):
            if words is None:
                out.append(np.array(self.encode([text])[0], dtype=self.kind))
            else:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=self.kind))
        full = len(known) > MANY_WORDS
        for w in new:
            if full or len(w) > LONG_WORD:
                del known[w]
        return out


def words_of_path(path: str, end_id: int) -> Words:
    if (path, end_id) not in _loaded:
        _loaded[path, end_id] = Words(path, end_id)
    return _loaded[path, end_id]


def directions(seed: int, dims: int = DIMS) -> np.ndarray:
    """A fixed random direction for each of 2^16 hashed ids."""
    if ("directions", seed, dims) not in _loaded:
        _loaded["directions", seed, dims] = np.random.default_rng(seed).standard_normal((1 << 16, dims)).astype(np.float32)
    return _loaded["directions", seed, dims]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Numbers along the Hilbert curve of grid points (rows of ``dims`` integers below 2^bits): from the highest bit
    down, undo each step's reflection and exchange of axes, then turn the Gray code into a number."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        mask = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[i]) & mask)
            x[0] = np.where(on, x[0] ^ mask, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> b & 1, (1 << b) - 1, 0)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | ((x[i] ^ flip) >> b & 1)
    return out


def places(ids: list[np.ndarray], seed: int) -> np.ndarray:
    """Curve numbers of documents given as ids."""
    table = directions(seed)
    sizes = np.array([len(one) for one in ids])
    # ids hash to rows of the table by a multiplicative hash; a last row of zeros keeps empty texts apart
    rows = (np.concatenate(ids).astype(np.uint32) * np.uint32(40_503)) & np.uint32(0xFFFF)
    vectors = np.concatenate([table.take(rows, axis=0), np.zeros((1, DIMS), dtype=np.float32)])
    means = np.add.reduceat(vectors, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / np.maximum(sizes, 1)[:, None]
    means[sizes == 0] = 0
    grid = np.clip((means + 1.0) * (1 << BITS - 1), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(grid)


def tokenized(batches, path: str, end_id: int, seed: int):
    """(row, id, text) to (row, id, curve number, length, ids as little-endian unsigned 32-bit numbers)."""
    words = words_of_path(path, end_id)
    last = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            ids = words.ids([t or "" for t in part.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(places(ids, seed), pa.int64()), pa.array([len(i) + 1 for i in ids], pa.int64()),
                pa.array([i.astype("<u4").tobytes() + last for i in ids], pa.binary()),
            ], names=["row", "id", "place", "n", "ids"])


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, seed: int = 7) -> DataFrame:
    """A row for each piece: ``id_col``, ``start`` (ids of its document before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (in the sequence) and ``ids`` (little-endian unsigned 32-bit numbers)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    tokens = rows.mapInArrow(in_tasks(tokenized, path=tokenizer_path, end_id=end_id, seed=seed), f"row long, id {kind}, place long, n long, ids binary")
    tokens = stored(tokens, "tokens")
    order = ["place", "tie", "row"]
    small = tokens.select("row", "place", F.xxhash64("row").alias("tie"), "n").repartitionByRange(*order)
    small = stored(small.withColumn("part", F.spark_partition_id()), "order")
    # one row for each range, not for each document
    ahead = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = small.groupBy("part").agg(F.sum("n").alias("base")).select(
        "part", F.coalesce(F.sum("base").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = small.join(base, "part").select("row", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("at"))
    joined = tokens.select("row", "id", "n", "ids").join(placed.hint("shuffle_hash"), "row")
    # a document's part in each sequence that it touches; positions are inside the document
    first, last = F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("n") - 1) / length)
    cut = joined.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("sequence_id") * length - F.col("at"), F.lit(0).cast("long"))
    end = F.least((F.col("sequence_id") + 1) * length - F.col("at"), F.col("n"))
    cut = cut.withColumn("start", start).withColumn("length", end - start)
    return cut.select(
        F.col("id").alias(id_col), "start", "length", F.col("n").alias("doc_tokens"), "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * length).alias("offset"),
        F.substring("ids", (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int")).alias("ids"))
