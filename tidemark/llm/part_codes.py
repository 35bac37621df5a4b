"""Vector codes of four bytes: each part of a vector is named by its nearest entry of a codebook, with adaptive bounds.

Codebooks are refined in rounds (assign every part, replace each entry by the floor of its parts' mean).  Beside its entry, each part
keeps its ``b`` closest other entries with a lower bound of each distance, in order, and one outer bound for all the rest.  When entries move,
the bounds shrink by how far they moved.  While they exceed the distance to the own entry, which is computed anew, nothing
has to be done; listed entries whose bound does not are computed, and only where the outer bound fails are all entries tried.
After each round ``b`` is set to what nearly all parts needed.  Bounds are kept in single precision, rounded down, and compared with a margin;
every distance that decides is a sum of whole numbers, so ties go to the lower index exactly.

Vectors and bounds are one table in the shared folder, written anew in each round; a task holds one batch of it.  What reaches the driver
are the codebooks (``entries`` times the length of a vector) and a histogram of list lengths.  Sums of parts are made per task and added by Spark.

Defined results: vectors that are NULL or hold a NULL or non-finite component are left out; so are vectors whose length is not the
most frequent one (of equally frequent ones the larger); parts of a length that four does not divide differ by one component; components
beyond 65,536 count as that; fewer rows than entries make a smaller codebook; rows without an id come last; repeated ids are rows of
their own, in the order of their vectors; an empty table gives an empty table; other columns are not looked at."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, in_tasks, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries listed at first, the least, and the share of vectors that may need a longer list.
LISTED, LEAST_LISTED, LONGER = 16, 2, 0.02
#: No component is larger, so that distances of whole numbers fit 64 bits.
LARGEST = 1 << 26
SALTS = 32
STATE = "codes binary, lists binary, lows binary, outers binary, depth int, error long"


def cuts(length: int) -> list[tuple[int, int]]:
    return [(p * length // PARTS, (p + 1) * length // PARTS) for p in range(PARTS)]


def whole_numbers(batches, length: int):
    for batch in batches:
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, length)
        v = np.clip(np.floor(v * SCALE), -LARGEST, LARGEST).astype("<i4")
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes() for row in v], type=pa.binary())],
                                         names=["vec_id", "label", "v"])


def matrix(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    """A column of binary values of the same length as an array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), *shape)


def binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], type=pa.binary())


def below(x: np.ndarray) -> np.ndarray:
    """Single precision, not above."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def reach(squares: np.ndarray) -> np.ndarray:
    """The distance with a margin beyond all rounding."""
    return np.sqrt(squares.astype(np.float64)) * (1 + 1e-6) + 1e-6


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of parts and entries, exact whole numbers (in double precision where it holds them)."""
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 2**52:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.concatenate([((x[i:i + 64, None, :] - book[None]) ** 2).sum(2) for i in range(0, len(x), 64)] or [np.empty((0, len(book)), np.int64)])


def tried(x: np.ndarray, book: np.ndarray, listed: int):
    """All entries tried: the nearest, its squared distance, the list of the next ones with bounds, and the outer bound."""
    d = distances(x, book)
    near = d.argmin(1)  # the first of equal ones
    rows = np.arange(len(x))
    squares = d[rows, near].astype(np.int64)
    d = d.astype(np.float64)
    d[rows, near] = np.inf
    if len(book) - 1 > listed:
        ids = np.argpartition(d, listed, axis=1)[:, :listed + 1]
    else:
        ids = np.argsort(d, axis=1)[:, :len(book)]  # the own entry comes last and stands for "no more"
    far = np.sqrt(np.take_along_axis(d, ids, 1))
    order = far.argsort(1)
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    return near, squares, ids[:, :-1], below(far[:, :-1]).astype(np.float64), below(far[:, -1]).astype(np.float64)


def settled(x: np.ndarray, book: np.ndarray, near: np.ndarray, ids: np.ndarray, lows: np.ndarray, outer: np.ndarray):
    """The nearest entries after the bounds have shrunk: as ``tried``, and how many listed entries were needed (one more where all were tried)."""
    rows, listed = np.arange(len(x)), ids.shape[1]
    squares = ((x - book[near]) ** 2).sum(1)
    r, j = np.nonzero(lows <= reach(squares)[:, None])
    depth = np.zeros(len(x), dtype=np.int32)
    np.maximum.at(depth, r, (j + 1).astype(np.int32))
    d = ((x[r] - book[ids[r, j]]) ** 2).sum(1)
    lows[r, j] = below(np.sqrt(d.astype(np.float64)))
    order = np.lexsort((ids[r, j], d, r))
    r, j, d = r[order], j[order], d[order]
    first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.empty(0, np.int64)
    r, j, d = r[first], j[first], d[first]
    i = ids[r, j]
    nearer = (d < squares[r]) | ((d == squares[r]) & (i < near[r]))
    r, j, d, i = r[nearer], j[nearer], d[nearer], i[nearer]
    ids[r, j], lows[r, j] = near[r], below(np.sqrt(squares[r].astype(np.float64)))
    near[r], squares[r] = i, d
    again = rows[outer <= reach(squares)]
    if len(again):
        near[again], squares[again], ids[again], lows[again], outer[again] = tried(x[again], book, listed)
        depth[again] = listed + 1
    order = lows.argsort(1)
    return near, squares, np.take_along_axis(ids, order, 1), np.take_along_axis(lows, order, 1), outer, depth


def assigned(batches, length: int, books: list[np.ndarray], moves: list[np.ndarray] | None, listed: int, keep: int):
    """Every part with its nearest entry, and the state for the next round with lists of ``keep`` entries.

    ``moves`` are how far entries moved since the state was made (None at first, without a state)."""
    entries = len(books[0])
    listed, keep = min(listed, entries - 1), min(keep, entries - 1)
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        v = matrix(batch.column("v"), "<i4", length).astype(np.int64)
        codes, error, depth = np.empty((n, PARTS), np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int32)
        lists, lows, outers = np.empty((n, PARTS, keep), np.uint8), np.empty((n, PARTS, keep), "<f4"), np.empty((n, PARTS), "<f4")
        if moves is not None:
            old = [matrix(batch.column(c), kind, *shape) for c, kind, shape in (
                ("codes", "u1", (PARTS,)), ("lists", "u1", (PARTS, listed)), ("lows", "<f4", (PARTS, listed)), ("outers", "<f4", (PARTS,)))]
        for p, (a, b) in enumerate(cuts(length)):
            x = v[:, a:b]
            if moves is None:
                near, squares, ids, low, outer = tried(x, books[p], keep)
            else:
                ids = old[1][:, p].astype(np.int64)
                low = old[2][:, p].astype(np.float64) - moves[p][ids]
                outer = old[3][:, p].astype(np.float64) - moves[p].max()
                near, squares, ids, low, outer, used = settled(x, books[p], old[0][:, p].astype(np.int64), ids, low, outer)
                depth = np.maximum(depth, used)
                if keep < listed:  # the entries that leave the list are under the outer bound
                    outer = np.minimum(outer, low[:, keep])
            codes[:, p], lists[:, p], lows[:, p], outers[:, p] = near, ids[:, :keep], below(low[:, :keep]), below(outer)
            error += squares
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), batch.column("v"), binary(codes), binary(lists), binary(lows), binary(outers), pa.array(depth), pa.array(error)],
            names=["vec_id", "label", "v", "codes", "lists", "lows", "outers", "depth", "error"])


def part_sums(batches, length: int, entries: int):
    """Sums of the components (place -1: numbers) of the parts of each entry."""
    sums = [np.zeros((entries, b - a + 1), dtype=np.int64) for a, b in cuts(length)]
    for batch in batches:
        v, codes = matrix(batch.column("v"), "<i4", length), matrix(batch.column("codes"), "u1", PARTS)
        for p, (a, b) in enumerate(cuts(length)):
            sums[p][:, 0] += np.bincount(codes[:, p], minlength=entries)
            for j in range(a, b):  # sums of a batch are whole numbers that doubles hold
                sums[p][:, j - a + 1] += np.bincount(codes[:, p], weights=v[:, j], minlength=entries).astype(np.int64)
    for p, s in enumerate(sums):
        e, j = np.nonzero(s)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), p, np.int32)), pa.array(e.astype(np.int32)), pa.array((j - 1).astype(np.int32)), pa.array(s[e, j])],
                                         names=["part", "entry", "place", "total"])


def refined(state: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The floors of the means of each entry's parts; an entry without parts stays."""
    rows = state.select("v", "codes").mapInArrow(in_tasks(part_sums, length=length, entries=len(books[0])), "part int, entry int, place int, total long")
    got = rows.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).toArrow()
    out = []
    for p, book in enumerate(books):
        sums = np.zeros((len(book), book.shape[1] + 1), dtype=np.int64)
        mine = got["part"].to_numpy() == p
        sums[got["entry"].to_numpy()[mine], got["place"].to_numpy()[mine] + 1] = got["total"].to_numpy()[mine]
        n = sums[:, :1]
        out.append(np.where(n > 0, sums[:, 1:] // np.maximum(n, 1), book))
    return out


@dataclass(frozen=True)
class Coded:
    """``rows``: vec_id, label, codes (a byte for each part), error; ``books``: the entries by part; ``listed``: lengths of the lists by round."""

    rows: DataFrame
    books: list[np.ndarray]
    listed: list[int]

    def books_sha256(self) -> str:
        return sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES,
           rounds: int = ROUNDS, listed: int = LISTED) -> Coded:
    """Codebooks of ``entries`` (256 at most) for four parts, refined ``rounds`` times, and the code of every vector."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry is named by one byte")
    rows = vectors.select(col(id_col).alias("vec_id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = common["size"] if common else 0
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    state = rows.filter(F.size("v") == length).mapInArrow(in_tasks(whole_numbers, length=length), f"{kinds}, v binary")
    state = stored(state, "vectors")
    first = state.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return Coded(state.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), [], [])
    start = np.array([np.frombuffer(r.v, dtype="<i4") for r in first], dtype=np.int64).reshape(len(first), length)
    books, moves, lengths, keep = [start[:, a:b] for a, b in cuts(length)], None, [listed], listed
    for _ in range(rounds + 1):
        state = stored(state.mapInArrow(in_tasks(assigned, length=length, books=books, moves=moves, listed=lengths[-1], keep=keep), f"{kinds}, v binary, {STATE}"), "codes")
        if moves is not None:
            lengths.append(keep)
            keep = next_length(state, keep)
        if len(lengths) > rounds:
            break
        new = refined(state, books, length)
        moves = [reach(((a - b) ** 2).sum(1)) * (a != b).any(1) for a, b in zip(new, books)]
        books = new
    return Coded(state.select("vec_id", "label", "codes", "error"), books, lengths)


def next_length(state: DataFrame, listed: int) -> int:
    """The shortest list that was enough for all but a few vectors, not longer than now."""
    seen = sorted((r.depth, r["count"]) for r in state.groupBy("depth").count().collect())  # a row for each length
    left, best = sum(n for _, n in seen), listed
    allowed = LONGER * left
    for depth, n in seen:
        left -= n
        if left <= allowed:
            best = max(LEAST_LISTED, depth)
            break
    return min(best, listed)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over rows of the same label, NULL with NULL.  Salted, since a label may be on very many rows."""
    sums = rows.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error"))
    sums = sums.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    return mine.join(sums, (mine["salt"] == sums["salt_"]) & mine["label"].eqNullSafe(sums["label_"])).drop("salt", "salt_", "label_")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds one after the other in SQL, every part against every entry, for ``op11_vector_codes``."""
    out = [f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, CAST(len(embedding) AS BIGINT) AS d,
  [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
part AS MATERIALIZED (SELECT r, vec_id, label, p, x[CAST(p * d // {parts} AS BIGINT) + 1 : CAST((p + 1) * d // {parts} AS BIGINT)] AS x
  FROM v, (SELECT unnest(range({parts})) AS p) ps),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        out.append(f"""near{k} AS MATERIALIZED (SELECT r, p, min((s, e)) AS best FROM (SELECT r, part.p, e,
  CAST(list_sum([(y[1] - y[2]) * (y[1] - y[2]) for y in list_zip(x, c)]) AS BIGINT) AS s FROM part JOIN book{k} USING (p)) z GROUP BY r, p)""")
        if k < rounds:
            out.append(f"""mean{k} AS MATERIALIZED (SELECT p, e, list(CAST(floor_ AS BIGINT) ORDER BY i) AS c FROM (
    SELECT p, e, i, (total - ((total % n) + n) % n) // n AS floor_ FROM (
      SELECT p, best[2] AS e, i, CAST(sum(y) AS BIGINT) AS total, count(*) AS n FROM (
        SELECT part.p, best, unnest(x) AS y, unnest(range(len(x))) AS i FROM part JOIN near{k} USING (r, p)) a GROUP BY ALL) b) f GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))""")
    return f"""WITH {", ".join(out)},
code AS (SELECT r, string_agg(printf('%02x', CAST(best[2] AS INT)), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT s FROM sha) AS codebooks_sha256
FROM v JOIN code USING (r)"""


ORACLE = oracle()
