"""N-gram Jaccard join by vertical partitioning.

A text's set holds its distinct shingles of ``size`` words, as 64-bit hashes; the hash is the global order of n-grams, and cuts
of that order are the vertical fragments.  All texts with the same set are one node, whatever their number.

1. Of the first fragment (a share of the order that depends on the threshold) every node counts how many of its n-grams no
   other node has.  What only one of two sets has counts against them; a node with more such n-grams than two linked
   sets can differ by is linked with nothing.  That settles nearly all texts with one small exchange.  The others are
   counted again over all fragments.
2. Of what is left, nodes are candidates of each other if they share one of the first n - ceil(t n) + 1 n-grams of
   their sets and neither their sizes nor the n-gram's places in both sets rule a link out; of an n-gram that more than ``FEW_NODES``
   nodes have, those of similar size hang together.  Frequent n-grams come last in that order, so passages that
   many texts share link nobody: step 1 counts how many sets have each n-gram, and the most frequent
   ones, as many as a table of bounded size can tell apart, are filed there.  Candidates that hang together are a cluster.
3. Inside a cluster, overlaps are counted fragment by fragment (a cut of the sorted n-grams) and the partial overlaps are summed for each pair.  Pairs are compared with the threshold in whole numbers.  A
   cluster beyond ``BLOCK`` nodes is first compared, block by block, with a few of its nodes: the copies of one text are linked
   with one of them and hang together.  Of what a cluster then falls into, the largest component needs no comparison inside; the
   other nodes, if any, are compared with all, pair by pair of blocks.  A task returns only links that join what it has not joined yet.

All steps are exact but for collisions of 64-bit hashes.  No step caps or samples anything, no list of pairs is written,
and exchanged rows hold packed numbers of many texts.  The work of step 3 is linear in a cluster of near copies; nodes outside its
largest component cost a comparison with every block of the cluster.

Defined results: NULL and word-less texts have an empty set and are linked with nothing; a text of fewer words than ``size``
has one shingle, all its words; rows of equal sets (repeated rows, too) are linked; a component is named by its smallest
id, NULL ids last; an empty table gives an empty table; extra columns are ignored; ids are whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, in_groups, in_tasks, stored
from tidemark.llm.components import components

BLOCK = 2_048
#: Nodes of a large cluster that all of it is compared with, and how often.
PIVOTS, PIVOT_ROUNDS = 4, 2
#: An n-gram is frequent if so many sets have it, or twice, four times as many, until no more than ``MOST_FREQUENT`` are.
FREQUENT, MOST_FREQUENT = 4, 1 << 20
#: Bytes of the table that tells them, as a power of two; places in it for each of them.
MOST_LOG, LEAST_LOG, PLACES = 22, 16, 4
#: Nodes of an n-gram that are compared by place, pair by pair.
FEW_NODES = 32
#: N-grams and texts of one packed exchange row's group; keys are cut to five bytes there.
GROUP_GRAMS, GROUP_TEXTS, KEY_BYTES = 1 << 19, 60_000, 5
PART_GRAMS = 1 << 22
#: In place of a text: at least two texts of the group have the n-gram, one more for each number below.
SEEN = 65_535
#: N-grams of a fragment in step 3; sets that count as few; columns of a matrix.
FRAGMENT, FEW, COLUMNS = 1 << 18, 12, 2_048
MANY_WORDS = 100_000
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


class _Hashes(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) > MANY_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads sums of hashes over all 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted set of a text.  Bytes are split at the six ASCII white-space characters and lower-cased in A-Z only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - span + 1, span, dtype=np.uint64)
        for k in range(span):
            total = mixed(total + h[k: len(words) - span + 1 + k] * _M[k % len(_M)])
    total.sort()
    keep = np.ones(len(total), dtype=bool)
    np.not_equal(total[1:], total[:-1], out=keep[1:])
    return total[keep]


def digest(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def sets(batches, size: int):
    """(id, text, text_hash) to (id, text_hash, n, node): the size of the set and its digest, NULL for an empty set."""
    for batch in batches:
        sizes, nodes = [], []
        for text in batch.column(1):
            grams = shingles(text.as_py(), size)
            sizes.append(len(grams)), nodes.append(digest(grams) if len(grams) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                                         names=["id", "text_hash", "n", "node"])


def chosen_sets(batches, size: int):
    """(node, text) of the chosen texts to (node, n, grams); a text that is not the node's is left out."""
    for batch in (b.slice(at, 1_000) for b in batches for at in range(0, b.num_rows, 1_000)):
        nodes, found = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            grams = shingles(text.as_py(), size)
            if len(grams) and digest(grams) == node:
                nodes.append(node), found.append(grams)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes, pa.int64()), pa.array([len(g) for g in found], pa.int64()), pa.array([g.tobytes() for g in found], pa.binary())],
            names=["node", "n", "grams"])


def texts_with_sets(batches, size: int | None):
    """(node, grams) of each row of (text) or of (node, n, grams)."""
    for batch in batches:
        if size is None:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("grams")):
                yield node, np.frombuffer(raw.as_buffer(), dtype=np.uint64)
        else:
            for text in batch.column(0):
                grams = shingles(text.as_py(), size)
                if len(grams):
                    yield digest(grams), grams


PACKED = "part int, grp long, class int, keys binary, texts binary, nodes binary, most binary, counts binary"


def packed(part: int, group: int, class_: int | None = None, keys=None, texts=None, nodes=None, most=None, counts=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([group], pa.int64()), pa.array([class_], pa.int32()), *(pa.array([x], pa.binary()) for x in (keys, texts, nodes, most, counts))],
        names=["part", "grp", "class", "keys", "texts", "nodes", "most", "counts"])


def fragment_rows(batches, size: int | None, share: float, parts: int, num: int, den: int):
    """The n-grams of the first ``share`` of the order, packed by part of that share.  A group of texts sends every n-gram
    once (so that a part gets at most a row for each group of a hot one) and one row with its nodes: how many n-grams of
    a node the group itself has twice, and how many shared ones it needs."""
    limit = np.uint64(min(share, 1.0) * (2.0 ** 64 - 2048))
    width = np.uint64(int(limit) // parts + 1)
    held: dict[int, np.ndarray] = {}
    full: dict[int, int] = {}
    total = 0

    def rows():
        import xxhash

        nodes = np.array(list(held), dtype=np.int64)
        sizes = np.array([len(g) for g in held.values()], dtype=np.int64)
        grams = np.concatenate(list(held.values())) if held else np.zeros(0, dtype=np.uint64)
        text = np.repeat(np.arange(len(nodes)), sizes)
        order = np.argsort(grams, kind="stable")
        grams, text = grams[order], text[order]
        first = np.ones(len(grams), dtype=bool)
        np.not_equal(grams[1:], grams[:-1], out=first[1:])
        twice = ~first
        twice[:-1] |= ~first[1:]
        counts = np.bincount(text[twice], minlength=len(nodes)).astype("<u4")
        # a linked set may have (den - num) / num of its n n-grams that the other has not
        most = np.array([full[n] * (den - num) // num for n in held], dtype=np.int64)
        need = np.maximum(sizes - most, 0).astype("<u4")
        group = int(np.uint64(xxhash.xxh3_64_intdigest(nodes.tobytes())).astype(np.int64))
        yield packed(group % parts, group, nodes=nodes.tobytes(), most=need.tobytes(), counts=counts.tobytes())
        often = np.diff(np.append(np.flatnonzero(first), len(grams)))
        grams, text = grams[first], np.where(often > 1, np.maximum(SEEN + 2 - often, GROUP_TEXTS), text[first]).astype("<u2")
        at = np.searchsorted(grams, np.arange(parts + 1, dtype=np.uint64) * width)
        at[-1] = len(grams)
        for p in range(parts):
            a, b = at[p], at[p + 1]
            if b > a:
                keys = np.ascontiguousarray(grams[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
                yield packed(p, group, keys=keys.tobytes(), texts=text[a:b].tobytes())

    for node, grams in texts_with_sets(batches, size):
        if node in held:
            continue
        full[node] = len(grams)
        held[node] = grams[: np.searchsorted(grams, limit)]
        total += len(held[node])
        if total >= GROUP_GRAMS or len(held) >= GROUP_TEXTS:
            yield from rows()
            held, full, total = {}, {}, 0
    if held:
        yield from rows()


def by_part(batches):
    """Rows of one part together; they come sorted by part."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != now:
                yield held
                held = []
            now = row["part"]
            held.append(row)
    if held:
        yield held


def shared_rows(batches, tally: bool):
    """For each part and group, how many n-grams of each text another group has, as (place of text, count); rows of nodes pass.
    If asked for, also the last bits of the part's frequent n-grams, by the class of their count (how many bits it has)."""
    for rows in by_part(batches):
        for r in rows:
            if r["nodes"] is not None:
                yield packed(r["part"], r["grp"], nodes=r["nodes"], most=r["most"], counts=r["counts"])
        rows = [r for r in rows if r["keys"] is not None]
        if not rows:
            continue
        keys = np.zeros((sum(len(r["texts"]) // 2 for r in rows), 8), dtype=np.uint8)
        keys[:, :KEY_BYTES] = np.frombuffer(b"".join(r["keys"] for r in rows), dtype=np.uint8).reshape(-1, KEY_BYTES)
        keys = keys.view("<u8")[:, 0]
        text = np.frombuffer(b"".join(r["texts"] for r in rows), dtype="<u2")
        group = np.repeat(np.arange(len(rows)), [len(r["texts"]) // 2 for r in rows])
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        if tally:
            begin = np.flatnonzero(np.append(True, ~same))
            counts = np.add.reduceat(np.where(text < GROUP_TEXTS, 1, SEEN + 2 - text.astype(np.int64))[order], begin)
            begin, counts = begin[counts >= FREQUENT], counts[counts >= FREQUENT]
            ends, classes = (keys[order[begin]] & np.uint64((1 << MOST_LOG) - 1)).astype("<u4"), np.floor(np.log2(counts)).astype(int) + 1
            for c in np.unique(classes).tolist():
                yield packed(rows[0]["part"], 0, class_=c, keys=ends[classes == c].tobytes())
        twice &= text < GROUP_TEXTS
        hits, owner = text[twice], group[twice]
        cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
        for k, r in enumerate(rows):
            if cuts[k + 1] > cuts[k]:
                yield packed(r["part"], r["grp"], texts=hits[cuts[k]: cuts[k + 1]].tobytes())


def open_nodes(rows):
    """Nodes of one group that share enough n-grams to be linked with something."""
    nodes = need = counts = None
    extra = []
    for r in rows.to_pylist():
        if r["nodes"] is not None:
            nodes, need = np.frombuffer(r["nodes"], dtype=np.int64), np.frombuffer(r["most"], dtype="<u4")
            counts = np.frombuffer(r["counts"], dtype="<u4").astype(np.int64)
        else:
            extra.append(r["texts"])
    shared = counts + np.bincount(np.frombuffer(b"".join(extra), dtype="<u2"), minlength=len(nodes))[: len(nodes)]
    return pa.table({"node": pa.array(nodes[shared >= need], pa.int64())})


def crowded(rows: DataFrame, size: int | None, share: float, num: int, den: int, total: int, tally: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of ``rows``, which have ``total`` n-grams, that may be linked, after the fragment's n-grams are counted; if asked for,
    the fragment's frequent n-grams by class, as ``shared_rows`` gives them.

    The fragment has so many parts that each holds about ``PART_GRAMS`` n-grams; a task counts one of its parts after the other."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, math.ceil(total * min(share, 1.0) / PART_GRAMS))
    sent = rows.mapInArrow(in_tasks(fragment_rows, size=size, share=share, parts=parts, num=num, den=den), PACKED)
    counted = sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(in_tasks(shared_rows, tally=tally), PACKED)
    frequent = None
    if tally:
        counted = stored(counted, "counted")
        counted, frequent = counted.filter("class is null"), counted.filter("class is not null").select("class", "keys")
    return counted.groupBy("grp").applyInArrow(in_groups(open_nodes), "node long").distinct(), frequent


def frequency_classes(frequent: DataFrame) -> np.ndarray:
    """For each place of a table (the last bits of an n-gram) the class of the most frequent n-gram there, 0 if none is frequent.
    The driver gets four bytes for each of at most ``MOST_FREQUENT`` n-grams: of the highest classes."""
    counts = dict(frequent.groupBy("class").agg(F.sum(F.length("keys")) / 4).collect())
    least, total = 256, 0
    for c in sorted(counts, reverse=True):
        if total + counts[c] > MOST_FREQUENT:
            break
        least, total = c, total + int(counts[c])
    log = min(MOST_LOG, max(LEAST_LOG, (max(1, total) * PLACES - 1).bit_length()))
    classes = np.zeros(1 << log, dtype=np.uint8)
    for r in frequent.filter(F.col("class") >= least).orderBy("class").toLocalIterator():
        classes[np.frombuffer(r["keys"], dtype="<u4") & np.uint32(len(classes) - 1)] = r["class"]
    return classes


def prefix_rows(batches, classes: np.ndarray, num: int, den: int):
    """(token, n, at, node): the first n - ceil(t n) + 1 n-grams of a set, rare ones first, then by the global order, with their
    places; none of a set so small that no other set is similar enough."""
    for batch in batches:
        tokens, sizes, places, nodes = [], [], [], []
        for node, raw in zip(batch.column("node").to_pylist(), batch.column("grams")):
            grams = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
            n = len(grams)
            if n * (den - num) < num:
                continue
            order = np.argsort(classes[(grams & np.uint64(len(classes) - 1)).astype(np.int64)], kind="stable")[: n + (-n * num // den) + 1]
            tokens.append(grams[order]), sizes.append(np.full(len(order), n)), places.append(np.arange(len(order))), nodes.append(np.full(len(order), node, dtype=np.int64))
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(np.concatenate(x).astype(np.int32)) for x in (sizes, places)),
                                              pa.array(np.concatenate(nodes))], names=["token", "n", "at", "node"])


class Forest:
    """Union of nodes; says which links joined something."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while up.get(top, top) != top:
            top = up[top]
        while up.get(x, x) != top:
            up[x], x = top, up[x]
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def may_link(nodes: list[tuple[int, int, int]], num: int, den: int):
    """Pairs that connect the nodes (n, place, node) of one n-gram, in order of n, that may be linked by it.  Of a few nodes: what
    is left of both sets after the n-gram, for all before it differ in one that is the first in common, must do.  Of many: neighbours."""
    for k, (n, at, node) in enumerate(nodes):
        for m, place, other in nodes[k + 1:] if len(nodes) <= FEW_NODES else nodes[k + 1: k + 2]:
            if n * den < m * num:
                break
            # the overlap that a link of these sizes has at least is num (n + m) / (num + den)
            if node != other and (len(nodes) > FEW_NODES or min(n - at, m - place) * (num + den) >= num * (n + m)):
                yield node, other


def candidates(batches, num: int, den: int):
    """(token, n, at, node) sorted by token and n to links of nodes that may be linked, without those that join nothing new."""
    forest, token, held = Forest(), None, []

    def out():
        return [pair for pair in may_link(held, num, den) if forest.join(*pair)]

    for batch in batches:
        found = []
        for t, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if t != token:
                found += out()
                token, held = t, []
            held.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([a for a, _ in found], [b for _, b in found])], names=["a", "b"])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out())] or [pa.array([], pa.int64())] * 2, names=["a", "b"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets (of a left one with a later left one if there are none):
    partial overlaps, counted for one fragment of the n-gram order after the other, are summed.  In a fragment, an n-gram of few
    sets counts for its pairs one by one, the others as a matrix of sets by n-grams."""
    both = left + (right or [])
    n_left, n = len(left), len(both)
    shape = (n_left, n - n_left) if right is not None else (n, n)
    total = np.zeros(shape[0] * shape[1], dtype=np.int64)
    grams = np.concatenate(both) if both else np.zeros(0, dtype=np.uint64)
    node = np.repeat(np.arange(n), [len(g) for g in both])
    order = np.argsort(grams, kind="stable")
    grams, node = grams[order], node[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, dtype=np.int64)
    often = np.diff(np.append(first, len(grams)))
    for at in range(0, len(first), FRAGMENT):
        begin, size = first[at: at + FRAGMENT], often[at: at + FRAGMENT]
        for k in range(2, FEW + 1):
            rows = begin[size == k]
            if not len(rows):
                continue
            held = node[rows[:, None] + np.arange(k)]
            for x in range(k):
                for y in range(x + 1, k):
                    i, j = held[:, x], held[:, y]  # in order, for the sort is stable
                    if right is not None:
                        across = (i < n_left) & (j >= n_left)
                        i, j = i[across], j[across] - n_left
                    np.add.at(total, i * shape[1] + j, 1)
        many = begin[size > FEW]
        if len(many):
            sizes = size[size > FEW]
            column = np.repeat(np.arange(len(many)), sizes)
            held = np.repeat(many - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(column))
            for c in range(0, len(many), COLUMNS):
                a, b = np.searchsorted(column, [c, c + COLUMNS])
                here = np.zeros((n, min(COLUMNS, len(many) - c)), dtype=np.float32)
                here[node[held[a:b]], column[a:b] - c] = 1
                total += (here[:n_left] @ (here[n_left:] if right is not None else here).T).astype(np.int64).ravel()
    return total.reshape(shape)


def links(left: list, right: list | None, num: int, den: int):
    """Pairs of (node, grams) lists that reach the threshold and join something new."""
    inter = overlaps([g for _, g in left], None if right is None else [g for _, g in right])
    n_left = np.array([len(g) for _, g in left])
    n_right = n_left if right is None else np.array([len(g) for _, g in right])
    union = n_left[:, None] + n_right[None, :] - inter
    hit = den * inter >= num * union
    if right is None:
        hit = np.triu(hit, 1)  # below, and on the diagonal, not all is counted
    forest, other = Forest(), left if right is None else right
    for i, j in zip(*np.nonzero(hit)):
        if forest.join(left[i][0], other[j][0]):
            yield left[i][0], other[j][0]


def verified(batches, num: int, den: int):
    """(cluster, i, j, side, node, grams), sorted by cluster, i and j, to links."""
    def out(key, rows):
        left = [(n, g) for s, n, g in rows if s == key[1]]
        right = [(n, g) for s, n, g in rows if s != key[1]]
        found = list(links(left, None if key[1] == key[2] else right, num, den)) if left and (right or key[1] == key[2]) else []
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    now, held = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j")))
        for key, side, node, raw in zip(keys, batch.column("side").to_pylist(), batch.column("node").to_pylist(), batch.column("grams")):
            if key != now and held:
                yield out(now, held)
                held = []
            now = key
            held.append((side, node, np.frombuffer(raw.as_py(), dtype=np.uint64)))
    if held:
        yield out(now, held)


def linked(known: DataFrame, frequent: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` that connect what the threshold connects, of sets (node, n, grams), with the ``frequent`` n-grams by class."""
    classes = frequency_classes(frequent)
    tokens = known.select("node", "grams").mapInArrow(in_tasks(prefix_rows, classes=classes, num=num, den=den), "token long, n int, at int, node long")
    tokens = tokens.repartition("token").sortWithinPartitions("token", "n", "node")
    clusters = components(tokens.mapInArrow(in_tasks(candidates, num=num, den=den), "a long, b long"))
    sizes = stored(clusters.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")), "clusters")
    large = sizes.filter(F.col("nodes") > BLOCK)
    small = clusters.join(sizes.filter(F.col("nodes") <= BLOCK), "component")
    pairs = small.select("node", F.col("component").alias("cluster"), *[F.lit(0).alias(c) for c in ("side", "i", "j")])
    if large.isEmpty():
        return compared(known, pairs, num, den)
    # nodes of the large clusters, with the component that the links found so far give them
    placed = stored(clusters.join(large, "component").select("node", F.col("component").alias("cluster"), F.col("node").alias("part")), "placed")
    few, found = compared(known, pairs, num, den), None
    for k in range(PIVOT_ROUNDS):
        found, placed = contracted(known, found, placed, k, num, den)
        left = outside(placed).filter(~F.col("main")).groupBy("cluster").count().agg(F.max("count")).first()[0]
        if left is None:  # every large cluster is one part
            return few.union(found)
        if left <= BLOCK:
            break
    rest = compared(known, across(placed), num, den)
    return few.union(rest if found is None else found.union(rest))


def compared(known: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Links of ``pairs`` (node, cluster, side, i, j): the sets of side i with those of side j, or with each other if i is j.

    The pairs are written first, so that Spark knows their size: while they are small, the sets that are in none are not exchanged."""
    pairs = stored(pairs, "pairs")
    rows = known.select("node", "grams").join(pairs, "node").select("cluster", "i", "j", "side", "node", "grams")
    rows = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return rows.mapInArrow(in_tasks(verified, num=num, den=den), "a long, b long")


def blocks_of(nodes: DataFrame, *keys: str) -> DataFrame:
    """``nodes`` with ``block``: about ``BLOCK`` of the same keys have the same, and ``blocks``, how many there are."""
    sizes = nodes.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    return nodes.join(sizes, list(keys)).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))


def outside(placed: DataFrame) -> DataFrame:
    """``placed`` with ``main``: whether a node is in the largest part of its cluster."""
    parts = placed.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("cluster").agg(F.max(F.struct("n", "part"))["part"].alias("largest"))
    return placed.join(largest, "cluster").select("node", "cluster", "part", (F.col("part") == F.col("largest")).alias("main"))


def contracted(known: DataFrame, found: DataFrame | None, placed: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The links after all nodes outside the largest part of their cluster (in the first round: all) were compared with a few
    of them; and the nodes with the parts that these links make.  What links the largest part with others is found by ``across``."""
    open_ = outside(placed).filter(~F.col("main")) if k else placed
    order = Window.partitionBy("cluster", "salt").orderBy("h")
    some = open_.withColumn("h", F.xxhash64(F.lit(k), "node")).withColumn("salt", F.pmod("h", F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PIVOTS)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy("h"))).filter(F.col("rank") <= PIVOTS)
    pivots = some.select("node", "cluster")
    blocks = blocks_of(open_, "cluster")
    others = blocks.join(pivots.select("node"), "node", "left_anti").select("node", "cluster", F.col("block").alias("side"), F.col("block").alias("i"), F.lit(-1).alias("j"))
    each = blocks.select("cluster", F.col("block").alias("i")).distinct()
    here = pivots.join(each, "cluster").select("node", "cluster", F.lit(-1).alias("side"), "i", F.lit(-1).alias("j"))
    new = stored(compared(known, others.union(here), num, den), "links")
    found = new if found is None else found.union(new)
    groups = components(found).withColumnRenamed("component", "part")
    return found, stored(placed.drop("part").join(groups, "node", "left").select("node", "cluster", F.coalesce("part", "node").alias("part")), "placed")


def across(placed: DataFrame) -> DataFrame:
    """Pairs of blocks that hold all pairs of nodes of a cluster but those inside its largest part."""
    blocks = blocks_of(outside(placed), "cluster", "main")
    # blocks of the largest part are numbered behind the others
    counts = blocks.groupBy("cluster").agg(F.coalesce(F.max(F.when(~F.col("main"), F.col("blocks"))), F.lit(0)).alias("n_open"),
                                           F.coalesce(F.max(F.when(F.col("main"), F.col("blocks"))), F.lit(0)).alias("n_main")).filter("n_open > 0")
    placed = blocks.join(counts, "cluster").withColumn("side", F.col("block") + F.when(F.col("main"), F.col("n_open")).otherwise(0))
    last = F.when(F.col("main"), F.col("n_open")).otherwise(F.col("n_open") + F.col("n_main")) - 1
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return pairs.select("node", "cluster", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """For each row of ``docs``: ``id_col``, ``text_hash``, ``n_shingles``, ``group`` (the same for all rows of a component,
    NULL for an empty set) and ``component_id``, its smallest id: texts link when their Jaccard similarity is at least num/den."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    base = stored(rows.mapInArrow(in_tasks(sets, size=size), f"id {kind}, text_hash long, n long, node long"), "sets")
    # a node is fetched by the row with the smallest id and, of that id, the smallest hash; ids that are NULL come last
    nodes = base.filter("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "text_hash")).alias("row"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    nodes = stored(nodes.select("node", F.col("row.id").alias("least"), F.col("row.text_hash").alias("text_hash"), "copies", "n"), "nodes")
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = min(1.0, 2.2 * (den - num) / num)
    maybe, _ = crowded(rows.select("text"), size, share, num, den, total)
    chosen = nodes.join(maybe, "node", "left_semi").select("node", F.col("least").alias("id"), "text_hash")
    named = rows.join(chosen.filter("id is not null"), ["id", "text_hash"]).dropDuplicates(["id", "text_hash"]).select("node", "text")
    nameless = rows.filter("id is null").join(chosen.filter("id is null").select("node", "text_hash"), "text_hash").select("node", "text").dropDuplicates(["node"])
    known = stored(named.union(nameless).mapInArrow(in_tasks(chosen_sets, size=size), "node long, n long, grams binary"), "chosen")
    again, frequent = crowded(known, None, 1.0, num, den, known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], tally=True)
    known = stored(known.join(stored(again, "open"), "node", "left_semi"), "open-sets")
    groups = components(linked(known, frequent, num, den))
    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # texts that are alone need no name from the others
    named = named.join(least, "component").filter("copies > 1 or component <> node or not component_id <=> least")
    named = named.select(F.col("node").alias("of"), "component", "component_id")
    out = base.join(named, base["node"] == named["of"], "left")
    return out.select(F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("group"),
                      F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` without near duplicates: of each component one row with the smallest id stays.  Texts without words are
    nobody's duplicates; of rows of the same id without words one stays."""
    mine, key, group, kept = fresh(docs, "mine_", "hash_", "group_", "kept_")
    found = join(docs, id_col=id_col, text_col=text_col, size=size, num=num, den=den)
    keep = found.filter(col(id_col).eqNullSafe(F.col("component_id"))).groupBy(col(id_col).alias(mine), F.col("group").alias(group)).agg(F.min(F.col("text_hash")).alias(kept))
    tagged = docs.withColumn(key, F.xxhash64(col(text_col).cast("string")))
    one = tagged.join(keep, tagged[id_col].eqNullSafe(F.col(mine)) & tagged[key].eqNullSafe(F.col(kept)), "left_semi")
    return one.dropDuplicates([id_col, key]).drop(key)


#: All pairs that share a shingle, and what can be reached from a document by links, for ``op5_ngram_join``.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, unnest(list_distinct([array_to_string(ws[i : i + 2], ' ') for i in range(1, greatest(len(ws) - 1, 2))])) AS shingle
  FROM d WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, a AS b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""
