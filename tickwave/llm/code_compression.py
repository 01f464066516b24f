"""Vector code compression: product codebooks by dual-tree Lloyd rounds, in whole numbers.

Vectors are cut into parts; every part position has its own codebook, and each
round assigns every part to the nearest entry and moves the entries to their
parts' means.

Two trees meet in each assignment.  The parts of a block of vectors form a
balanced tree (halved at the median of the widest component) whose nodes hold a
box, a count and the sum of their parts.  The entries form a small tree of boxes.
Pairs of a part node and an entry node go down together: an entry node whose
least distance exceeds another's greatest distance is dropped, and a part node
left with a single entry hands over its count and cached sum as a whole.  Where
several entries are still possible at a leaf, exact integer distances decide.
Boxes and distances are integers too, so nothing is rounded, and a dropped entry
is strictly farther away: ties stay ties and go to the lower index.

Scale: the trees are built once, a block of ``BLOCK`` vectors at a time, and stored
in the shared folder.  A round reads the blocks, carries the codebooks along
(some thousand numbers) and sends one row of sums for each task, part position
and entry to be added up.  A lost executor's blocks are read again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import words as W
from tickwave.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 4096
LEAF = 16
#: Ways in which a label's rows are spread before its total is joined to them.
SALTS = 64


class Tree:
    """A balanced tree over the rows of ``points``: level l has 2**l nodes, and
    node j holds the rows from n*j/2**l to n*(j+1)/2**l of the tree's order."""

    def __init__(self, points: np.ndarray, order: np.ndarray | None = None, leaf: int = LEAF):
        n = len(points)
        self.depth = 0
        while n >> self.depth > leaf:
            self.depth += 1
        if order is None:
            order = np.arange(n)
            for level in range(self.depth):
                edge = self.edges(n, level)
                p = points[order]
                wide = (np.maximum.reduceat(p, edge[:-1]) - np.minimum.reduceat(p, edge[:-1])).argmax(axis=1)
                node = np.repeat(np.arange(1 << level), np.diff(edge))
                order = order[np.lexsort((p[np.arange(n), wide[node]], node))]
        self.order, self.points = order, points[order]
        self.low, self.high, self.sum, self.edge = [], [], [], []
        for level in range(self.depth + 1):
            edge = self.edges(n, level)
            self.edge.append(edge)
            self.low.append(np.minimum.reduceat(self.points, edge[:-1]))
            self.high.append(np.maximum.reduceat(self.points, edge[:-1]))
            self.sum.append(np.add.reduceat(self.points, edge[:-1]))

    @staticmethod
    def edges(n: int, level: int) -> np.ndarray:
        return n * np.arange((1 << level) + 1) >> level


def assign(tree: Tree, entries: Tree, codes: bool = False):
    """Counts and sums of the parts nearest to each entry; with ``codes`` also the
    entry of every part, in the points' own order."""
    k, width = int(entries.order.max()) + 1, tree.points.shape[1]
    count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    code = np.empty(len(tree.points), np.int64)

    # pairs (part node x, entry node c), sorted by x; both levels go down together
    level, deep = 0, 0
    x, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        low, high = tree.low[level][x], tree.high[level][x]
        elow, ehigh = entries.low[deep][c], entries.high[deep][c]
        gap = np.maximum(0, np.maximum(elow - high, low - ehigh))
        far = np.maximum(ehigh - low, high - elow)
        least, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
        first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        bound = np.repeat(np.minimum.reduceat(most, first), np.diff(np.concatenate((first, [len(x)]))))
        near = least <= bound
        x, c = x[near], c[near]
        if deep < entries.depth:
            deep += 1
            x, c = np.repeat(x, 2), np.repeat(2 * c, 2)
            c[1::2] += 1
            continue
        first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        n = np.diff(np.concatenate((first, [len(x)])))
        for at in first[n == 1]:  # one entry is left: the whole node is its own
            i, e, edge = x[at], c[at], tree.edge[level]
            who = entries.order[e]
            count[who] += edge[i + 1] - edge[i]
            total[who] += tree.sum[level][i]
            code[edge[i]:edge[i + 1]] = who
        open_ = np.repeat(n > 1, n)
        x, c = x[open_], c[open_]
        if not len(x):
            break
        if level == tree.depth:
            _leaves(tree, entries, x, c, count, total, code)
            break
        level += 1
        first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        n = np.diff(np.concatenate((first, [len(x)])))
        # every part node's list of entries, once for each child
        again = np.repeat(np.arange(len(first)), 2)
        at = np.repeat(first[again], n[again]) + _within(n[again])
        x = np.repeat(2 * x[first[again]] + np.arange(len(again)) % 2, n[again])
        c = c[at]
    if not codes:
        return count, total
    out = np.empty(len(code), np.int64)
    out[tree.order] = code
    return count, total, out


def _within(n: np.ndarray) -> np.ndarray:
    """0 to n-1 for every n, end to end."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _leaves(tree: Tree, entries: Tree, x, c, count, total, code) -> None:
    """Exact distances of the parts of uncertain leaves to their possible entries."""
    k = len(count)
    edge = tree.edge[tree.depth]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    leaf = x[first]
    place = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in leaf])
    row = np.repeat(np.arange(len(leaf)), edge[leaf + 1] - edge[leaf])
    possible = np.zeros((len(leaf), k), bool)
    possible[np.cumsum(np.concatenate(([0], x[1:] != x[:-1]))), entries.order[c]] = True
    own = np.empty((k, entries.points.shape[1]), np.int64)
    own[entries.order] = entries.points
    best, who = np.full(len(place), np.iinfo(np.int64).max), np.zeros(len(place), np.int64)
    p = tree.points[place]
    for e in range(k):  # in index order, so that ties stay with the lower one
        some = np.flatnonzero(possible[row, e])
        d = p[some] - own[e]
        d = (d * d).sum(axis=1)
        less = d < best[some]
        best[some[less]] = d[less]
        who[some[less]] = e
    count += np.bincount(who, minlength=k)
    np.add.at(total, who, p)
    code[place] = who


def entry_tree(book: np.ndarray) -> Tree:
    """A tree with one entry a leaf; a number of entries that is no power of two
    is filled up with the first one again."""
    k = len(book)
    index = np.concatenate((np.arange(k), np.zeros((1 << (k - 1).bit_length()) - k, np.int64)))
    tree = Tree(book[index], leaf=1)
    tree.order = index[tree.order]
    return tree


def limit_of(dim: int) -> int:
    """Components are held within these bounds, so that an error fits in 63 bits."""
    return int((2.0**62 / dim) ** 0.5) // 2


def whole_numbers(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """Kept rows as (vec_id, label, v): v holds the whole-number components."""
    x = F.col("_v")
    ok = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    # the bounds keep the product of a huge component inside a long before it is cut to them
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(2.0**40)), F.lit(-2.0**40))).cast("long"))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col(vector).cast("array<double>").alias("_v"))
            .filter(ok).select("vec_id", "label", whole.alias("v")))


def store_blocks(rows: DataFrame, dim: int, parts: int = PARTS) -> DataFrame:
    """Blocks of vectors with the orders of their trees, one a part position."""
    bound, width = limit_of(dim), dim // parts

    def run(batches):
        held, n = [], 0

        def block():
            b = pa.Table.from_batches(held).combine_chunks()
            points = np.clip(b.column(2).combine_chunks().flatten().to_numpy().reshape(-1, dim), -bound, bound)
            order = [Tree(points[:, p * width:(p + 1) * width]).order.astype(np.int32) for p in range(parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([b.column(1).to_pylist()], pa.list_(pa.int64())),
                 pa.array([points.astype(np.int32).tobytes()], pa.binary()), pa.array([np.stack(order).tobytes()], pa.binary())],
                names=["ids", "labels", "points", "orders"])

        for b in batches:
            while len(b):
                some = b.slice(0, BLOCK - n)
                b = b.slice(len(some))
                held.append(some)
                n += len(some)
                if n == BLOCK:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    one_dim = rows.filter(F.size("v") == dim).select("vec_id", "label", "v")
    return materialize(one_dim.mapInArrow(W.trimmed(run), "ids array<long>, labels array<long>, points binary, orders binary"), "code_blocks")


def _trees(points: bytes, orders: bytes, dim: int, parts: int):
    whole = np.frombuffer(points, np.int32).reshape(-1, dim).astype(np.int64)
    order = np.frombuffer(orders, np.int32).reshape(parts, -1)
    width = dim // parts
    return whole, [Tree(whole[:, p * width:(p + 1) * width], order[p]) for p in range(parts)]


def one_round(blocks: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """The codebooks after one assignment of every part."""
    parts, k = len(books), len(books[0])

    def run(batches):
        trees = [entry_tree(b) for b in books]
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, dim // parts), np.int64)
        for b in batches:
            for points, orders in zip(b.column(0), b.column(1)):
                for p, t in enumerate(_trees(points.as_py(), orders.as_py(), dim, parts)[1]):
                    n, s = assign(t, trees[p])
                    count[p] += n
                    total[p] += s
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                                         names=["part", "entry", "n", "s"])

    sums = blocks.select("points", "orders").mapInArrow(W.trimmed(run), "part long, entry long, n long, s array<long>")
    added = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim // parts)]).alias("s")).collect()
    out = [b.copy() for b in books]
    for r in added:  # parts x entries rows at most
        out[r.part][r.entry] = np.array(r.s, np.int64) // r.n
    return out


def codes(blocks: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector for these codebooks."""
    parts = len(books)

    def run(batches):
        trees = [entry_tree(b) for b in books]
        for b in batches:
            for ids, labels, points, orders in zip(*(b.column(i) for i in range(4))):
                whole, own = _trees(points.as_py(), orders.as_py(), dim, parts)
                code = np.stack([assign(t, trees[p], codes=True)[2] for p, t in enumerate(own)], axis=1)
                near = np.concatenate([books[p][code[:, p]] for p in range(parts)], axis=1)
                text = code.astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]),
                     pa.array(((whole - near) ** 2).sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return blocks.select("ids", "labels", "points", "orders").mapInArrow(
        W.trimmed(run), "vec_id long, label long, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds the errors' total over rows of equal label.  The totals are added up
    before they move, and joined by (label, salt), so a label that a third of all
    rows share is spread over many tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    total = rows.groupBy("label").agg(F.try_sum("error").alias("label_error")).select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    return salted.join(total, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("s")), "left")


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector.

    Dropped are rows whose vector is null, empty, of a length that ``parts`` does
    not divide or other than the first kept row's, or holds null or non-finite
    components; the first kept row is that of the smallest vec_id, then vector.
    Components beyond :func:`limit_of` (32,768 before scaling at 64 dimensions)
    are held at that bound, so that errors are longs; a label's total beyond a long
    is null.  Rows that repeat a vec_id are rows of their own (the first codebook
    takes them in order of the vector), null vec_ids come last, null labels count
    as one.  Fewer kept rows than entries give as many entries.  An empty table
    gives an empty result; other columns are ignored.
    """
    rows = whole_numbers(vectors, vector, parts=parts)
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    head = rows.orderBy(*order).limit(1).collect()
    if not head:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).filter("false")
    dim = len(head[0].v)
    start = rows.filter(F.size("v") == dim).orderBy(*order).limit(entries).collect()
    blocks = store_blocks(rows, dim, parts)
    first = np.clip(np.array([r.v for r in start], np.int64).reshape(len(start), dim), -limit_of(dim), limit_of(dim))
    width = dim // parts
    books = [np.ascontiguousarray(first[:, p * width:(p + 1) * width]) for p in range(parts)]
    for _ in range(rounds):
        books = one_round(blocks, books, dim)
    numbers = ",".join(str(x) for b in books for e in b.tolist() for x in e)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    found = materialize(codes(blocks, books, dim), "codes")
    return with_label_error(found).select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
