"""Hard-negative mining with bounds along spanning trees of the anchors.

Vectors are scored by integer inner products (components are ``floor(scale * x)``). For two
anchors a and p and any candidate c, |a.c - p.c| <= |a - p| * |c|. So the anchors are put into
trees of at most ``TREE`` each, near ones together (a range layout by label and signs of fixed
projections), each a minimum spanning tree of their distances. In a block of candidates the
root is scored in full; down the tree, a child's scores lie within its parent's bounds plus
or minus edge length times candidate norm, and only the candidates whose bounds overlap the
window looked for are scored again (their bounds then are the score).

1. Positives: rows of the anchor's label whose upper bound reaches the last of the best ones
   so far; the first ``positives`` of each anchor.
2. Negatives: rows of other labels whose bounds overlap one of the windows
   [low% .. high%] of a positive's score; the first ``negatives`` of each window.

Trees (a stated query set) go against all rows in blocks of ``BLOCK``: in rounds of
``ROUND_BYTES``, a round's trees are broadcast and meet every block where it lies; the rows are
neither shuffled nor paired. A task keeps the best few of each anchor over all its blocks, so
what leaves it is bounded by the round, and a window picks the best over all tasks. Bounds are
widened by a relative 1e-9, far above the rounding of their arithmetic; scores are exact
(doubles below 2^53, else Python integers).

Defined results: rows with a NULL label, a NULL vector or any NULL or non-finite component take
no part; a vector that is shorter than another counts as filled up with zeros; equal rows (id,
label and vector) count once; a NULL id is no anchor and comes last among ties; the anchor's
own id is never its positive; equal ids with other content are rows like any other. Without a
positive, or a negative in the window (a negative positive score has an empty one), an anchor
gives no rows. Components and scores beyond 64 bits are held at the limits. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import store
from keelson.operators.ordered import dense_ids
from keelson.session import scratch_dir

TREE = 256
BLOCK = 4096
ROUND_BYTES = 32 << 20
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_SLACK = 1e-9
_SIGNS = 16
_TREE = ("tree long, ids array<long>, labels array<long>, vectors binary, wide int, "
         "parents array<int>, edges array<double>")
_FOUND = "tree long, place int, anchor long, window int, id long, score long"


def prepared(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label: Column | str = "label", scale: int = 256) -> DataFrame:
    """(id, label, vector): the rows that take part, components as integers."""
    label = F.col(label) if isinstance(label, str) else label
    number = lambda x: x.cast("double")
    whole = F.transform(F.col(vector_col), lambda x: F.floor(number(x) * scale))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(number(x))
                      & (F.abs(number(x)) < float("inf")))
    taken = rows.filter(F.col(vector_col).isNotNull() & label.isNotNull()).filter(finite)
    return taken.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        whole.alias("vector")).distinct()


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of 64-bit integers, short ones filled up with zeros."""
    offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(False)
    size = np.diff(offsets)
    out = np.zeros((len(size), max(1, int(size.max(initial=0)))), np.int64)
    if (size == out.shape[1]).all():
        out[:] = flat[offsets[0]:offsets[-1]].reshape(out.shape)
    else:
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            out[k, :b - a] = flat[a:b]
    return out


class _Block:
    """Candidates: their ids, labels, norms, and exact inner products with single vectors."""

    def __init__(self, ids: pa.Array, labels: pa.Array, vectors: np.ndarray, longest: float):
        self.ids = ids.fill_null(0).to_numpy(False)
        self.unnamed = ids.is_null().to_numpy(False)
        self.labels = labels.to_numpy(False)
        near = vectors.astype(np.float64)
        self.norms = np.sqrt((near * near).sum(axis=1))
        # sums of products stay below the product of the norms
        self.plain = float(self.norms.max(initial=0.0)) * longest < _EXACT
        self.rows = near if self.plain else vectors.astype(object)

    def scores(self, vector: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of some rows, as doubles for the bounds and as they are returned."""
        n = min(self.rows.shape[1], len(vector))  # what is missing is zero
        found = self.rows[some, :n] @ vector[:n].astype(self.rows.dtype)
        if self.plain:
            return found, found
        held = [max(-_LONG, min(_LONG, int(x))) for x in found]
        return found.astype(np.float64), np.array(held, np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Prim's minimum spanning tree from the row nearest to the mean: the order of the rows
    (parents first), each one's parent as a place in that order, and the edge lengths."""
    v = vectors.astype(np.float64)
    apart = lambda x: np.sqrt(((v - x) ** 2).sum(axis=1))
    order, parents, edges = [int(np.argmin(apart(v.mean(axis=0))))], [-1], [0.0]
    nearest, by = np.full(len(v), np.inf), np.zeros(len(v), int)
    outside = np.ones(len(v), bool)
    while True:
        last = order[-1]
        outside[last] = False
        if not outside.any():
            return order, parents, edges
        d = apart(v[last])
        closer = d < nearest
        nearest[closer], by[closer] = d[closer], len(order) - 1
        new = int(np.argmin(np.where(outside, nearest, np.inf)))
        order.append(new)
        parents.append(int(by[new]))
        edges.append(float(nearest[new]))


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with the signs of fixed projections, which near ones mostly share."""
    for batch in batches:
        v = _matrix(batch.column(2)).astype(np.float64)
        fixed = np.random.default_rng(5).standard_normal((v.shape[1], _SIGNS))
        key = ((v @ fixed) > 0) @ (1 << np.arange(_SIGNS))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.int64())],
                                         ["id", "label", "vector", "near"])


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of consecutive anchors: a row for each tree."""
    part, number = TaskContext.get().partitionId(), 0

    def tree(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids, labels, vectors = (rows.column(c).combine_chunks() for c in range(3))
        matrix = _matrix(vectors)
        order, parents, edges = spanning_tree(matrix)
        longest = float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)).max())
        reach = [e * (1 + _SLACK) + longest * _SLACK for e in edges]
        one = lambda v, t: pa.array([v], t)
        return pa.RecordBatch.from_arrays(
            [one((part << 32) | number, pa.int64()),
             one(ids.take(pa.array(order)).to_pylist(), pa.list_(pa.int64())),
             one(labels.take(pa.array(order)).to_pylist(), pa.list_(pa.int64())),
             one(matrix[order].tobytes(), pa.binary()), one(matrix.shape[1], pa.int32()),
             one(parents, pa.list_(pa.int32())), one(reach, pa.list_(pa.float64()))],
            [c.split()[0] for c in _TREE.split(", ")])

    held = None
    for batch in batches:
        more = pa.Table.from_batches([batch])
        held = more if held is None else pa.concat_tables([held, more])
        while len(held) >= TREE:
            yield tree(held.slice(0, TREE))
            number += 1
            held = held.slice(TREE)
    if held is not None and len(held):
        yield tree(held)


def plant_trees(anchors: DataFrame) -> DataFrame:
    """The trees of the anchors (id, label, vector), numbered, in rounds of bounded size."""
    near = store(anchors.mapInArrow(_signs, "id long, label long, vector array<long>, near long"),
                 "anchors")
    order = ["label", "near", "id"]
    parts = max(1, math.ceil(near.count() / (16 * TREE)))
    trees = store(near.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .select("id", "label", "vector").mapInArrow(_plant, _TREE), "anchor_trees")
    largest = trees.agg(F.max(F.octet_length("vectors"))).first()[0] or 1
    numbers = dense_ids(trees.select("tree"), [F.col("tree")], "number")
    return store(trees.join(numbers, "tree").withColumn("round", F.floor(
        (F.col("number") - 1) / max(1, ROUND_BYTES // largest)).cast("int")), "tree_rounds")


class _Tree:
    def __init__(self, row):
        self.name, self.ids, self.labels, self.parents, self.edges = (
            row["tree"], row["ids"], row["labels"], row["parents"], row["edges"])
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(-1, row["wide"])
        near = self.vectors.astype(np.float64)
        self.longest = float(np.sqrt((near * near).sum(axis=1)).max())
        #: Windows looked for, for each anchor: (lowest, highest) score.
        self.windows: list[list[tuple[float, float]]] = [[] for _ in self.ids]

    def visit(self, block: _Block, wanted) -> Iterator[tuple]:
        """(place, candidates, scores) down the tree. ``wanted(place, low, high)`` has the
        rows to be scored again, given their bounds."""
        low = np.empty((len(self.ids), len(block.ids)))
        high = np.empty_like(low)
        every = np.arange(len(block.ids))
        for place in range(len(self.ids)):
            parent = self.parents[place]
            if parent < 0:
                low[place] = high[place] = block.scores(self.vectors[place], every)[0]
            else:
                reach = self.edges[place] * block.norms
                low[place], high[place] = low[parent] - reach, high[parent] + reach
            some = wanted(place, low[place], high[place])
            near, exact = block.scores(self.vectors[place], some)
            low[place, some] = high[place, some] = near
            yield place, some, exact


class _Best:
    """The first ``most`` candidates seen: higher scores, then smaller ids."""

    def __init__(self, most: int):
        self.most, self.ids, self.unnamed, self.scores = most, [], [], []

    @property
    def last(self) -> float:
        """The score a further candidate has to reach."""
        return float(self.scores[-1]) if len(self.scores) == self.most else -np.inf

    def add(self, block: _Block, some: np.ndarray, scores: np.ndarray) -> None:
        if not len(some):
            return
        ids = np.concatenate((self.ids, block.ids[some])).astype(np.int64) if len(
            self.ids) else block.ids[some]
        unnamed = np.concatenate((self.unnamed, block.unnamed[some])).astype(bool) if len(
            self.ids) else block.unnamed[some]
        scores = np.concatenate((self.scores, scores)) if len(self.ids) else scores
        first = np.lexsort((ids, unnamed, -scores))[:self.most]
        self.ids, self.unnamed, self.scores = ids[first], unnamed[first], scores[first]


def _rows(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """The best of each (tree, place, anchor, window) as rows of ``_FOUND``."""
    schema = ("int64", "int32", "int64", "int32", "int64", "int64")
    columns = [[] for _ in schema]
    for tree, place, anchor, window, best in found:
        for i, unnamed, score in zip(best.ids, best.unnamed, best.scores):
            for c, v in zip(columns, (tree, place, anchor, window, None if unnamed else int(i),
                                      int(score))):
                c.append(v)
    if columns[0]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema)],
            [c.split()[0] for c in _FOUND.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch], longest: float) -> Iterator[_Block]:
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            part = batch.slice(start, BLOCK)
            # a slice's list offsets do not begin at 0; _matrix reads them as they are
            yield _Block(part.column(0), part.column(1), _matrix(part.column(2)), longest)


def _positive_finder(trees, most: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = trees.value
        best = [[_Best(most) for _ in t.ids] for t in forest]
        for block in _blocks(batches, max(t.longest for t in forest)):
            alike = {v: np.flatnonzero(block.labels == v) for v in np.unique(block.labels)}
            none = np.zeros(0, int)
            for tree, held in zip(forest, best):
                def wanted(place, low, high):
                    same = alike.get(tree.labels[place], none)
                    other = block.unnamed[same] | (block.ids[same] != tree.ids[place])
                    return same[other & (high[same] >= held[place].last)]
                for place, some, scores in tree.visit(block, wanted):
                    held[place].add(block, some, scores)
        yield from _rows((t.name, place, t.ids[place], 0, b) for t, held in zip(forest, best)
                         for place, b in enumerate(held))

    return find


def _negative_finder(trees, most: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = trees.value
        best = [[[_Best(most) for _ in w] for w in t.windows] for t in forest]
        for block in _blocks(batches, max(t.longest for t in forest)):
            for tree, held in zip(forest, best):
                def wanted(place, low, high):
                    over = np.zeros(len(low), bool)
                    for (least, top), seen in zip(tree.windows[place], held[place]):
                        over |= (high >= max(least, seen.last)) & (low <= top)
                    return np.flatnonzero(over & (block.labels != tree.labels[place]))
                for place, some, scores in tree.visit(block, wanted):
                    for (least, top), seen in zip(tree.windows[place], held[place]):
                        inside = (scores >= least) & (scores <= top)
                        seen.add(block, some[inside], scores[inside])
        yield from _rows((t.name, place, t.ids[place], k, b) for t, held in zip(forest, best)
                         for place, windows in enumerate(held) for k, b in enumerate(windows))

    return find


def _first(found: DataFrame, most: int) -> DataFrame:
    """The best over all tasks, with their rank."""
    best = Window.partitionBy("tree", "place", "window").orderBy(
        F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def _search(rows: DataFrame, trees: DataFrame, finder, most: int, name: str,
            windows: tuple[int, int] | None = None) -> DataFrame:
    """``finder`` for all trees over all rows, a job for each round."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, name)
    rounds = trees.agg(F.max("round")).first()[0]
    for number in range(-1 if rounds is None else rounds + 1):
        forest = []
        for row in trees.filter(F.col("round") == number).collect():
            tree = _Tree(row)
            for x in (row["positives"] or []) if windows else []:
                # score in [low% .. high%] of the positive's, in whole numbers
                least, top = (-(-x["score"] * windows[0] // 100), x["score"] * windows[1] // 100)
                tree.windows[x["place"]].append((least, top))
            forest.append(tree)
        sent = spark.sparkContext.broadcast(forest)
        rows.mapInArrow(finder(sent, most), _FOUND).write.mode("append").parquet(path)
        sent.unpersist()
    if rounds is None:  # no anchors
        return _first(spark.createDataFrame([], _FOUND), most)
    return _first(spark.read.schema(_FOUND).parquet(path), most)


def mine_hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3,
                        low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    rows of ``prepared`` that ``anchors`` is true for."""
    rows = store(rows, "candidates")
    trees = plant_trees(rows.filter(anchors & F.col("id").isNotNull()))
    found = store(_search(rows, trees, _positive_finder, positives, "positive_rows"), "positives")
    listed = found.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(
        "place", "rank", "id", "score"))).alias("positives"))
    wanted = store(trees.join(listed, "tree", "left"), "tree_windows")
    first = _search(rows, wanted, _negative_finder, negatives, "negative_rows", (low, high))
    near = found.select("tree", "place", (F.col("rank") - 1).alias("window"),
                        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return first.join(near, ["tree", "place", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
