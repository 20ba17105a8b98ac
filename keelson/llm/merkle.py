"""Merkle dataset manifest: a content-addressed DAG of digests, and proofs by descent.

Leaves. A row's leaf is the SHA-256 (lower-case hex; digests are hashed as hex text) of its
columns, each ``-`` if NULL, else its length in UTF-8 bytes, ``:`` and its value. The rows of
a group, by id, are the leaves of a tree: every ``FANOUT`` consecutive nodes (the last run may
be shorter) become the digest of theirs, level by level, until one remains, the subroot. The
subroots, by group (NULL first, bytewise), become the root in the same way.

Storage. Each level is a table of records, digest to children, written before the next one is
begun. Ranks come from a range layout with prefix sums, so a group that holds most rows is
spread over all tasks; levels shrink by eight.

Proofs. Requests descend from the root by the digits of their ranks: a level looks up the
records of its nodes' digests, takes the wanted children and notes the other ones as a
segment of the path. Requests under one node are one row until the last level, where every
leaf gets the segments of its run and, in reverse order, those of the way down. A digest that
many nodes share (repeated rows) is served by ``lookup``.

Defined results: rows with equal ids are in the order of their leaves, NULL ids come first;
repeated rows are leaves of their own, with proofs of their own; a NULL group is a group; a
lone leaf is its tree's subroot, a lone subroot the root. Empty texts are ``0:``. Extra
columns are ignored; an empty table has no root and gives an empty result. A text only has to
fit in memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import lookup, store
from keelson.operators.ordered import dense_ids

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENT = "array<struct<left: string, right: string>>"


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row with these columns, as 32 bytes."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in values]), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


@dataclass
class Manifest:
    """``leaves``: (tree, rank, id, leaf, claimed); ``trees``: (tree, group, size, height,
    subroot); ``levels[h]`` and ``top[h]``: the records (digest, children, n) whose children
    stand at height ``h``; ``root``: one row, (digest)."""
    leaves: DataFrame
    trees: DataFrame
    root: DataFrame
    levels: list[DataFrame] = field(default_factory=list)
    top: list[DataFrame] = field(default_factory=list)


def _ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with the number of their tree and their rank in it; and the trees."""
    order = [F.col(c).asc_nulls_first() for c in ("group", "id", "leaf")]
    laid = store(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
                 "manifest_rows")
    parts = laid.groupBy("group", "part").agg(F.sum("n").alias("rows"))
    earlier = (Window.partitionBy("group").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    groups = dense_ids(parts.groupBy("group").agg(F.sum("rows").alias("size")),
                       [F.col("group").asc_nulls_first()], "tree")
    trees = store(groups.select((F.col("tree") - 1).alias("tree"), "group", "size"),
                  "manifest_trees")
    placed = parts.join(trees, parts["group"].eqNullSafe(trees["group"])).select(
        parts["group"].alias("_group"), F.col("part").alias("_part"), "tree", "size", "offset")
    before = (Window.partitionBy("group", "part").orderBy(*order[1:])
              .rowsBetween(Window.unboundedPreceding, -1))
    local = laid.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    start = F.col("offset") + F.col("before")
    leaves = local.join(placed, local["group"].eqNullSafe(placed["_group"])
                        & (local["part"] == placed["_part"])).select(
        "tree", "size", F.explode(F.sequence(start, start + F.col("n") - 1)).alias("rank"),
        "id", "leaf", "claimed")
    return store(leaves, "manifest_leaves"), trees


def _build(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of all levels above ``nodes`` (tree, size, rank, digest) and the last node of
    each tree, (tree, height, digest); ``most`` is the size of the largest tree."""
    levels, ends, height = [], [], 0
    while True:
        ends.append(nodes.filter("size = 1").select("tree", F.lit(height).alias("height"),
                                                    "digest"))
        if most <= 1:
            break
        run = (nodes.filter("size > 1").groupBy(
            "tree", "size", F.floor(F.col("rank") / FANOUT).cast("long").alias("run"))
            .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("of")))
        children = F.col("of.digest")
        nodes = store(run.select(
            "tree", F.ceil(F.col("size") / FANOUT).cast("long").alias("size"),
            F.col("run").alias("rank"), F.unhex(F.sha2(_joined(children), 256)).alias("digest"),
            children.alias("children")), f"{name}_{height}")
        levels.append(nodes.groupBy("digest").agg(F.first("children").alias("children"),
                                                  F.count(F.lit(1)).alias("n")))
        most = -(-most // FANOUT)
        height += 1
    last = ends[0]
    for more in ends[1:]:
        last = last.unionByName(more)
    return levels, store(last, f"{name}_ends")


def build_manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id",
                   group_col: str = "lang",
                   claims: Mapping[str, Column] | None = None) -> Manifest:
    """The DAG over the rows of ``docs``. ``claims`` replaces some of the columns in the
    leaves ``claimed``, which take no part in the DAG (content to be checked against it)."""
    claims = claims or {}
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("group"),
        leaf([F.col(c) for c in columns]).alias("leaf"),
        leaf([claims.get(c, F.col(c)) for c in columns]).alias("claimed"))
    leaves, trees = _ranked(rows.groupBy("id", "group", "leaf", "claimed")
                            .agg(F.count(F.lit(1)).alias("n")))
    most, count = trees.agg(F.max("size"), F.count(F.lit(1))).first()
    nodes = leaves.select("tree", "size", "rank", F.col("leaf").alias("digest"))
    levels, ends = _build(nodes, most or 0, "manifest")
    known = store(trees.join(ends, "tree").withColumnRenamed("digest", "subroot"),
                  "manifest_subroots")
    heads = known.select(F.lit(0).cast("long").alias("tree"),
                         F.lit(count).cast("long").alias("size"), F.col("tree").alias("rank"),
                         F.col("subroot").alias("digest"))
    top, root = _build(heads, count, "manifest_top")
    return Manifest(leaves.drop("size"), known, root.select("digest"), levels, top)


def _step(nodes: DataFrame, records: DataFrame) -> DataFrame:
    """The children of ``nodes`` (rank, digest, path, ...): their paths are longer by the
    segment of the children not taken."""
    found = lookup(nodes, records, "digest", "n", F.xxhash64(*[
        c for c in ("tree", "rank") if c in nodes.columns]))
    rest = [c for c in nodes.columns if c not in ("rank", "digest", "path")]
    wide = found.select(*rest, "rank", "path", "children", F.posexplode("children").alias(
        "digit", "digest"))
    return wide.select(*rest, (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), "digest",
                       F.concat("path", F.array(_segment("children", F.col("digit"))))
                       .alias("path"))


def _segment(children: str, digit: Column) -> Column:
    of = F.col(children)
    return F.struct(_joined(F.slice(of, 1, digit)).alias("left"),
                    _joined(F.slice(of, digit + 2, F.greatest(F.size(of) - digit - 1, F.lit(0))))
                    .alias("right"))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(id, leaf, claimed, subroot, root, path) for the requested leaves: all, or the (tree,
    rank) rows of ``requests``. ``path`` has the segments from the leaf to the root."""
    leaves = manifest.leaves
    asked = None
    if requests is not None:
        asked = store(requests.select("tree", "rank").distinct(), "manifest_requests")
        leaves = leaves.join(asked, ["tree", "rank"], "left_semi")

    def wanted(nodes: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
        if asked is None:
            return nodes
        some = asked.select(*keys[:-1], at.cast("long").alias(keys[-1])).distinct()
        return nodes.join(some, list(keys), "left_semi")

    # from the root to the subroots; ranks are those of the groups
    nodes = manifest.root.select(
        F.lit(0).cast("long").alias("rank"), "digest", F.col("digest").alias("root"),
        F.array().cast(_SEGMENT).alias("path"))
    for height in range(len(manifest.top) - 1, -1, -1):
        nodes = wanted(_step(nodes, manifest.top[height]), ["rank"],
                       F.floor(F.col("tree") / FANOUT ** height))
    heads = store(nodes.join(manifest.trees.select("tree", "height"),
                             nodes["rank"] == F.col("tree"))
                  .select("tree", "height", F.lit(0).cast("long").alias("rank"), "digest",
                          F.col("digest").alias("subroot"), "root", "path"), "proof_heads")
    # from the subroots to the last runs
    deep = heads.limit(0).drop("height")
    for height in range(len(manifest.levels), 0, -1):
        deep = deep.unionByName(heads.filter(F.col("height") == height).drop("height"))
        if height > 1:
            deep = store(wanted(_step(deep, manifest.levels[height - 1]), ["tree", "rank"],
                                F.floor(F.col("rank") / FANOUT ** (height - 1))),
                         f"proof_{height}")
    lone = heads.filter("height = 0").drop("height").withColumn(
        "children", F.lit(None).cast("array<binary>"))
    if manifest.levels:
        lone = lone.unionByName(lookup(deep, manifest.levels[0], "digest", "n",
                                       F.xxhash64("tree", "rank")).drop("n"))
    runs = lone.select(F.col("tree").alias("_tree"), F.col("rank").alias("_run"), "subroot",
                       "root", "path", "children")
    run = F.floor(F.col("rank") / FANOUT).cast("long")
    found = leaves.join(runs, (leaves["tree"] == runs["_tree"]) & (run == runs["_run"]))
    own = _segment("children", (F.col("rank") % FANOUT).cast("int"))
    path = F.when(F.col("children").isNull(), F.reverse("path")).otherwise(
        F.concat(F.array(own), F.reverse("path")))
    return found.select("tree", "rank", "id", "leaf", "claimed", "subroot", "root",
                        path.alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf and the siblings of its path give."""
    return F.aggregate(path, _hex(leaf), lambda node, s: F.sha2(
        F.concat(s["left"], node, s["right"]), 256))


def siblings(path: Column) -> Column:
    """Digests of all siblings, level by level, as one hex text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
