"""Merkle manifest of a dataset as a content-addressed graph, and proofs by descent from its root.

Leaves are digests of rows. Within a tree they are ordered by their key, and every ``ARITY``
consecutive nodes have their digest as parent until one node remains. The roots of all trees are the
leaves of a last tree, whose root is the manifest's. What is stored of inner nodes is one table of
records, digest to children. A request is a leaf's place; its digits in base ``ARITY`` say which child
to take at every level below the root. Requests with the same digits so far are one row, so a level
costs as many rows as it has wanted nodes. The children not taken are the level's segment of the
path; reversed, the path is the proof from the leaf up.

Ranks come from a range-partitioned sort with counts per partition, so that no tree, however much of
the table it holds, is ordered or numbered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import stored

ARITY = 8
PATH = "array<struct<digit:int,others:array<string>>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def item(column: Column) -> Column:
    """A value with its length in front, ``-`` for null: no two rows are written alike."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return digest(*map(item, columns))


def tree_name(group: Column) -> Column:
    """A group as a name that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (a written table) with ``rank`` in its tree, from 0, and ``n``, the tree's leaves."""
    spread = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stored(spread.withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "manifest-order")
    # one row per task and tree: as many as there are tasks and trees together
    spans = placed.groupBy("tree", "_task").agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    every = Window.partitionBy("tree")
    ahead = F.sum("_rows").over(every.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("tree", "_task", (F.coalesce(ahead, F.lit(0)) - F.col("_from")).alias("_shift"), F.sum("_rows").over(every).alias("n"))
    return placed.join(spans, ["tree", "_task"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_task", "_at", "_shift")


def height(n: int) -> int:
    """Levels above n leaves: runs of ARITY become one node until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


@dataclass
class Forest:
    """Leaves with their places, records of inner nodes, and a root per tree, as written tables."""

    leaves: DataFrame    # tree, rank, n, digest and what else the leaves had
    records: DataFrame   # digest, children
    roots: DataFrame     # tree, digest, height
    levels: int          # of the highest tree


def grow(leaves: DataFrame, order: list[str]) -> Forest:
    """The trees above ``leaves`` (tree, digest, the order's columns; a written table)."""
    places = stored(ranked(leaves, order), "manifest-leaves")
    most = places.agg(F.max("n")).first()[0] or 0
    nodes, levels = places.select("tree", "rank", "n", "digest"), []
    roots = nodes.where("n = 1").select("tree", "digest", F.lit(0).alias("height"))
    for level in range(1, height(most) + 1):
        run = F.sort_array(F.collect_list(F.struct("rank", "digest")))  # at most ARITY
        nodes = stored(
            nodes.where("n > 1").groupBy("tree", F.expr(f"rank div {ARITY}").alias("rank"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
            .agg(F.transform(run, lambda x: x["digest"]).alias("children"))
            .withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "manifest-level")
        levels.append(nodes)
        roots = roots.union(nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("height")))
    records = places.select("digest", F.array("digest").alias("children")).where(F.lit(False))
    for nodes in levels:
        records = records.union(nodes.select("digest", "children"))
    # equal digests are of equal children: one record serves all places
    return Forest(places, stored(records.dropDuplicates(["digest"]), "manifest-records"), stored(roots, "manifest-roots"), len(levels))


def descend(starts: DataFrame, forest: Forest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``digest`` of the leaf they reach, and the ``path`` to it.

    ``starts`` has tree, digest, height and the path so far of the trees' roots; further columns of
    it are handed down. Requests of places that a tree does not have find nothing.
    """
    handed = [c for c in starts.columns if c not in ("tree", "digest", "height", "path")]
    wanted = {0: requests}
    for level in range(1, forest.levels):
        below = wanted[level - 1]
        wanted[level] = below.select("tree", F.expr(f"rank div {ARITY}").alias("rank")).distinct()
        if level == 1:  # the others are made from this one, a node for up to ARITY requests
            wanted[1] = stored(wanted[1], "manifest-wanted")

    def beginning(level: int) -> DataFrame:
        return starts.where(F.col("height") == level).select(
            "tree", F.lit(0).cast("long").alias("rank"), "digest", "path", *handed)

    nodes = beginning(forest.levels)
    for level in range(forest.levels - 1, -1, -1):
        opened = nodes.join(forest.records, "digest").select(
            F.col("tree").alias("_tree"), F.col("rank").alias("_parent"), "children", "path", *handed)
        digit = F.expr(f"cast(rank % {ARITY} as int)")
        others = F.concat(F.slice("children", F.lit(1), digit), F.slice("children", digit + 2, F.lit(ARITY)))
        taken = (wanted[level].join(opened, (F.col("tree") == F.col("_tree")) & (F.expr(f"rank div {ARITY}") == F.col("_parent")))
                 .where(digit < F.size("children"))
                 .withColumns({"digest": F.element_at("children", digit + 1),
                               "path": F.concat("path", F.array(F.struct(digit.alias("digit"), others.alias("others"))))})
                 .drop("_tree", "_parent", "children"))
        nodes = taken.unionByName(beginning(level)) if level else taken
    lone = requests.join(beginning(0).select(F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), "digest", "path", *handed),
                         (F.col("tree") == F.col("_tree")) & (F.col("rank") == F.col("_rank"))).drop("_tree", "_rank")
    return nodes.unionByName(lone) if forest.levels else lone


@dataclass
class Manifest:
    """Two forests: the trees of rows, and the one tree above their roots."""

    rows: Forest
    top: Forest


def build_manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``leaves``: tree (see ``tree_name``), digest, the order's columns and any more.

    Equal keys are ordered by digest. An empty table has neither nodes nor a root.
    """
    rows = grow(stored(leaves, "manifest-digests"), [*order, "digest"])
    names = rows.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "height")
    return Manifest(rows, grow(stored(names, "manifest-trees"), ["name"]))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, ...) with leaf, subroot, root and ``segments``, the proof from the leaf up.

    A segment has the node's place in its run and the other digests of the run, left to right.
    """
    none = F.array().cast(PATH)
    top = manifest.top.roots.select("tree", "digest", "height", none.alias("path"), F.col("digest").alias("root"))
    trees = descend(top, manifest.top, manifest.top.leaves.select("tree", "rank", "name", F.col("height").alias("_height")))
    starts = trees.select(F.col("name").alias("tree"), "digest", F.col("_height").alias("height"), "path", "root",
                          F.col("digest").alias("subroot"))
    found = descend(stored(starts, "manifest-starts"), manifest.rows, requests)
    return found.withColumnRenamed("digest", "leaf").withColumn("segments", F.reverse("path")).drop("path")


def proof_digest(segments: Column) -> Column:
    """Digest of all digests of a proof."""
    return F.sha2(F.array_join(F.flatten(F.transform(segments, lambda s: s["others"])), ""), 256)


def folded(leaf: Column, segments: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    def up(below: Column, s: Column) -> Column:
        left = F.array_join(F.slice(s["others"], F.lit(1), s["digit"]), "")
        right = F.array_join(F.slice(s["others"], s["digit"] + 1, F.lit(ARITY)), "")
        return digest(left, below, right)
    return F.aggregate(segments, leaf, up)


# What a manifest of documents hashes, in this order.
DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")


def verify_documents(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    A row is a leaf of its ``lang``'s tree, by ascending doc_id, null first and equal ones by
    digest; null is a language of its own. Every leaf is proven from the manifest of the table as it
    is. Where ``tampered`` holds, the proof is checked against the row with A-Z of its text in lower
    case. Null values, empty texts and repeated rows are leaves like others; without rows there is
    no root and no result. Columns that are not hashed are not read.
    """
    values = {c: F.col(c) for c in DOCUMENT}
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = leaf_digest(*values.values())
    claimed = leaf if tampered is None else F.when(tampered, leaf_digest(*(values | {"text": lower}).values())).otherwise(leaf)
    leaves = documents.select(tree_name(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                              leaf.alias("digest"), claimed.alias("claimed"))
    manifest = build_manifest(leaves, ["doc_id"])
    proofs = prove(manifest, manifest.rows.leaves.select("tree", "rank", "doc_id", "claimed"))
    root = folded(F.col("claimed"), F.col("segments"))
    return proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("segments")).alias("proof_sha256"),
                         root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
