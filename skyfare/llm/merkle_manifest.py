"""A Merkle manifest of a dataset: content-addressed records, proofs by descent.

``build_manifest`` makes a leaf of each row (a digest of its fields), a tree of
each group's leaves in the order of their ids, and a tree of the groups' roots.
Every inner node is a record digest -> children in one content-addressed store:
equal nodes are stored once, and a record is found by its digest alone.

``proofs`` answers leaf requests (tree, rank).  They descend from the root: the
digits of tree and rank in base ``fanout`` say which child to follow, the
children left aside are collected as one segment of the path, and at the leaf
the segments are reversed, since a proof is folded upwards.  Requests that go
through the same node are one row until they part, so a level has at most one
row for each node and no row is hot: the root is one row, not one for each leaf.

Digests are SHA-256; a node's input are its children's digests as lowercase hex
text.  A field is ``-`` if null, else its UTF-8 bytes' count, ``:`` and the
value, so no two rows share an encoding.  Texts of invalid UTF-8 are digested by
their bytes.  Null groups are a group of their own and come first; null ids come
first.  Rows of one group and id stand in the order of their leaves; repeated
rows are a leaf each.  An empty table has no root (None), no records, no proofs.
Extra columns are not read unless named in ``keep``; a kept column must not have
a name that the manifest uses (``group``, ``tree``, ``rank``, ``leaf``).

Levels are Spark jobs, one for each power of ``fanout`` in the largest group;
each is written to the shared folder, so a lost executor costs one level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.llm.common import join_by_class
from skyfare.llm.ordering import with_places
from skyfare.session import write_once

FANOUT = 16
DIGEST_BYTES = 32


def field(value: Column) -> Column:
    """A field in the digest's input: ``-``, or byte count, ``:`` and value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest (binary) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def hex_text(digests: Column) -> Column:
    """Binary digests, one or more, as lowercase hex text."""
    return F.lower(F.hex(digests))


def node_digest(digests: Column) -> Column:
    """Digest of a node whose children's digests stand one after the other in ``digests``."""
    return F.unhex(F.sha2(hex_text(digests), 256))


def _joined(digests: Column) -> Column:
    """An array of binary digests as one binary value."""
    return F.aggregate(digests, F.lit(b""), lambda got, x: F.concat(got, x))


@dataclass
class Manifest:
    leaves: DataFrame   # tree, rank, group, leaf and the kept columns: one row for each row of the table
    groups: DataFrame   # tree, group, size (leaves), subroot: one row for each group
    records: DataFrame  # digest, children (digests one after the other): one row for each different node
    root: bytes | None
    fanout: int
    largest: int        # leaves of the largest group
    trees: int          # number of groups


def _levels(n: int, fanout: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _climb(nodes: DataFrame, largest: int, fanout: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(roots, records) of all trees whose lowest nodes are ``nodes`` (tree, size, at, digest).

    ``size`` is the number of the tree's nodes on the level; a tree stops where it is 1.
    """
    roots, records = [nodes.filter("size = 1").select("tree", "digest")], []
    nodes = nodes.filter("size > 1")
    for level in range(1, _levels(largest, fanout) + 1):
        run = F.sort_array(F.collect_list(F.struct("at", "digest")))
        above = (nodes.groupBy("tree", "size", F.expr(f"at div {fanout}").alias("over")).agg(run.alias("run"))
                 .select("tree", F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
                         F.col("over").alias("at"), _joined(F.col("run.digest")).alias("children")))
        above = write_once(above.withColumn("digest", node_digest(F.col("children"))), f"manifest-{name}-{level}")
        records.append(above.select("digest", "children"))
        roots.append(above.filter("size = 1").select("tree", "digest"))
        nodes = above.filter("size > 1").select("tree", "size", "at", "digest")
    return reduce(DataFrame.unionByName, roots), records


def build_manifest(rows: DataFrame, id_col: str, group_col: str, fields: Sequence[str], keep: Sequence[str] = (),
                   fanout: int = FANOUT) -> Manifest:
    """The manifest of ``rows``; ``fields`` are what a leaf is made of, in order."""
    spark = rows.sparkSession
    light = write_once(rows.select(
        F.col(id_col).alias("__id"), F.col(group_col).cast("string").alias("group"),
        leaf_digest([F.col(c) for c in fields]).alias("leaf"), *keep), "manifest-leaves")
    # a group's null is told from the empty string by the key that groups are joined on
    key = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("-"))
    placed = with_places(light.withColumn("__key", key), ["group", "__id", "leaf"], "manifest-order")
    found = placed.groupBy("__key", "group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    groups = write_once(with_places(found, ["group"], "manifest-groups", place="tree"), "manifest-trees")
    largest, trees = groups.agg(F.max("size"), F.count(F.lit(1))).first()
    classes = groups.select("__key", "first", "size", "tree")
    leaves = write_once(
        join_by_class(placed, classes, "__key", "size")
        .select("tree", "size", (F.col("place") - F.col("first")).alias("rank"), "group",
                F.col("__id").alias(id_col), "leaf", *keep), "manifest-ranks")
    lowest = leaves.select("tree", "size", F.col("rank").alias("at"), F.col("leaf").alias("digest"))
    subroots, records = _climb(lowest, largest or 0, fanout, "group")
    groups = write_once(groups.select("tree", "group", "size").join(
        subroots.withColumnRenamed("digest", "subroot"), "tree"), "manifest-subroots")
    tops = groups.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"),
                         F.col("tree").alias("at"), F.col("subroot").alias("digest"))
    top, above = _climb(tops, trees, fanout, "top")
    root = top.first()  # one row: a single tree's root
    records = records + above
    store = (write_once(reduce(DataFrame.unionByName, records).groupBy("digest")
                        .agg(F.first("children").alias("children")), "manifest-store")
             if records else spark.createDataFrame([], "digest binary, children binary"))
    return Manifest(leaves.drop("size"), groups, store, None if root is None else bytes(root["digest"]), fanout,
                    largest or 0, trees)


def _step(frontier: DataFrame, manifest: Manifest) -> DataFrame:
    """Each node of the frontier with its record's children; a digest that the store lacks is an error."""
    lost = F.raise_error(F.concat(F.lit("no record for "), hex_text(F.col("digest")))).cast("binary")
    children = F.coalesce(F.col("children"), lost)
    return frontier.join(manifest.records, "digest", "left").withColumn("children", children)


def _child(digit: Column) -> Column:
    return F.substring(F.col("children"), digit.cast("int") * DIGEST_BYTES + 1, F.lit(DIGEST_BYTES))


def _segment(digit: Column) -> Column:
    """What one level adds to the path: the child followed and the children left aside."""
    at = digit.cast("int") * DIGEST_BYTES
    aside = F.concat(F.substring(F.col("children"), F.lit(1), at),
                     F.substring(F.col("children"), at + DIGEST_BYTES + 1, F.length("children")))
    return F.array(F.struct(digit.cast("int").alias("digit"), aside.alias("aside")))


def _descend(frontier: DataFrame, manifest: Manifest, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The frontier one level lower: a row for each child that ``wanted`` (keys) has below it."""
    count = F.expr(f"length(children) div {DIGEST_BYTES}")
    down = _step(frontier, manifest).withColumn("digit", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    down = down.select(*[c for c in frontier.columns if c not in ("at", "digest", "path")],
                       (F.col("at") * manifest.fanout + F.col("digit")).alias("at"), _child(F.col("digit")).alias("digest"),
                       F.concat("path", _segment(F.col("digit"))).alias("path"))
    return down.join(wanted, keys, "left_semi")


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank and any columns) with subroot and path, from the leaf up to the root.

    ``path`` has for each level the digit of the node among its siblings and the
    other siblings' digests, left to right, in one binary value.  Requests for
    leaves that the manifest lacks give no row.
    """
    spark, fanout = requests.sparkSession, manifest.fanout
    if manifest.root is None:
        return requests.limit(0).select("*", F.lit(b"").alias("subroot"), F.expr(
            "cast(array() as array<struct<digit: int, aside: binary>>)").alias("path"))
    # what is asked for, level by level: the nodes over the requested leaves
    below = [write_once(requests.select("tree", F.expr(f"rank div {fanout}").alias("at")).distinct(), "proof-wanted")]
    for _ in range(2, _levels(manifest.largest, fanout) + 1):
        below.append(below[-1].select("tree", F.expr(f"at div {fanout}").alias("at")).distinct())
    trees = below[-1].select("tree").distinct()
    nothing = F.expr("cast(array() as array<struct<digit: int, aside: binary>>)")

    frontier = (spark.createDataFrame([(bytearray(manifest.root),)], "digest binary")
                .select(F.lit(0).cast("long").alias("at"), "digest", nothing.alias("path")))
    for level in range(_levels(manifest.trees, fanout), 0, -1):
        over = trees.select(F.expr(f"tree div {fanout ** (level - 1)}").alias("at")).distinct()
        frontier = _descend(frontier, manifest, over, ["at"])
    # now at the groups: each tree starts where its own height has its root
    starts = write_once(frontier.withColumnRenamed("at", "tree").join(manifest.groups.select("tree", "size"), "tree")
                        .select("tree", "size", F.lit(0).cast("long").alias("at"), "digest",
                                F.col("digest").alias("subroot"), "path"), "proof-subroots")
    frontier = None
    for level in range(_levels(manifest.largest, fanout), 0, -1):
        high, low = fanout ** level, fanout ** (level - 1)
        enter = starts.filter((F.col("size") > low) & (F.col("size") <= high))
        frontier = enter if frontier is None else frontier.unionByName(enter)
        if level > 1:
            frontier = _descend(frontier, manifest, below[level - 2], ["tree", "at"])
    kept = [c for c in requests.columns if c not in ("tree", "rank")]
    asked = requests.withColumn("at", F.expr(f"rank div {fanout}"))
    single = (asked.filter("rank = 0").join(starts.filter("size = 1").drop("size", "at", "digest"), "tree")
              .select("tree", "rank", *kept, "subroot", "path"))
    if frontier is not None:
        digit = F.col("rank") % fanout
        found = _step(frontier, manifest).drop("digest", "size").join(asked, ["tree", "at"])
        found = found.filter(digit * DIGEST_BYTES < F.length("children"))
        single = found.select("tree", "rank", *kept, "subroot",
                              F.concat("path", _segment(digit)).alias("path")).unionByName(single)
    return single.withColumn("path", F.reverse("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root (binary) that ``leaf`` and the siblings of ``path`` give."""
    def up(node, step):
        at = step["digit"] * DIGEST_BYTES
        return node_digest(F.concat(F.substring(step["aside"], F.lit(1), at), node,
                                    F.substring(step["aside"], at + 1, F.length(step["aside"]))))

    return F.aggregate(path, leaf, up)


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level and left to right, as hex text."""
    return F.array_join(F.transform(path, lambda step: hex_text(step["aside"])), "")
