"""SimHash near-dedup: exact pairs of close fingerprints by vantage-point trees.

Fingerprint: each shingle of ``shingle`` words (all of them, repeats included;
fewer words: the whole sequence) is hashed with XXH64, seed 42; a bit is 1 if
it is set in over half of the hashes.  Without any word it is zero.  Words are
``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.

Search, over distinct fingerprints: a top tree of vantage points from a bounded
sample gives the shards.  A fingerprint lives in one shard and is also sent to
every later shard that its ball overlaps by the triangle bounds, so each close
pair meets in exactly one shard.  Inside a shard a finer tree prunes by distance
bands around vantage points; there, pairs already known to be connected are not
compared again, and only a spanning forest leaves the shard.  Shards above a
fixed size are cut into blocks of points against blocks of queries.

A null text counts as empty; empty texts share the zero fingerprint and are
linked like any other.  Repeated rows each get their row.  Null ids get the
component's least id, or null if it has none.  Extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import join_by_class, prepare, slices, text_bytes
from skyfare.llm.components import connected_components
from skyfare.session import write_once

SEED = 42
#: Fingerprints of the sample that the top tree is made of, and of a shard, about.
SAMPLE, SHARD_POINTS, MAX_LEVELS = 1 << 16, 1 << 14, 12
#: Shards with more points or queries than this are cut into blocks.
BLOCK_POINTS, BLOCK_QUERIES = 1 << 17, 1 << 18
#: Hashes whose bits are laid out at once.
BIT_ROWS = 1 << 15


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[:len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
                    np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit, as an unsigned integer."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_ROWS):
        part = hashes[at:at + BIT_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(id, fp) for each row of ``docs`` (id, text); fp is the fingerprint as a signed long."""
    def task(batches):
        for batch in slices(batches):
            found = [fingerprint(shingle_hashes(t, shingle)) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"])

    prepare(docs)
    return docs.mapInArrow(task, f"id {docs.schema['id'].dataType.simpleString()}, fp long")


def _distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int64)


class TopTree:
    """Complete binary tree of (vantage point, radius); its leaves are the shards."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        inner = (1 << levels) - 1
        self.points, self.radii = np.zeros(inner, np.uint64), np.full(inner, 64, np.int64)
        held = {0: sample}
        for node in range(inner):
            own = held.pop(node)
            if len(own):  # of a few candidates the one whose distances spread most
                few = own[:: max(1, len(own) // 8)][:8]
                spread = [_distance(own, c).var() for c in few]
                self.points[node] = few[int(np.argmax(spread))]
                d = _distance(own, self.points[node])
                self.radii[node] = int(np.sort(d)[(len(d) - 1) // 2])
                left = d <= self.radii[node]
            else:
                left = np.empty(0, bool)
            held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]

    def home(self, fp: np.ndarray) -> np.ndarray:
        node = np.zeros(len(fp), np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (_distance(fp, self.points[node]) > self.radii[node])
        return node - len(self.points)

    def overlapped(self, fp: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into fp, shard) of every shard that may hold something within ``reach``."""
        index, node = np.arange(len(fp)), np.zeros(len(fp), np.int64)
        for _ in range(self.levels):
            d, mu = _distance(fp[index], self.points[node]), self.radii[node]
            left, right = d - reach <= mu, d + reach > mu
            index = np.concatenate([index[left], index[right]])
            node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        return index, node - len(self.points)


class Forest:
    """Union-find over arrays; a root is the least member of its tree."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, a: np.ndarray) -> np.ndarray:
        r = self.parent[a]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                self.parent[a] = r
                return r
            r = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _compare(fp, forest, points, queries, reach):
    """Unite all close pairs of points x queries, skipping pairs inside the largest known tree."""
    def block(p, q):
        step = max(1, (1 << 20) // max(1, len(p)))
        for at in range(0, len(q), step):
            part = q[at:at + step]
            i, j = np.nonzero(np.bitwise_count(fp[part][:, None] ^ fp[p][None, :]) <= reach)
            other = part[i] != p[j]
            forest.unite(part[i[other]], p[j[other]])

    roots_p, roots_q = forest.find(points), forest.find(queries)
    found, size = np.unique(roots_p, return_counts=True)
    main = found[np.argmax(size)]
    in_p, in_q = roots_p == main, roots_q == main
    if size.max() > 1 and in_q.any():
        if not in_q.all():
            block(points, queries[~in_q])
        if not in_p.all():
            block(points[~in_p], queries[in_q])
    else:
        block(points, queries)


def shard_forest(points: np.ndarray, queries: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, root) that connect just what links within ``reach`` connect.

    Links between a point and a point or query are found; ``points`` and
    ``queries`` are distinct fingerprints each, and may overlap.
    """
    fp = np.unique(np.concatenate([points, queries]))
    forest = Forest(len(fp))
    todo = [(np.searchsorted(fp, points), np.searchsorted(fp, queries), 0)]
    while todo:
        p, q, depth = todo.pop()
        if not len(p) or not len(q):
            continue
        if len(p) <= 64 or len(p) * len(q) <= 1 << 15 or depth == 8:
            _compare(fp, forest, p, q, reach)
            continue
        vantage = p[(len(p) * (2 * depth + 1) // 17) % len(p)]
        dp, dq = _distance(fp[p], fp[vantage]), _distance(fp[q], fp[vantage])
        for near in (p[dp <= reach], q[dq <= reach]):  # the vantage point is one of the points
            forest.unite(near, np.full(len(near), vantage))
        order, order_q = np.argsort(dp, kind="stable"), np.argsort(dq, kind="stable")
        p, dp, q, dq = p[order], dp[order], q[order_q], dq[order_q]
        for d in np.unique(dq):
            lo, hi = np.searchsorted(dp, [d - reach, d + reach + 1])
            a, b = np.searchsorted(dq, [d, d + 1])
            todo.append((p[lo:hi], q[a:b], depth + 1))
    roots = forest.find(np.arange(len(fp)))
    moved = roots != np.arange(len(fp))
    return fp[moved], fp[roots[moved]]


def close_links(prints: DataFrame, reach: int, sample: int = SAMPLE, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``prints`` (fp): spanning forests of all links."""
    spark = prepare(prints)
    n = prints.count()
    levels = min(MAX_LEVELS, max(0, int(np.ceil(np.log2(max(1, n) / shard_points)))))
    tree = TopTree(np.empty(0, np.uint64), 0)
    if levels:
        one_in = max(1, n // sample)  # a hash decides; the limit bounds what reaches the driver
        rows = (prints.filter(F.pmod(F.xxhash64("fp"), F.lit(one_in)) == 0).limit(2 * sample).collect())
        tree = TopTree(np.sort(np.array([r["fp"] for r in rows], np.int64)).view(np.uint64), levels)
    shared = spark.sparkContext.broadcast(tree)

    def route(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            home = shared.value.home(fp)
            index, shard = shared.value.overlapped(fp, reach)
            later = shard >= home[index]
            index, shard = index[later], shard[later]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), pa.array(fp[index].view(np.int64)), pa.array(shard == home[index])],
                names=["shard", "fp", "home"])

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        fp, role = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["role"].to_numpy()
        a, b = shard_forest(np.sort(fp[role != 2]), np.sort(fp[role != 1]), reach)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = write_once(prints.mapInArrow(route, "shard int, fp long, home boolean"), "simhash-routed")
    size = routed.groupBy("shard").agg(F.sum(F.col("home").cast("long")).alias("points"),
                                       F.count(F.lit(1)).alias("queries"))
    blocks = F.broadcast(size.select(  # one row a shard: 2 ** MAX_LEVELS at most
        "shard", F.ceil(F.col("points") / BLOCK_POINTS).cast("int").alias("p_blocks"),
        F.ceil(F.col("queries") / BLOCK_QUERIES).cast("int").alias("q_blocks")).filter("p_blocks > 0"))
    routed = routed.join(blocks, "shard").withColumn("whole", F.col("p_blocks") * F.col("q_blocks") == 1)
    whole = routed.filter("whole").select(
        "shard", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", F.when(F.col("home"), 3).otherwise(2).alias("role"))
    cut = routed.filter("not whole").withColumns({
        "at_p": F.pmod(F.xxhash64("fp", F.lit(1)), F.col("p_blocks")).cast("int"),
        "at_q": F.pmod(F.xxhash64("fp", F.lit(2)), F.col("q_blocks")).cast("int")})
    as_query = cut.select("shard", F.explode(F.expr("sequence(0, p_blocks - 1)")).alias("i"),
                          F.col("at_q").alias("j"), "fp", F.lit(2).alias("role"))
    as_point = cut.filter("home").select("shard", F.col("at_p").alias("i"),
                                         F.explode(F.expr("sequence(0, q_blocks - 1)")).alias("j"),
                                         "fp", F.lit(1).alias("role"))
    cells = whole.unionByName(as_query).unionByName(as_point)
    return cells.groupBy("shard", "i", "j").applyInPandas(search, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 3, reach: int = 3, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for each row: fingerprints within ``reach`` bits are linked, links are followed."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = write_once(fingerprints(docs, shingle), "simhash-prints")
    classes = write_once(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")),
                         "simhash-classes")
    linked = connected_components(close_links(classes.select("fp"), reach)).withColumnRenamed("node", "fp")
    linked = write_once(linked, "simhash-linked")
    roots = (linked.join(classes, "fp").groupBy("root")
             .agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("size")))
    of_linked = join_by_class(linked, write_once(roots, "simhash-roots"), "root", "size").select("fp", "component_id")
    of_class = classes.join(of_linked, "fp", "left").select(
        "fp", "n", F.when(F.col("component_id").isNull(), F.col("first")).otherwise(F.col("component_id"))
        .alias("component_id"))
    of_class = write_once(of_class, "simhash-components")
    return join_by_class(prints, of_class, "fp", "n").select(F.col("id").alias(id_col), "fp", "component_id")
