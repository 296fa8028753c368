"""Approximate nearest neighbours by an inverted multi-index.

The vectors' two halves are quantised separately; a cell is a pair of centroids.
For a query, cells are traversed from a heap by the sum of the two halves' inner
products with the centroids, and the vectors of the visited cells are reranked
with the exact inner product.

The search has two rounds.  The first visits the nearest cells until they hold
``first`` vectors, which gives a lower bound of the k-th best score.  The second
goes on until few vectors above that bound can be expected in the cells left.
What can be expected follows the spread of the vectors along the query: one
covariance matrix over both halves, corrected for each centroid by the residuals
of sampled vectors, and the tail of those residuals as it was counted.  No such
model fits all data, so how few is "few" is measured: for ``SAMPLE_QUERIES``
queries, chosen by a hash, the k nearest are found among all vectors, and the
search goes on as far as the recall of these queries needs, two standard errors
of its mean included, to be ``aim`` (to all cells, if need be), and at least
until ``miss`` x k are expected in the rest.

A cell also knows the longest residual of its vectors.  Cells in which no vector
can reach the bound are not visited.  With ``exact=True`` all others are, and
the result is that of a comparison with every vector.

The codebooks are fitted on a bounded sample (``SAMPLE`` vectors, chosen by a
hash); every vector is indexed.  Of equal vectors only the k + 1 smallest ids
can be among anyone's k nearest, so only those are kept in a cell.  Cells of
neighbouring first centroids are gathered into stripes of about equal size; a
query goes once to each stripe that has cells for it, with the sum down to which
cells are visited, and the task tells its cells from that.  Stripes are cut into
blocks of vectors against blocks of queries, so that a crowded cell is spread
over many tasks, and a task keeps k vectors of each of its queries.  Vectors of
single precision travel as such.

Vectors that are null, empty or zero or hold null or non-finite components take
no part, nor do vectors of another length than most have.  Repeated rows (same
id and vector) count once; vectors of the same id are each a candidate, and none
is a candidate for a query of that id.  Rows of null id take no part.  Extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.common import prepare
from skyfare.session import write_once

SAMPLE, MAX_CENTROIDS, ROUNDS = 1 << 14, 512, 12
#: Vectors of a block, queries of a block, and bytes of either in double precision.
BLOCK_POINTS, BLOCK_QUERIES, BLOCK_BYTES = 1 << 15, 1 << 14, 1 << 24
#: Rows worked on at once where each has a value for every centroid or cell; scores worked on at once.
ROWS, SCORES = 1 << 11, 1 << 20
#: Queries that visit this share of a shard are compared with all of it in one product.
DENSE = 0.25
#: Queries compared with all vectors to measure the recall; entries of the sampled residuals at most.
SAMPLE_QUERIES, SAMPLE_ENTRIES = 256, 1 << 22
#: A centroid's own spread counts in full when many more than so many sampled vectors are at it.
FEW = 4


def kmeans(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly chosen starts."""
    centroids = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = nearest(points, centroids)
        count = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, points[:, j], k) for j in range(points.shape[1])], axis=1) \
            if points.shape[1] else np.zeros((k, 0))
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out, size = np.empty(len(points), np.int64), (centroids ** 2).sum(axis=1)
    for at in range(0, len(points), ROWS):
        out[at:at + ROWS] = (size - 2 * points[at:at + ROWS] @ centroids.T).argmin(axis=1)
    return out


def traverse(first: np.ndarray, second: np.ndarray):
    """Pairs (i, j) by descending first[i] + second[j], from a heap."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    fa, fb = (-first[a]).tolist(), (-second[b]).tolist()
    done = [0] * len(a)  # how many of each row have been taken
    heap = [(fa[0] + fb[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield a[i], b[j]
        done[i] = j + 1
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (fa[i] + fb[j + 1], i, j + 1))
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (fa[i + 1] + fb[j], i + 1, j))


class Index:
    """Codebooks of both halves, vectors in each cell and spread around each centroid."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.books = [kmeans(sample[:, :self.half], k), kmeans(sample[:, self.half:], k)]
        self.k = k
        self.count = np.zeros(k * k, np.int64)
        self.spread = [np.zeros(k), np.zeros(k)]  # mean squared residual of each centroid
        self.shape = np.zeros((sample.shape[1], sample.shape[1]))  # mean outer product of ``scaled`` residuals
        self.reach = np.zeros(k * k)  # longest residual in each cell
        some = sample[::-(-sample.size // SAMPLE_ENTRIES)]
        cell = self.assign(some)[0]
        self.at = cell // k, cell % k
        self.rest = np.concatenate([some[:, :self.half] - self.books[0][self.at[0]],
                                    some[:, self.half:] - self.books[1][self.at[1]]], axis=1).astype(np.float32)
        self.tail = np.zeros(1), np.ones(1), 0.0
        self.stripe = np.arange(k)  # of each shard

    def assign(self, x: np.ndarray):
        """(cell, squared residual of each half) of vectors."""
        i, j = nearest(x[:, :self.half], self.books[0]), nearest(x[:, self.half:], self.books[1])
        return (i * self.k + j, ((x[:, :self.half] - self.books[0][i]) ** 2).sum(axis=1),
                ((x[:, self.half:] - self.books[1][j]) ** 2).sum(axis=1))

    def scaled(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Residuals of vectors, each half in units of its centroid's spread."""
        out = []
        for part, c, book, spread in zip((x[:, :self.half], x[:, self.half:]), (cell // self.k, cell % self.k),
                                         self.books, self.spread, strict=True):
            unit = np.divide(1.0, np.sqrt(spread), out=np.zeros(self.k), where=spread > 0)
            out.append((part - book[c]) * unit[c, None])
        return np.concatenate(out, axis=1)

    def variance(self, q: np.ndarray) -> np.ndarray:
        """(k, k): variance along ``q`` of the residuals of each cell; halves that go against each other count as free."""
        h, (one, two) = self.half, self.spread
        along = self.shape[:h, :h] @ q[:h] @ q[:h], self.shape[h:, h:] @ q[h:] @ q[h:]
        both = max(0.0, float(q[:h] @ self.shape[:h, h:] @ q[h:]))
        pooled = along[0] * one[:, None] + along[1] * two[None, :] + 2 * both * np.sqrt(one[:, None] * two[None, :])
        i, j = self.at
        off = (self.rest @ q.astype(np.float32)).astype(float) ** 2
        times = np.divide(off, pooled[i, j], out=np.ones(len(off)), where=pooled[i, j] > 1e-18)
        own = [(np.bincount(c, times, self.k) + FEW) / (np.bincount(c, minlength=self.k) + FEW) for c in (i, j)]
        return pooled * np.maximum(own[0][:, None], own[1][None, :])

    def learn_tail(self, queries: np.ndarray) -> None:
        """Count how often a sampled residual along a query is so many times its expected size."""
        size = []
        for q in queries:
            spread = np.sqrt(np.maximum(self.variance(q)[self.at], 1e-18))
            size.append(np.abs(self.rest @ q.astype(np.float32)) / spread)
        size = np.sort(np.concatenate(size))
        share = np.geomspace(1.0, 1.0 / len(size), 400)
        place = size[np.minimum((len(size) * (1 - share)).astype(int), len(size) - 1)]
        high = int(np.searchsorted(-share, -10 * share[-1]))  # beyond the last, the fall of the last decade goes on
        fall = math.log(share[high] / share[-1]) / max(place[-1] - place[high], 1e-9) if high < len(share) - 1 else 1.0
        self.tail = place, share, fall

    def sums(self, q: np.ndarray) -> np.ndarray:
        """Sum of the centroids' inner products with ``q``, by cell."""
        return ((self.books[0] @ q[:self.half])[:, None] + (self.books[1] @ q[self.half:])[None, :]).ravel()

    def expected(self, q: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(sums, vectors): sum of the centroids' inner products and vectors above ``bound`` to be expected, by cell."""
        sums = self.sums(q)
        z = (bound - sums) / np.sqrt(np.maximum(self.variance(q).ravel(), 1e-18))
        place, share, fall = self.tail
        a = np.abs(z)
        beyond = share[-1] * np.exp(-fall * np.maximum(a - place[-1], 0.0))
        above = np.where(a > place[-1], beyond, np.interp(a, place, share)) / 2
        out = self.count * np.where(z > 0, above, 1 - above)
        out[sums + np.linalg.norm(q) * self.reach < bound - _slack(bound)] = 0.0
        return sums, out

    def needed(self, q: np.ndarray, bound: float, cells: np.ndarray, enough: int) -> np.ndarray:
        """For each of ``cells`` what ``allowed`` must be below for ``more_cells`` to visit it; infinite for first cells."""
        sums, expected = self.expected(q, bound)
        out = np.empty(len(cells))
        for c in np.unique(cells):
            before = sums >= sums[c]
            left = expected[~before].sum() + expected[c]
            out[cells == c] = math.inf if self.count[before].sum() - self.count[c] < enough else left
        return out

    def first_cells(self, q: np.ndarray, enough: int) -> list[int]:
        """Nearest cells until they hold ``enough`` vectors."""
        out, held = [], 0
        for i, j in traverse(self.books[0] @ q[:self.half], self.books[1] @ q[self.half:]):
            cell = i * self.k + j
            if self.count[cell]:
                out.append(cell)
                held += int(self.count[cell])
                if held >= enough:
                    break
        return out

    def more_cells(self, q: np.ndarray, bound: float, skip: int, allowed: float) -> np.ndarray:
        """The cells after the first ``skip`` until ``allowed`` vectors above ``bound`` can be expected in the rest.

        They can be most of all cells: one sort of their sums costs less than the heap.
        """
        if not math.isfinite(bound):  # fewer than k found: all the others are wanted
            allowed = min(allowed, 0.0)
        sums, expected = self.expected(q, bound)
        cells = np.flatnonzero(self.count)
        cells = cells[np.argsort(-sums[cells], kind="stable")][skip:]
        cells = cells[expected[cells] > 0]
        return cells[np.cumsum(expected[cells][::-1])[::-1] > allowed]

    def reaches(self, q: np.ndarray, first: int, bound: float, allowed: float | None) -> tuple[float, list[int]]:
        """(sum, stripes): cells of at least this sum are visited, which are in these stripes; ``allowed`` None: the first cells.

        The second round's cells include the first's; a small margin allows for sums that are rounded otherwise.
        """
        sums, head = self.sums(q), self.first_cells(q, first)
        low = float(sums[head].min()) if head else math.inf
        margin = 1e-9 * (1 + abs(low))
        if allowed is not None:
            more = self.more_cells(q, bound, len(head), allowed)
            low = -math.inf if allowed == -math.inf else min(low, float(sums[more].min())) if len(more) else low
            margin *= 2
        low -= margin
        seen = (self.count > 0) & (sums >= low) & (sums + np.linalg.norm(q) * self.reach >= bound - _slack(bound))
        return low, np.unique(self.stripe[seen.reshape(self.k, self.k).any(axis=1)]).tolist()

    def stripes(self, size: int) -> np.ndarray:
        """Vectors of each stripe; a stripe has shards that follow each other with ``size`` vectors in all, or one shard."""
        held, out = self.count.reshape(self.k, self.k).sum(axis=1), [0]
        for shard, n in enumerate(held.tolist()):
            if out[-1] and out[-1] + n > size:
                out.append(0)
            out[-1] += n
            self.stripe[shard] = len(out) - 1
        return np.array(out)


def _slack(bound):
    """Allowance for rounding when something is compared with a bound."""
    return 1e-9 * (1 + np.where(np.isfinite(bound), np.abs(bound), 0.0))


def allowance(needs: list[np.ndarray], aim: float, most: float) -> float:
    """The largest value, ``most`` at most, by which the queries' mean recall less two standard errors reaches ``aim``."""
    needs = [n for n in needs if len(n)]
    if not needs:
        return most
    for allowed in [most, *sorted({float(v) for n in needs for v in n if v < most}, reverse=True)]:
        recall = np.array([(n > allowed).mean() for n in needs])
        if recall.mean() - 2 * recall.std() / math.sqrt(len(recall)) >= aim:
            return allowed
    return -math.inf


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class Best:
    """The best ``k`` of the pairs (query, vector) added, and for each query a bound that others have to reach."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int):
        self.x, self.ids, self.q, self.own, self.k = x, ids, q, own, k
        self.place = np.unique(ids, return_inverse=True)[1]
        self.bound = bound.astype(np.float64)
        self.rounding = 1e-12 * np.linalg.norm(q, axis=1) * np.sqrt((x ** 2).sum(axis=1).max())
        self.held, self.waiting = [], 0

    def compare(self, n: np.ndarray, rows: slice, asks: np.ndarray | None = None, column: np.ndarray | None = None) -> None:
        """Add the pairs of queries ``n`` with vectors ``rows``; of them those with ``asks[query, column of the vector]``."""
        size = rows.stop - rows.start
        step = max(1, SCORES // size)
        for at in range(0, len(n), step):
            some = n[at:at + step]
            low = self.bound[some] - _slack(self.bound[some]) - self.rounding[some]
            for begin in range(rows.start, rows.stop, SCORES):
                end = min(rows.stop, begin + SCORES)
                a, b = np.nonzero(self.q[some] @ self.x[begin:end].T >= low[:, None])
                if asks is not None:
                    asked = asks[at + a, column[b + begin - rows.start]]
                    a, b = a[asked], b[asked]
                self.add(some[a], b + begin)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        other = self.ids[b] != self.own[a]
        a, b = a[other], b[other]
        score, step = np.empty(len(a)), max(1, SCORES // self.x.shape[1])
        for at in range(0, len(a), step):  # pair by pair: equal vectors get equal scores
            score[at:at + step] = (self.q[a[at:at + step]] * self.x[b[at:at + step]]).sum(axis=1)
        self.held.append((a, b, score))
        self.waiting += len(a)
        if self.waiting > SCORES:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of the best so far, by query, then score, then id."""
        a, b, score = (np.concatenate(part) for part in zip(*self.held, strict=True)) if self.held else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((self.place[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        nth = np.arange(len(a)) - np.searchsorted(a, a)
        last = nth == self.k - 1
        self.bound[a[last]] = np.maximum(self.bound[a[last]], score[last])
        best = nth < self.k
        self.held, self.waiting = [(a[best], b[best], score[best])], 0
        return self.held[0]


def _rerank(k: int, shared, scores_only: bool):
    """Task function for one block of vectors and one block of queries."""
    def found(points: pd.DataFrame, queries: pd.DataFrame):
        index: Index = shared.value
        cell = points["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order].astype(np.int64)
        x = np.stack(points["v"].to_numpy())[order].astype(np.float64, copy=False)
        q, low = np.stack(queries["v"].to_numpy()).astype(np.float64, copy=False), queries["low"].to_numpy()
        norm, h = np.linalg.norm(q, axis=1), index.half
        best = Best(x, points["id"].to_numpy()[order], q, queries["query"].to_numpy(), queries["bound"].to_numpy(), k)
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        ends = np.append(starts[1:], len(cell))
        here = cell[starts]
        parts = np.split(np.arange(len(here)), np.flatnonzero(np.diff(here // index.k)) + 1)  # the cells of each shard
        for at in range(0, len(q), ROWS):
            n = np.arange(at, min(at + ROWS, len(q)))
            one, two = q[n, :h] @ index.books[0].T, q[n, h:] @ index.books[1].T
            for part in parts:
                sums = one[:, here[part[0]] // index.k, None] + two[:, here[part] % index.k]
                least = best.bound[n] - _slack(best.bound[n])
                asks = (sums >= low[n, None]) & (sums + norm[n, None] * index.reach[here[part]] >= least[:, None])
                size = ends[part] - starts[part]
                dense = asks @ size >= DENSE * size.sum()
                if dense.any():
                    best.compare(n[dense], slice(starts[part[0]], ends[part[-1]]), asks[dense], np.repeat(np.arange(len(part)), size))
                    asks[dense] = False
                for j in np.flatnonzero(asks.any(axis=0)):
                    best.compare(n[asks[:, j]], slice(starts[part[j]], ends[part[j]]))
        return best

    def task(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({c: [] for c in (["query", "key", "scores"] if scores_only else ["query", "key", "id", "score"])})
        best = found(points, queries)
        a, b, score = best.cut()
        if scores_only:
            own, start = np.unique(a, return_index=True)
            return pd.DataFrame({"query": queries["query"].to_numpy()[own], "key": queries["key"].to_numpy()[own],
                                 "scores": np.split(score, start[1:]) if len(own) else []})
        return pd.DataFrame({"query": queries["query"].to_numpy()[a], "key": queries["key"].to_numpy()[a],
                             "id": best.ids[b], "score": score})

    return task


def _probe(points: DataFrame, queries: DataFrame, k: int, kinds: str, shared, held: np.ndarray, most: tuple[int, int],
           scores_only: bool) -> DataFrame:
    """Rerank: ``points`` (id, v, cell, shard), ``queries`` (query, key, v, bound, low, stripes); ``held``: vectors by stripe.

    (query, key, scores) with at most ``k`` scores of each block, or (query, key, id, score).
    """
    spark = points.sparkSession
    asked = queries.select(F.explode("stripes").alias("stripe")).groupBy("stripe").count().collect()  # a row a stripe
    blocks = {r["stripe"]: (-(-int(held[r["stripe"]]) // most[0]), -(-r["count"] // most[1])) for r in asked}
    by_shard = spark.createDataFrame(  # MAX_CENTROIDS rows at most
        [(shard, int(s), *blocks[s]) for shard, s in enumerate(shared.value.stripe.tolist()) if s in blocks],
        "shard int, stripe int, pb int, qb int")
    by_stripe = spark.createDataFrame([(s, *b) for s, b in blocks.items()], "stripe int, pb int, qb int")
    left = points.join(F.broadcast(by_shard), "shard").select(
        "stripe", F.pmod(F.xxhash64("id"), F.col("pb")).cast("int").alias("i"),
        F.explode(F.expr("sequence(0, qb - 1)")).alias("j"), "id", "v", "cell")
    right = queries.withColumn("stripe", F.explode("stripes")).join(F.broadcast(by_stripe), "stripe").select(
        "stripe", F.explode(F.expr("sequence(0, pb - 1)")).alias("i"),
        F.pmod(F.xxhash64("query", "key"), F.col("qb")).cast("int").alias("j"), "query", "key", "v", "bound", "low")
    keys = ["stripe", "i", "j"]
    rest = "scores array<double>" if scores_only else f"id {kinds}, score double"
    task = _rerank(k, shared, scores_only)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda p, q: task(p, q), f"query {kinds}, key long, {rest}")


def _best_cells(points: DataFrame, ids: list, q: np.ndarray, bound: np.ndarray, k: int) -> list[np.ndarray]:
    """For each of a bounded number of queries the cells of its k nearest of all ``points``.

    Only vectors that reach a query's bound, k of a task at most, leave their task.
    """
    asked = points.sparkSession.sparkContext.broadcast((np.array(ids), q, bound))

    def cut(n, cell, score):
        order = np.lexsort((-score, n))
        n, cell, score = n[order], cell[order], score[order]
        best = np.arange(len(n)) - np.searchsorted(n, n) < k
        return n[best], cell[best], score[best]

    def task(batches):
        own, queries, low = asked.value
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                score = queries @ _matrix(part.column("v")).T
                here = part.column("id").to_numpy(zero_copy_only=False)
                n, at_row = np.nonzero((score >= low[:, None] - 1e-9) & (here[None, :] != own[:, None]))
                new = n, part.column("cell").to_numpy()[at_row].astype(np.int64), score[n, at_row]
                held = cut(*[np.concatenate(x) for x in zip(held, new, strict=True)])
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(held[0].astype(np.int32)), pa.array(held[1].astype(np.int32)),
                                              pa.array(held[2])], names=["n", "cell", "score"])

    best = Window.partitionBy("n").orderBy(F.desc("score"), "cell")
    rows = (points.select("id", "v", "cell").mapInArrow(task, "n int, cell int, score double")
            .withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k).select("n", "cell").toArrow())
    n, cell = rows.column("n").to_numpy(), rows.column("cell").to_numpy()
    return [cell[n == i] for i in range(len(ids))]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, first: int = 2048, miss: float = 0.03,
                       id_col: str = "vec_id", vector_col: str = "embedding", aim: float = 0.97,
                       exact: bool = False) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``queries`` its k nearest rows of ``vectors`` found.

    Both frames have ``id_col`` and ``vector_col``; nearness is the inner
    product in double precision, ties go to the smaller id.
    """
    spark = prepare(vectors)
    kinds = vectors.schema[id_col].dataType.simpleString()
    single = all(df.schema[vector_col].dataType.simpleString() == "array<float>" for df in (vectors, queries))
    kind_v = "array<float>" if single else "array<double>"

    def clean(df):
        df = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind_v).alias("v"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return df.filter("id IS NOT NULL AND size(v) > 0").filter(~bad & F.exists("v", lambda x: x != 0))

    found = clean(vectors).dropDuplicates(["id", "v"])
    common = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = f"query_id {kinds}, rank int, {id_col} {kinds}, score double"
    if common is None:
        return spark.createDataFrame([], empty)
    dim, total = common["d"], common["count"]
    same = Window.partitionBy("v").orderBy("id")
    found = (found.filter(F.size("v") == dim).withColumn("nth", F.row_number().over(same))
             .filter(F.col("nth") <= k + 1).drop("nth"))
    found = write_once(found, "multi-index-vectors")
    asked = clean(queries).filter(F.size("v") == dim).dropDuplicates(["id", "v"])
    asked = asked.select(F.col("id").alias("query"), F.xxhash64(F.col("v").cast("array<double>")).alias("key"), "v")

    centroids = min(MAX_CENTROIDS, max(2, 1 << round(math.log2(max(4.0, math.sqrt(total) / 3.5)))))
    one_in = max(1, total // SAMPLE)
    rows = (found.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(one_in)) == 0).limit(2 * SAMPLE)
            .select("v").toArrow().column("v").combine_chunks())
    sample = _matrix(rows) if len(rows) else _matrix(found.limit(SAMPLE).select("v").toArrow().column("v")
                                                     .combine_chunks())
    sample = sample[np.lexsort(sample.T[::-1])]
    index = Index(sample, min(centroids, len(sample)))
    shared = spark.sparkContext.broadcast(index)

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cell, r1, r2 = shared.value.assign(_matrix(part.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("v"), pa.array(cell.astype(np.int32)),
                     pa.array((cell // shared.value.k).astype(np.int32)), pa.array(r1), pa.array(r2)],
                    names=["id", "v", "cell", "shard", "r1", "r2"])

    points = write_once(found.mapInArrow(
        assign, f"id {kinds}, v {kind_v}, cell int, shard int, r1 double, r2 double"), "multi-index-points")
    by_cell = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(F.expr("r1 + r2"))).alias("far"))
    for r in by_cell.collect():  # MAX_CENTROIDS ** 2 rows at most
        index.count[r["cell"]], index.reach[r["cell"]] = r["n"], r["far"]
    for side, (by, res) in enumerate(((F.col("shard"), "r1"), (F.col("cell") % index.k, "r2"))):
        for r in points.groupBy(by.alias("c")).agg(F.avg(res).alias("s")).collect():
            index.spread[side][r["c"]] = r["s"]
    spread = spark.sparkContext.broadcast(index)

    def products(batches):
        """Sum of the outer products of one partition's scaled residuals, an entry a row."""
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                u = spread.value.scaled(_matrix(batch.column("v")), batch.column("cell").to_numpy())
                total += u.T @ u
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim, dtype=np.int32)), pa.array(total.ravel())],
                                             names=["at", "x"])

    entries = (points.select("v", "cell").mapInArrow(products, "at int, x double")
               .groupBy("at").agg(F.sum("x").alias("x")).toArrow())  # dim ** 2 rows
    index.shape.ravel()[entries.column("at").to_numpy()] = entries.column("x").to_numpy() / max(1, int(index.count.sum()))
    index.learn_tail(sample[::-(-len(sample) // 64)])
    points = points.select("id", "v", "cell", "shard")
    at_once = spark.sparkContext.defaultParallelism * 4
    rows_of_bytes = max(1, BLOCK_BYTES // (8 * dim))
    most = min(BLOCK_POINTS, rows_of_bytes), min(BLOCK_QUERIES, rows_of_bytes)
    held = index.stripes(min(most[0], max(512, -(-int(index.count.sum()) // at_once))))
    counted = spark.sparkContext.broadcast(index)

    def cells(second: bool):
        def task(batches):
            for batch in batches:
                q, bound = _matrix(batch.column("v")), batch.column("bound").to_numpy()
                found = [counted.value.reaches(*x, allowed if second else None)
                         for x in zip(q, [first] * len(q), bound.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("query", "key", "v", "bound")], pa.array([x[0] for x in found], pa.float64()),
                     pa.array([x[1] for x in found], pa.list_(pa.int32()))],
                    names=["query", "key", "v", "bound", "low", "stripes"])

        return task

    def ask(rows, second: bool):
        """The queries with what they visit, dealt evenly: a query takes milliseconds, however few its bytes are."""
        rows = rows.select("query", "key", "v", "bound").repartition(parts, "query", "key")
        return write_once(rows.mapInArrow(
            cells(second), f"query {kinds}, key long, v {kind_v}, bound double, low double, stripes array<int>"), "multi-index-asks")

    lowest = F.lit(float("-inf"))
    asked = write_once(asked, "multi-index-queries")
    n_asked = asked.count()
    parts = max(1, min(at_once, -(-n_asked // 64)), -(-n_asked // most[1]))
    near = _probe(points, ask(asked.withColumn("bound", lowest), False), k, kinds, counted, held, most, True)
    bounds = near.groupBy("query", "key").agg(
        F.expr(f"try_element_at(sort_array(flatten(collect_list(scores)), false), {k})").alias("bound"))
    again = write_once(asked.join(bounds, ["query", "key"], "left").withColumn("bound", F.coalesce("bound", lowest)),
                       "multi-index-bounds")
    allowed = -math.inf
    if not exact:
        tried = (again.orderBy(F.xxhash64("query", "key"), "query").limit(SAMPLE_QUERIES)
                 .select("query", "v", "bound").toArrow().combine_chunks())
        if tried.num_rows:
            q = _matrix(tried.column("v").combine_chunks())
            low = tried.column("bound").to_numpy()
            best = _best_cells(points, tried.column("query").to_pylist(), q, low, k)
            allowed = allowance([index.needed(*x, first) for x in zip(q, low, best, strict=True)], aim, miss * k)
    more = _probe(points, ask(again, True), k, kinds, counted, held, most, False)
    ranked = Window.partitionBy("query", "key").orderBy(F.desc("score"), "id")
    best = more.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id_col), "score")
