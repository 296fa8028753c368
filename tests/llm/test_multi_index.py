import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from skyfare.llm.multi_index import Index, allowance, nearest_neighbours, traverse


def test_traverse_goes_downhill_over_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = rng.integers(0, 5, rng.integers(1, 9)).astype(float), rng.random(rng.integers(1, 9))
        pairs = list(traverse(a, b))
        sums = [a[i] + b[j] for i, j in pairs]
        assert len(set(pairs)) == len(a) * len(b) and sums == sorted(sums, reverse=True)


def brute(rows, k, asks):
    """rows: distinct (id, vector)."""
    out = []
    for q, v in asks:
        scored = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, cell long")


def test_exact_while_all_cells_are_visited(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(6)]) for i in range(400)]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows]
    df = frame(spark, rows).repartition(4)
    got = found(nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=20))
    assert got == brute(rows, 20, [r for r in rows if r[0] % 20 == 0])  # many ties: smaller ids first


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0, 0.5]), (20, [0.0, 1.0, -0.0]), (1, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0])]
    bad = [(3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, nan, 1.0]), (7, [1.0, inf, 1.0]), (8, [1.0, None, 1.0]),
           (9, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (40, None)]
    df = frame(spark, good + bad + [good[0], good[2]])  # repeated rows count once
    got = found(nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=20))
    assert got == brute(good, 20, good[:2])  # fewer than k candidates: all of them


def test_empty_table(spark):
    df = frame(spark, [])
    out = nearest_neighbours(df, df)
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


@pytest.mark.parametrize("crowded", [False, True])
def test_recall(spark, crowded, monkeypatch):
    import skyfare.llm.multi_index as m
    monkeypatch.setattr(m, "BLOCK_POINTS", 1000)
    monkeypatch.setattr(m, "BLOCK_QUERIES", 100)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 32))
    if crowded:  # a third of all close to one vector, and many exact copies
        x[::3] = x[0] + 0.02 * rng.normal(size=x[::3].shape)
        x[1::9] = x[1]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(6)
    out = nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=20, first=500).toPandas()
    y = x.astype(np.float64)
    hits = 0
    for q, part in out.groupby("query_id"):
        part = part.sort_values("rank")
        assert len(part) == 20 and q not in set(part.vec_id)
        assert np.allclose(part.score, y[part.vec_id] @ y[q], atol=1e-12)
        keys = list(zip(-part.score, part.vec_id))
        assert keys == sorted(keys)
        score = y @ y[q]
        score[q] = -np.inf
        # an equal score counts as found: of exact copies the smaller ids come first
        hits += (part.score.to_numpy() >= np.sort(score)[-20] - 1e-12).sum()
    assert hits / (20 * 300) >= 0.95


@pytest.mark.parametrize("n, rank", [(4000, 16), (12_000, 16), (12_000, 32), (30_000, 8)])
def test_recall_near_a_space_of_few_dimensions(spark, n, rank):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(6)
    out = nearest_neighbours(df, df.filter(f"vec_id % {n // 60} = 0"), k=20, first=300).toPandas()
    y = x.astype(np.float64)
    hits = total = 0
    for q, part in out.groupby("query_id"):
        score = y @ y[q]
        score[q] = -np.inf
        hits += (part.score.to_numpy() >= np.sort(score)[-20] - 1e-12).sum()
        total += 20
    assert total >= 20 * 60 and hits / total >= 0.97


def test_variance_along_a_query_is_that_of_the_residuals():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3)) @ rng.normal(size=(3, 12))
    index = Index(x, 4)
    cell, *residual = index.assign(x)
    for side, c in enumerate((cell // 4, cell % 4)):
        index.spread[side] = np.bincount(c, residual[side], 4) / np.bincount(c, minlength=4)
    u = index.scaled(x, cell)
    index.shape = u.T @ u / len(u)
    ratio = []
    for q in x[:200]:
        off = (x[:, :6] - index.books[0][cell // 4]) @ q[:6] + (x[:, 6:] - index.books[1][cell % 4]) @ q[6:]
        ratio.append((off ** 2).mean() / index.variance(q).ravel()[cell].mean())
    assert 0.7 < np.median(ratio) < 1.3


def test_codebooks_cover_both_halves():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 7))
    index = Index(x, 8)
    cell, r1, r2 = index.assign(x)
    assert index.half == 3 and cell.max() < 64 and (r1 >= 0).all() and (r2 >= 0).all()


def mixtures(n):
    """Vectors that no one subspace and no Gaussian describes."""
    rng = np.random.default_rng(11)

    def clusters(many, rank, apart):
        own, z = rng.integers(0, many, n), rng.normal(size=(n, rank))
        x = np.einsum("nr,nrd->nd", z, rng.normal(size=(many, rank, 64))[own])
        x += apart * rng.normal(size=(many, 64))[own]
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    return {"50 clusters of rank 8": lambda: clusters(50, 8, 0), "200 clusters of rank 6": lambda: clusters(200, 6, 3),
            "Student's t": lambda: rng.standard_t(3, size=(n, 64)),
            "log-normal norms": lambda: rng.normal(size=(n, 64)) * rng.lognormal(size=(n, 1))}


@pytest.mark.parametrize("name, exact", [("50 clusters of rank 8", False), ("200 clusters of rank 6", False),
                                         ("Student's t", False), ("log-normal norms", False), ("Student's t", True),
                                         ("50 clusters of rank 8", True)])
def test_recall_on_mixtures_and_heavy_tails(spark, name, exact):
    n = 100_000
    x = mixtures(n)[name]().astype(np.float32)
    table = pa.table({"vec_id": np.arange(n), "embedding": pa.ListArray.from_arrays(np.arange(n + 1) * 64, x.ravel())})
    df = spark.createDataFrame(table).repartition(8)
    # 500 queries, of which 256 at most are measured by the operator itself
    out = nearest_neighbours(df, df.filter("vec_id % 200 = 0"), k=20, exact=exact).toPandas()
    y = x.astype(np.float64)
    recall = []
    for q, part in out.groupby("query_id"):
        score = y @ y[q]
        score[q] = -np.inf
        recall.append((part.score.to_numpy() >= np.partition(score, -20)[-20] - 1e-9).mean())
        assert np.allclose(part.score, y[part.vec_id] @ y[q])
    assert len(recall) == 500
    if exact:
        assert min(recall) == 1
    else:
        assert np.mean(recall) - 2 * np.std(recall) / np.sqrt(500) >= 0.95


def test_allowance_is_the_largest_that_keeps_the_recall():
    needs = [np.array([5.0, 0.4, np.inf, 0.2])] * 4
    assert allowance(needs, 0.5, 0.6) == 0.6
    assert allowance(needs, 0.75, 0.6) == 0.2  # strictly below 0.4
    assert allowance(needs, 1.0, 0.6) == -np.inf
    assert allowance([], 0.9, 0.6) == 0.6


def test_needed_tells_which_cells_are_visited():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 8))
    index = Index(x, 8)
    cell, *residual = index.assign(x)
    index.count = np.bincount(cell, minlength=64)
    np.maximum.at(index.reach, cell, np.sqrt(residual[0] + residual[1]))
    for side, c in enumerate((cell // 8, cell % 8)):
        index.spread[side] = np.bincount(c, residual[side], 8) / np.bincount(c, minlength=8)
    u = index.scaled(x, cell)
    index.shape = u.T @ u / len(u)
    index.learn_tail(x[:20])
    for q in x[:30]:
        score = x @ q
        bound = np.sort(score)[-40]
        cells = cell[score >= bound]
        needs = index.needed(q, bound, cells, 200)
        head = index.first_cells(q, 200)
        assert {c for c, n in zip(cells, needs) if np.isinf(n)} == set(cells) & set(head)
        for allowed in (-np.inf, 0.0, 0.5, 5.0):
            seen = set(head) | set(index.more_cells(q, bound, len(head), allowed))
            assert {c for c, n in zip(cells, needs) if n > allowed} == set(cells) & seen


def test_queries_are_sent_once_and_not_for_each_cell(spark, monkeypatch):
    import skyfare.llm.multi_index as m
    written, write_once = {}, m.write_once

    def noted(df, name):
        written.setdefault(name, []).append(write_once(df, name))
        return written[name][-1]

    monkeypatch.setattr(m, "write_once", noted)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 8)).astype(np.float32))]
    df = frame(spark, rows).repartition(4)
    got = found(nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=20, exact=True))
    assert got == brute(rows, 20, [r for r in rows if r[0] % 20 == 0])
    assert [a.count() for a in written["multi-index-asks"]] == [150, 150]
    for asks in written["multi-index-asks"]:
        assert not {"cells", "shard"} & set(asks.columns)
        assert asks.schema["v"].dataType.simpleString() == "array<float>"


@pytest.mark.parametrize("scores_only", [False, True])
def test_a_crowded_cell_is_compared_in_bounded_memory(monkeypatch, scores_only):
    import skyfare.llm.multi_index as m
    monkeypatch.setattr(m, "SCORES", 1 << 16)
    rng = np.random.default_rng(6)
    x, q = rng.integers(-3, 4, (4000, 8)).astype(float), rng.integers(-3, 4, (2500, 8)).astype(float)
    index = Index(x[:200], 1)  # one cell
    index.count, index.reach = np.array([len(x)]), np.array([100.0])
    low = np.full(len(q), -np.inf)
    points = pd.DataFrame({"id": np.arange(len(x)), "v": list(x), "cell": np.zeros(len(x), np.int32)})
    queries = pd.DataFrame({"query": np.arange(len(q)), "key": np.arange(len(q)), "v": list(q), "bound": low, "low": low})
    tracemalloc.start()
    out = m._rerank(20, SimpleNamespace(value=index), scores_only)(points, queries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # all pairs with their scores: 240 MB
    score = q @ x.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf
    order = np.argsort(-score, axis=1, kind="stable")[:, :20]  # ties: smaller ids
    if scores_only:
        assert np.array_equal(np.stack(out.scores), np.take_along_axis(score, order, axis=1))
    else:
        assert np.array_equal(out.id.to_numpy().reshape(-1, 20), order)
