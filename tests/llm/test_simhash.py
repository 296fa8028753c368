import random

import numpy as np
import pytest
import xxhash

from skyfare.llm import simhash
from skyfare.llm.components import connected_components
from skyfare.llm.simhash import close_links, fingerprints, shard_forest, simhash_components
from tests.llm.conftest import edge_rows


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(prints, ids, reach):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints_of_edges(edge_docs):
    rows = [(i, t) for i, t in edge_rows() if i is not None and len(t or "") < 10_000]
    found = {r.id: r.fp & (1 << 64) - 1 for r in
             fingerprints(edge_docs.select("text", edge_docs.doc_id.alias("id"))).collect()}
    assert all(found[i] == brute_print(t) for i, t in rows)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(str(i) for i in range(500)).encode()
    whole = simhash.fingerprint(simhash.shingle_hashes(text, 3))
    monkeypatch.setattr(simhash, "BIT_ROWS", 7)
    assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) == whole == brute_print(text.decode())


def cluster_prints(n, seed):
    """Fingerprints with crowded neighbourhoods: centres with up to 4 flipped bits, and random ones."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 60))]
    out = set()
    while len(out) < n:
        v = rng.choice(centres) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("seed", range(3))
def test_shard_forest(seed):
    points, extra = cluster_prints(900, seed), cluster_prints(300, seed + 10)
    queries = np.unique(np.concatenate([points, extra]))
    a, b = shard_forest(points, queries, 3)
    # what is connected: links between a point and a point or query
    fp = queries.tolist()
    near = {(int(p), int(q)) for p in points for q in queries[np.bitwise_count(queries ^ p) <= 3]}
    parent = {v: v for v in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def groups(pairs):
        for v in fp:
            parent[v] = v
        for x, y in pairs:
            parent[find(x)] = find(y)
        out = {}
        for v in fp:
            out.setdefault(find(v), set()).add(v)
        return {frozenset(s) for s in out.values()}

    assert groups(zip(a.tolist(), b.tolist(), strict=True)) == groups(near)


@pytest.mark.parametrize("shard_points, blocks", [(1 << 14, 1 << 17), (100, 1 << 17), (100, 60)])
def test_links_over_shards_and_blocks(spark, monkeypatch, shard_points, blocks):
    monkeypatch.setattr(simhash, "BLOCK_POINTS", blocks)
    monkeypatch.setattr(simhash, "BLOCK_QUERIES", blocks)
    prints = cluster_prints(1200, 5)
    df = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long").repartition(4)
    roots = connected_components(close_links(df, 3, shard_points=shard_points)).collect()
    signed = prints.view(np.int64).tolist()
    got = {r.node: r.root for r in roots}
    want = brute_components(prints.tolist(), signed, 3)
    assert [got.get(v, v) for v in signed] == want


def test_components_of_edges(edge_docs):
    rows = [(i, t) for i, t in edge_rows()]
    ids = [i for i, _ in rows]
    want = brute_components([brute_print(t) for _, t in rows], ids, 3)
    found = [(r.doc_id, r.component_id) for r in simhash_components(edge_docs).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0)
    assert sorted(found, key=key) == sorted(zip(ids, want, strict=True), key=key)


def test_path_graph(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 600), (600, 500), (7, 7)]
    found = {r.node: r.root for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 600: 500}


def test_empty_table(no_docs):
    assert simhash_components(no_docs).count() == 0
