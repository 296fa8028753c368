import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skyfare.llm.packing import bucket_bounds, pack


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), min_size=1, max_size=8), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_bounds_against_all_choices(histogram, buckets):
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[s] for s in sizes.tolist()], np.int64)

    def padding(bounds):
        return sum(c * (min(b for b in bounds if b >= s) - s) for s, c in histogram.items())

    got = bucket_bounds(sizes, counts, buckets)
    assert got == sorted(set(got)) and len(got) <= buckets and got[-1] == sizes[-1]
    assert padding(got) == min(padding([*choice, sizes[-1]]) for k in range(min(buckets, len(sizes)))
                               for choice in itertools.combinations(sizes[:-1].tolist(), k))


def check(rows, lengths, max_len, budget, buckets):
    """Every token in one sequence, full batches but the last of each bucket, least padding."""
    full = [(i, n // max_len, n % max_len) for i, n in lengths]
    want = sorted([(i, p, max_len) for i, f, _ in full for p in range(f)]
                  + [(i, f, r) for i, f, r in full if r or not f], key=str)
    assert sorted([(r.doc_id, r.piece, r.n_tokens) for r in rows], key=str) == want
    placed = [r for r in rows if r.n_tokens]
    sizes, counts = np.unique([r.n_tokens for r in placed], return_counts=True)
    bounds = bucket_bounds(sizes, counts, buckets)
    batches, short = {}, {}
    for r in placed:
        assert r.bucket_len == bounds[r.bucket] >= r.n_tokens and (r.bucket == 0 or r.n_tokens > bounds[r.bucket - 1])
        batches.setdefault(r.batch_id, []).append(r)
    for held in batches.values():
        assert len({r.bucket for r in held}) == 1 and sorted(r.slot for r in held) == list(range(len(held)))
        room = budget // held[0].bucket_len
        assert len(held) <= room
        if len(held) < room:
            short[held[0].bucket] = short.get(held[0].bucket, 0) + 1
    assert all(v == 1 for v in short.values())
    assert sorted(batches) == list(range(len(batches)))


def test_pack_against_its_rules(spark):
    rng = np.random.default_rng(0)
    lengths = [(i, int(n)) for i, n in enumerate(rng.geometric(0.02, 2000))] + [(5000, 0), (5001, 1), (5002, 3000)]
    lengths += [(6000, 40)] * 700  # a third of the rows are copies of one
    for shard_rows in (1 << 16, 50):
        df = spark.createDataFrame(lengths, "doc_id long, n_tokens long").repartition(6)
        check(pack(df, 64, 512, 6, shard_rows=shard_rows).collect(), lengths, 64, 512, 6)


def test_edges(spark):
    rows = [(None, 5, "x"), (None, 5, "y"), (1, None, "z"), (2, 0, "w"), (3, 200, "v")]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, bucket string")
    check(pack(df, 64, 64, 3).collect(), [(i, n or 0) for i, n, _ in rows], 64, 64, 3)
    only = spark.createDataFrame([(1, 0)], "doc_id long, n_tokens long")
    assert [(r.n_tokens, r.batch_id) for r in pack(only, 64, 64).collect()] == [(0, None)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert pack(df, 64, 512).count() == 0
