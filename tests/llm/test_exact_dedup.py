import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyfare.llm import golomb
from skyfare.llm.exact_dedup import exact_dedup, squeeze
from tests.llm.conftest import edge_rows


@given(st.sets(st.integers(0, (1 << 48) - 1), max_size=300), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_golomb_round_trip(values, shift):
    values = np.array(sorted({v >> shift for v in values}), np.int64)
    universe = max(1, (1 << 48) >> shift)
    assert golomb.decode(golomb.encode(values, universe), len(values)).tolist() == values.tolist()


@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85ab", max_size=20))
@settings(max_examples=300, deadline=None)
def test_squeeze(text):
    assert squeeze(text.encode()).decode() == re.sub("[\x20\x09-\x0D]+", " ", text)


def brute(rows):
    norm = [re.sub("[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), n in zip(rows, norm, strict=True):
        groups[n].append(i)
    out = []
    for (i, _), n in zip(rows, norm, strict=True):
        ids = [x for x in groups[n] if x is not None]
        out.append((i, min(ids) if ids else None, len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("owners", [None, 1, 7])
def test_edges_against_brute_force(edge_docs, owners):
    rows = exact_dedup(edge_docs, owners=owners).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2], r[3])
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=key) == \
        sorted(brute(edge_rows()), key=key)
    kept = defaultdict(int)
    for r in rows:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # exactly one row of each text, also of repeated rows


def test_hot_text(spark):
    rng = random.Random(1)
    rows = [(i, "the same text" if i % 3 == 0 else f"own {rng.random()} {i}") for i in range(3000)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert found.filter("group_size = 1000 AND keep_id = 0").count() == 1000
    assert found.filter("kept").count() == 2001


def test_empty_table(no_docs):
    found = exact_dedup(no_docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and found.count() == 0


def test_bytes_that_are_not_utf8(spark, tmp_path):
    rows = [(1, b"a\xff b"), (2, b"a\xff  b"), (3, b"a\xfe b"), (4, b"\xc3"), (5, b"\xc3"), (6, "a\ufffd b".encode()), (7, b"x")]
    spark.createDataFrame([(i, bytearray(t)) for i, t in rows], "doc_id long, text binary").write.parquet(f"{tmp_path}/t")
    found = exact_dedup(spark.read.schema("doc_id long, text string").parquet(f"{tmp_path}/t"))
    want = [(i, keep, n, hashlib.sha256(squeeze(t)).hexdigest()) for (i, t), keep, n in
            zip(rows, [1, 1, 3, 4, 4, 6, 7], [2, 2, 1, 2, 2, 1, 1], strict=True)]
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()) == want
