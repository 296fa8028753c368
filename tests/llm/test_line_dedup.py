import random
import re
from collections import defaultdict

import numpy as np
import pytest

from skyfare.llm import line_dedup as m
from skyfare.llm.line_dedup import TwoFilters, line_dedup, places
from tests.llm.conftest import edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return re.sub("^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(LOWER)


def brute(rows, min_chars=20, min_docs=3):
    held = defaultdict(list)
    for i, t in rows:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k].append(i)
    keeper = {k: max((i for i in ids if i is not None), default=None)
              for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == i]
        out.append((i is None, i or 0, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def found(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.text) for r in df.collect())


def test_edges(edge_docs):
    assert found(line_dedup(edge_docs)) == brute(edge_rows())


@pytest.mark.parametrize("max_log2", [3, 16, 29])
def test_result_does_not_depend_on_the_filter(spark, monkeypatch, max_log2):
    monkeypatch.setattr(m, "MAX_LOG2", max_log2)
    monkeypatch.setattr(m, "MIN_LOG2", min(max_log2, 8))
    monkeypatch.setattr(m, "SEGMENT_LOG2", min(max_log2, 6))
    rng = random.Random(0)
    pool = [f"{'shared' if i % 2 else 'Shared'} line number {i} of the pool" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.3 else f"own line {i} {j} {rng.random()}"
                          for j in range(rng.randint(1, 12)))) for i in range(300)]
    rows += [(i, "a line that a third of all documents hold\nand " + str(i) * 20) for i in range(300, 450)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(line_dedup(df)) == brute(rows)


def test_filters_never_miss_a_repeat():
    rng = np.random.default_rng(0)
    for log2 in (3, 10, 16):
        f = TwoFilters(log2)
        once, many = rng.integers(0, 2**63, 400).astype(np.uint64), rng.integers(0, 2**63, 50).astype(np.uint64)
        f.enter(np.concatenate([once[:200], many]))
        f.enter(np.concatenate([once[200:], many]))
        at = places(many, log2)
        assert ((f.twice[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all()


def test_empty_table(no_docs):
    assert line_dedup(no_docs).count() == 0
