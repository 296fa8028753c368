import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfare.llm import queries
from skyfare.llm.best_fit import complements, cut_documents, pack_best_fit, sequences

WORDS = public_tokenizers.path("word_bpe_49k.json")


def counts_of(lengths, capacity):
    return np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)


def check_plan(lengths, capacity):
    plan = complements(counts_of(lengths, capacity), capacity)
    used = Counter()
    for held, times in plan:
        assert times > 0 and 0 < sum(x * k for x, k in held.items()) <= capacity
        for x, k in held.items():
            used[x] += k * times
    assert used == Counter(lengths)
    return sum(times for _, times in plan)


def fewest(lengths, capacity):
    """Least number of sequences, by trying all ways."""
    items = tuple(sorted(lengths, reverse=True))

    @cache
    def go(rest, gaps):
        if not rest:
            return 0
        options = [1 + go(rest[1:], tuple(sorted((*gaps, capacity - rest[0]))))]
        for i, g in enumerate(gaps):
            if g >= rest[0] and g not in gaps[:i]:
                options.append(go(rest[1:], tuple(sorted((*gaps[:i], g - rest[0], *gaps[i + 1:])))))
        return min(options)

    return go(items, ())


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


@given(st.lists(st.integers(1, 20), max_size=9))
@settings(max_examples=120, deadline=None)
def test_plan_against_all_ways(lengths):
    n = check_plan(lengths, 20)
    assert fewest(lengths, 20) <= n <= fewest(lengths, 20) + 1


@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 100), st.integers(5, 100))
@settings(max_examples=60, deadline=None)
def test_plan_against_best_fit(seed, n, low, high):
    lengths = np.random.default_rng(seed).integers(min(low, high), max(low, high) + 1, n).tolist()
    assert check_plan(lengths, 100) <= best_fit_decreasing(lengths, 100) + 1


def test_exact_fills():
    assert check_plan([60, 40] * 50, 100) == 50
    assert check_plan([50, 30, 20] * 40, 100) == 40
    assert check_plan([40, 30, 20, 10] * 30, 100) == 30
    assert check_plan([34] * 9, 100) == 5
    assert check_plan([25] * 4 + [100] * 3 + [1] * 250, 100) == 7


def check_places(rows, capacity):
    """Every sequence is filled from 0 without a gap and holds at most ``capacity`` tokens."""
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_take_the_places_of_the_plan(spark):
    rng = np.random.default_rng(1)
    lengths = rng.geometric(0.03, 3000).clip(1, 256).tolist() + [40] * 1500  # a third are of one length
    df = spark.createDataFrame([(i % 100, n, "x", 0) for i, n in enumerate(lengths)],
                               "doc_id long, length int, place string, offset_ int").repartition(7)
    rows = pack_best_fit(df, 256).collect()
    assert Counter((r.doc_id, r.length) for r in rows) == Counter((i % 100, n) for i, n in enumerate(lengths))
    assert check_places(rows, 256) == check_plan(lengths, 256) == -(-sum(lengths) // 256)


def expected_pieces(rows, capacity, end_id):
    library = Tokenizer.from_file(WORDS)
    out = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        for p, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], "<u4").tobytes()
            out.append((doc_id, p, start, len(part) // 4, zlib.crc32(part)))
    return sorted(out, key=str)


def test_edge_documents_against_the_library(spark, edge_docs):
    from conftest import edge_rows
    pieces = cut_documents(edge_docs, WORDS, 64, 1)
    packed = pack_best_fit(pieces, 64).withColumn("crc", F.crc32("ids"))
    rows = packed.collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.crc) for r in rows], key=str) == expected_pieces(edge_rows(), 64, 1)
    n = check_places(rows, 64)
    assert n == check_plan([r.length for r in rows], 64)
    whole = {r.sequence_id: r for r in sequences(packed).collect()}
    assert len(whole) == n and sum(r.pieces for r in whole.values()) == len(rows)
    for r in rows:
        assert whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)] == r.ids


def test_query_on_documents(spark):
    rows = queries.op13_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == expected_pieces(docs, 4096, 1)
    assert check_places(rows, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_empty_table_and_bad_lengths(spark, no_docs):
    assert pack_best_fit(cut_documents(no_docs, WORDS, 64, 1), 64).count() == 0
    rows = spark.createDataFrame([(1, 0), (2, None), (3, 5)], "doc_id long, length long")
    assert [(r.doc_id, r.offset) for r in pack_best_fit(rows, 8).collect()] == [(3, 0)]
    with pytest.raises(Exception, match="a piece of length 9"):
        pack_best_fit(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8).collect()


def test_words_give_the_ids_of_whole_texts():
    import pyarrow as pa
    from conftest import edge_rows
    from skyfare.llm.word_ids import RaggedEncoder
    with open(WORDS, "rb") as f:
        content = f.read()
    library = Tokenizer.from_file(WORDS)
    texts = [t or "" for _, t in edge_rows()]
    texts += ["don't <|startoftext|>x DON'T<|endoftext|> it's 12,5% (a-b)!!", "é É É, été; ǅ İi ﬁ 中文。ok", "a\x1cb\x85c\xa0d",
              "<|StartOfText|> x", "...", "!?a!?", "9,9.", "naïve, ÿ; Ɏ! ɐ? ʰ."]
    for size in (1, len(texts)):
        encoder = RaggedEncoder(content)
        encoder.KEEP_WORDS = 50
        for at in range(0, len(texts), size):
            part = texts[at:at + size]
            ids, ends = encoder.ragged(pa.array(["skipped", *part]).slice(1))
            want = [library.encode(t, add_special_tokens=False).ids for t in part]
            assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == want
