import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyfare.llm import queries
from skyfare.llm.common import keep_decided
from skyfare.llm.exact_dedup import exact_dedup
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"
KEEP = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # plant: no letter, null text, copies, a near copy
    base = docs.orderBy(F.desc("n_chars")).first()
    extra = [(10_000, "12 34 !!", "en", "s", 8), (10_001, None, "en", "s", 0),
             (10_002, base.text.replace(" ", "  "), base.lang, "s", 0), (10_003, base.text + " extra", base.lang, "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["language_id", "exact_dedup", "simhash_near_dedup", "packing"]

    kept = [(r.doc_id, r.text) for r in docs.collect()]
    docs = stages[0][1](spark, docs, SF).cache()
    assert docs.columns == KEEP
    clear = {i for i, t in kept if any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in docs.collect()} == clear

    docs = stages[1][1](spark, docs, SF).cache()
    first = {}
    for i, t in sorted((i, t) for i, t in kept if i in clear):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t), i)
    assert docs.columns == KEEP and {r.doc_id for r in docs.collect()} == set(first.values())

    before = sorted((r.doc_id, r.text) for r in docs.collect())
    docs = stages[2][1](spark, docs, SF).cache()
    roots = brute_components([brute_print(t) for _, t in before], [i for i, _ in before], 3)
    assert docs.columns == KEEP and {r.doc_id for r in docs.collect()} == set(roots)
    assert 10_003 not in set(roots)

    out = stages[3][1](spark, docs, SF)
    counts = queries.token_counts(docs, queries.public_tokenizers.path("byte_bpe_50k.json"))
    check(out.collect(), [(r.doc_id, r.n_tokens) for r in counts.collect()],
          queries.SEQUENCE, queries.BATCH_TOKENS, queries.BUCKETS)


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "n_tokens", "bucket", "bucket_len", "batch_id", "slot"] and out.count() > 0


@pytest.mark.parametrize("rows, left", [
    ([(1, "a b"), (2, "a  b"), (3, "c")], [(1, "a b"), (3, "c")]),
    ([(1, "a b"), (1, "a b"), (1, "c"), (None, "c"), (None, "d"), (None, "d")], [(1, "a b"), (1, "c"), (None, "d")])])
def test_keep_decided_with_repeated_and_null_ids(spark, rows, left):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").repartition(3)
    out = keep_decided(df, "doc_id", lambda d, key: exact_dedup(d, key).select(key, "kept"))
    assert out.columns == df.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=key) == left


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_language_stage_without_any_label(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    extra = [(10_000, "12 34 !!", None, "s", 8), (10_001, None, None, "s", 0), (10_002, "é", None, "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = corpus_pipeline.language_id(spark, docs, SF)
    assert out.columns == KEEP
    assert {r.doc_id for r in out.collect()} == \
        {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
