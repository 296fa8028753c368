import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfare.llm import crf, lang_id
from skyfare.llm.lang_id import Labeller, Model
from skyfare.llm.queries import held_out, op7_language_id
from tests.llm.conftest import edge_rows


@pytest.mark.parametrize("n", [1, 5, crf.BLOCK, 3 * crf.BLOCK + 17])
def test_forward_backward_against_enumeration_of_steps(n):
    rng = np.random.default_rng(n)
    k = 3
    b, start = rng.random((n, k)).astype(np.float32), rng.random(n) < 0.05
    start[0] = True
    trans, first = rng.random((k, k)), rng.random(k)
    gamma = crf.forward_backward(b, start, trans, first)[2]
    ends = [*np.flatnonzero(start), n]
    for s, e in zip(ends, ends[1:]):
        alpha, beta = np.zeros((e - s, k)), np.ones((e - s, k))
        alpha[0] = first * b[s]
        for t in range(1, e - s):
            alpha[t] = (alpha[t - 1] @ trans) * b[s + t]
            alpha[t] /= alpha[t].sum()
        for t in range(e - s - 2, -1, -1):
            beta[t] = trans @ (b[s + t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        want = alpha * beta
        assert np.allclose(gamma[s:e], want / want.sum(axis=1, keepdims=True), atol=1e-5)


def test_gradient_lowers_the_loss_and_learns_transitions():
    rows = [("aa", "aba abb bab aab " * 5), ("bb", "xyx yxy xxy yyx " * 5)] * 20
    model = Model(rows)
    langs, score = Labeller(model)(["aba bab", "xyx yyx", "aba bab abb xyx"])
    assert langs == ["aa", "bb", "aa"] and score[0] > 0.9 and score[1] > 0.9
    assert model.trans[0, 0] > model.trans[0, 1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == 1000
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    part = found[found.held_out]
    assert (part.lang == part.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_code_switched_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(~held_out())
    model = lang_id.fit(docs)
    by = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    labeller = Labeller(model)
    words = [labeller.find(by[x].lower())[:80] for x in ("en", "fr")]
    stream = words[0] + words[1]
    start = np.zeros(len(stream), bool)
    start[0] = True
    label = labeller.marginals(stream, start).argmax(axis=1)
    en, fr = model.labels.index("en"), model.labels.index("fr")
    assert (label[:80] == en).mean() > 0.9 and (label[80:] == fr).mean() > 0.9


def test_edges(edge_docs, monkeypatch):
    model = Model([("aa", "alpha beta gamma delta the of word"), ("zz", "中文 été straße head tail line")] * 5)
    rows = lang_id.predict(edge_docs, model).collect()
    assert len(rows) == len(edge_rows())
    no_letter = sorted(i for i, t in edge_rows() if i is not None and not any(c.isalpha() for c in t or ""))
    assert sorted(r.doc_id for r in rows if r.lang_pred == "und" and r.doc_id is not None) == no_letter
    assert all(r.score == 0 for r in rows if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in rows)
    found = {r.doc_id: r.lang_pred for r in rows}
    monkeypatch.setattr(lang_id, "PIECE", 7)  # long texts piece by piece: every word still counts
    monkeypatch.setattr(lang_id, "STREAM", 50)
    langs, score = Labeller(model)([t or "" for _, t in edge_rows()])
    assert found[50] == "aa" == dict(zip([i for i, _ in edge_rows()], langs, strict=True))[50]
    assert all(0 <= s <= 1 for s in score)


def test_no_labels_and_empty_table(spark, edge_docs, no_docs):
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    model = lang_id.fit(unlabelled)
    assert {r.lang_pred for r in lang_id.predict(edge_docs, model).collect()} == {"und"}
    assert lang_id.predict(no_docs, lang_id.fit(no_docs)).count() == 0


def test_every_language_is_sampled(spark):
    rows = [(i, f"word{i % 97} of many", f"l{i % 230:03d}") for i in range(230 * 3)]
    rows += [(10_000 + i, f"alpha {i}", "aa") for i in range(2000)] + [(20_000, "rare text", "zz")]
    rows += [(30_000 + i, "1 2 3", "yy") for i in range(50)] + [(40_000, "only letters here", "yy")]
    rows += [(50_000, "the very same", "xx")] * 700  # repeated rows, which share a key
    rows += [(60_000, "no label", None), (60_001, None, "ww")]
    df = spark.createDataFrame(rows, "id long, text string, lang string").repartition(5)
    found = lang_id.sample(df)
    assert {x for x, _ in found} == {x for _, t, x in rows if x and t}
    assert ("yy", "only letters here") in found
    assert len(found) <= 4 * 234 * lang_id.texts_per_lang(234)


def test_more_than_200_languages_are_learned(spark):
    langs = 210
    text = {i: " ".join(chr(0x4E00 + 8 * i + j) * 2 for j in range(6)) for i in range(langs)}
    df = spark.createDataFrame([(2 * i + c, text[i], f"l{i:03d}") for i in range(langs) for c in range(2)],
                               "doc_id long, text string, lang string")
    model = lang_id.fit(df)
    assert len(model.labels) == langs
    out = lang_id.predict(df, model).collect()
    assert [r for r in out if r.lang_pred != f"l{r.doc_id // 2:03d}"] == []


def test_many_labels_give_the_marginals_of_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    n, k = 3 * crf.BLOCK + 17, 7
    b, start = rng.random((n, k)).astype(np.float32), rng.random(n) < 0.02
    start[0] = True
    trans, first = rng.random((k, k)), rng.random(k)
    blocks = crf.forward_backward(b, start, trans, first)
    monkeypatch.setattr(crf, "BLOCK_LABELS", 3)
    for x, y in zip(blocks, crf.forward_backward(b, start, trans, first), strict=True):
        assert np.allclose(x, y, atol=1e-5)


@pytest.mark.parametrize("cells", [1, 40, 90, 10_000])
def test_parts_are_whole_sequences(cells, monkeypatch):
    monkeypatch.setattr(crf, "CELLS", cells)
    start = np.zeros(100, bool)
    start[[0, 3, 30, 31, 60, 95]] = True
    parts = crf._parts(start, 2)
    assert [i for p in parts for i in range(p.start, p.stop)] == list(range(100))
    assert all(start[p.start] and p.stop > p.start for p in parts)
