"""Texts with the bytes 61 FF 20 62 go through every operator: each row comes back, by the rule of its docstring."""

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skyfare.llm import lang_id
from skyfare.llm.best_fit import cut_documents, pack_best_fit
from skyfare.llm.license_scan import license_scan
from skyfare.llm.line_dedup import line_dedup
from skyfare.llm.sentence_pieces import decode_pieces, encode_pieces
from skyfare.llm.simhash import simhash_components
from skyfare.llm.token_counts import token_counts
from skyfare.llm.token_files import read_token_files, write_token_files

BAD = b"a\xff b"
LINE = b"a line of some length with \xff in it"


@pytest.fixture(scope="module")
def bad_docs(spark, tmp_path_factory):
    """Rows 0 to 19 of plain texts, 20 and 21 with invalid bytes, 30 to 32 with a shared line of invalid bytes."""
    rows = [(i, f"some plain words of text number {i}".encode()) for i in range(20)]
    rows += [(20, BAD), (21, BAD)] + [(30 + i, LINE + b"\nown %d" % i) for i in range(3)]
    path = str(tmp_path_factory.mktemp("bad") / "documents.parquet")
    (spark.createDataFrame([(i, bytearray(t)) for i, t in rows], "doc_id long, raw binary")
     .select("doc_id", F.col("raw").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
             F.lit(1).cast("long").alias("n_chars")).write.parquet(path))
    return spark.read.parquet(path), dict(rows), path


def test_tokens(spark, bad_docs, tmp_path):
    docs, raw, _ = bad_docs
    read = {i: t.decode(errors="replace") for i, t in raw.items()}
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, P.path("byte_bpe_50k.json")).collect()}
    assert got == {i: (len(raw[i]), len(library.encode(t).ids)) for i, t in read.items()}
    words = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(words)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in read.items()}
    manifest = write_token_files(docs, words, str(tmp_path / "ids"), end_id=2)
    files = read_token_files(spark, str(tmp_path / "ids"), manifest).collect()
    assert {r.doc_id: r.n_tokens for r in files} == want
    assert {r.doc_id: r.length for r in pack_best_fit(cut_documents(docs, words, 4096, 1), 4096).collect()} == want
    model = P.path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    both = decode_pieces(encode_pieces(docs, model), model).collect()
    assert {r.doc_id: r.ids for r in both} == {i: pieces.encode(t) for i, t in read.items()}


def test_lines_keep_their_bytes(bad_docs):
    docs, raw, _ = bad_docs
    got = {r.doc_id: (r.n_dropped, bytes(r.raw)) for r in
           line_dedup(docs, 20, 3).withColumn("raw", F.col("text").cast("binary")).drop("text").collect()}
    assert got == {i: (1, b"own %d" % (i - 30)) if i in (30, 31) else (0, t) for i, t in raw.items()}


def test_other_operators(bad_docs):
    docs, raw, _ = bad_docs
    assert license_scan(docs, {"mit license": "mit"}, {}).count() == len(raw)
    found = {r.doc_id: r.component_id for r in simhash_components(docs, 3, 3).collect()}
    assert len(found) == len(raw) and found[21] == 20
    langs = {r.doc_id: r.lang_pred for r in lang_id.predict(docs, lang_id.fit(docs)).collect()}
    assert langs == {i: "en" for i in raw}


def test_pipeline(spark, bad_docs):
    _, raw, path = bad_docs
    folder = path.removesuffix("/documents.parquet")
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, folder)
    assert {r.doc_id: bytes(r.raw) for r in docs.select("doc_id", F.col("text").cast("binary").alias("raw")).collect()} == {
        i: t for i, t in raw.items() if i != 21}
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= set(raw) - {21}
