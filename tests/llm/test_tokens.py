import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyfare.llm.bpe_arrays import ByteBpe
from skyfare.llm.piece_fst import PieceTransducer
from skyfare.llm.sentence_pieces import decode_pieces, encode_pieces
from skyfare.llm.token_counts import token_counts
from skyfare.llm.token_files import Encoder, encoded, read_documents, read_token_files, write_token_files
from skyfare.llm.word_ids import RaggedEncoder
from tests.llm.conftest import edge_rows

BYTES, WORDS, PIECES = (public_tokenizers.path(x) for x in
                        ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def content(path):
    with open(path, "rb") as f:
        return f.read()


def odd_texts(n=1500, seed=0):
    rng = random.Random(seed)
    letters = "ab \n\t\r\x0b\x1c\x1f\x85\xa0éßΣς中文।१२٣4'sre<|endoftext|>aaaa!!..,▁  　​́😀ॐH̱KİtheING"
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    any_ = ["".join(chr(rng.choice([rng.randint(1, 0x24F), rng.randint(1, 0xD7FF)])) for _ in range(30))
            for _ in range(n // 3)]
    parts = ["it's", "we'LL", "foo", ",", ".", "!", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "É", "1", "a.", "\n"]
    mixed = ["".join(rng.choice(parts) for _ in range(12)) for _ in range(n // 3)]
    return some + any_ + mixed + ["", " ", "  ", "▁", "a" * 3000, "ab" * 2000, " " * 500, "\n" * 50]


def test_byte_bpe_equals_library():
    texts, own = odd_texts(), ByteBpe(content(BYTES))
    want = [len(e) for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert own.together and own.count(texts) == want
    own = ByteBpe(content(BYTES))
    own.together = False  # one place at a time gives the same
    assert own.count(texts[:300]) == want[:300]


def test_token_counts_of_edges(edge_docs):
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in
                   token_counts(edge_docs, BYTES).collect()))
    library = Tokenizer.from_file(BYTES)
    assert rows == sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or "").ids))
                          for i, t in edge_rows())


def test_encoder_equals_library():
    texts, own = odd_texts(seed=1), Encoder(content(WORDS), 4)
    library = Tokenizer.from_file(WORDS)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own([t.encode() for t in texts])] == want
    own.by_word = False
    assert [np.frombuffer(x, "<u4").tolist() for x in own([t.encode() for t in texts])] == want


@pytest.mark.parametrize("end, width", [(2, 2), (None, 4)])
def test_files_are_encoded_a_batch_at_a_time_and_not_text_by_text(monkeypatch, end, width):
    def text_by_text(self, texts):
        raise AssertionError("slow path")
    monkeypatch.setattr(Encoder, "__call__", text_by_text)
    texts = [None, *odd_texts(seed=4), None]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    library = Tokenizer.from_file(WORDS)
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    want = [(i, e.ids + ([] if end is None else [end])) for i, e in enumerate(found)]
    parts = encoded(RaggedEncoder(content(WORDS)), [batch.slice(0, 0), batch.slice(0, 7), batch.slice(7)], end, width)
    rows = [r for part in parts for r in part.to_pylist()]
    assert [(r["id"], np.frombuffer(r["ids"], f"<u{width}").tolist()) for r in rows] == want
    assert [r["n"] for r in rows] == [len(ids) for _, ids in want]


@pytest.mark.parametrize("file_ids", [1 << 23, 500])
def test_token_files_round_trip(spark, edge_docs, tmp_path, file_ids):
    folder = str(tmp_path / "ids")
    manifest = write_token_files(edge_docs, WORDS, folder, end_id=2, file_ids=file_ids)
    rows = read_token_files(spark, folder, manifest).collect()
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    want = sorted((i is not None, i or 0, library.encode(t or "", add_special_tokens=False).ids + [2])
                  for i, t in edge_rows())
    got = sorted(((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in rows))
    assert got == want
    in_order, start = sorted(rows, key=lambda r: r.start), 0
    assert [(r.doc_id is not None, r.doc_id or 0) for r in in_order] == [w[:2] for w in want]  # null ids first
    for r in in_order:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    first = sorted(manifest.collect())[0]
    assert sum(r.docs for r in manifest.collect()) == len(want)
    alone = read_documents(folder, first.file, [0, first.docs - 1])
    assert alone[0].astype("<u4").tobytes() == in_order[0].ids
    assert zlib.crc32(alone[1].astype("<u4").tobytes()) == zlib.crc32(in_order[first.docs - 1].ids)


def test_pieces_equal_library():
    own, library = PieceTransducer(content(PIECES)), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts(seed=2)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids)
        if "▁" not in text:
            assert own.decode(ids) == text


def test_unigram_path_is_the_shortest():
    own = PieceTransducer(content(PIECES))
    rng = random.Random(4)
    for _ in range(50):
        unit = "▁" + "".join(rng.choice("etaonis") for _ in range(8))
        best = {0: (0.0, [])}
        for end in range(1, len(unit) + 1):
            best[end] = max((best[s][0] + own.score[unit[s:end]], best[s][1] + [unit[s:end]])
                            for s in range(end) if unit[s:end] in own.score)
        assert sum(map(own.score.__getitem__, own._unigram_path(unit))) == pytest.approx(best[len(unit)][0])


def test_pieces_of_edges(edge_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = decode_pieces(encode_pieces(edge_docs, PIECES), PIECES).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.text) for r in rows)
    assert got == sorted((i is None, i or 0, library.encode(t or ""), t or "") for i, t in edge_rows())


def test_empty_tables(spark, no_docs, tmp_path):
    assert token_counts(no_docs, BYTES).count() == 0
    assert decode_pieces(encode_pieces(no_docs, PIECES), PIECES).count() == 0
    folder = str(tmp_path / "none")
    assert read_token_files(spark, folder, write_token_files(no_docs, WORDS, folder)).count() == 0
