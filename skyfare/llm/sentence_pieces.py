"""SentencePiece encoding and decoding of whole texts (``piece_fst``).

A null text counts as empty: no ids, and it decodes to the empty text.  Invalid
UTF-8 reads as U+FFFD.  The
space mark U+2581 in a text decodes to a space, as in the library.  Repeated
rows get equal results; null ids pass through; extra columns are not read; an
empty table gives an empty result.  The model file's content is broadcast (a few
MB, checked).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import prepare, slices, texts, worker_state
from skyfare.llm.piece_fst import PieceTransducer
from skyfare.llm.token_counts import shared_file

#: Ids decoded at once.
DECODE_ROWS = 256


def _transducer(content: bytes) -> PieceTransducer:
    return worker_state(("pieces", hash(content)), lambda: PieceTransducer(content))


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) with ids as array<int>, without begin and end marks."""
    content = shared_file(prepare(docs), model_path)

    def task(batches):
        transducer = _transducer(content.value)
        for batch in slices(batches):
            found = transducer.encode(texts(batch.column("text")))
            ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), values)],
                                             names=["id", "ids"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(task, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text) of frames with ids; null ids decode to the empty text."""
    content = shared_file(prepare(encoded), model_path)

    def task(batches):
        transducer = _transducer(content.value)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(at, DECODE_ROWS)
                ends = part.column("ids").offsets.to_numpy()
                values = part.column("ids").flatten().to_numpy(zero_copy_only=False).tolist()
                ends = (ends - ends[0]).tolist()
                out = [transducer.decode(values[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), pa.array(out, pa.string())],
                                                 names=["id", "ids", "text"])

    encoded = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.mapInArrow(task, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)
