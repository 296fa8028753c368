"""Token counts of whole texts by rank-synchronous array merging (``bpe_arrays``).

A null text counts as empty: no bytes, no tokens.  Invalid UTF-8 reads as U+FFFD
for the tokens, while the bytes are those of the text as it is.  Repeated rows are counted
each; ids of any type, also null, pass through.  An empty table gives an empty
result.  The tokenizer file's content is broadcast (a few MB at most, checked),
so executors need no copy of the file.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.bpe_arrays import ByteBpe
from skyfare.llm.common import prepare, slices, texts, worker_state

MAX_FILE_BYTES = 64 << 20


def shared_file(spark, path: str):
    """A tokenizer file's content as a broadcast; its size is checked."""
    with open(path, "rb") as f:
        content = f.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def _counter(content: bytes) -> ByteBpe:
    """One counter in each worker process, with its memory of pre-tokens."""
    return worker_state(("byte-bpe", hash(content)), lambda: ByteBpe(content))


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row: UTF-8 bytes and tokens of the whole text."""
    spark = prepare(docs)
    content = shared_file(spark, tokenizer_path)

    def task(batches):
        counter = _counter(content.value)
        for batch in slices(batches):
            found = texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counter.count(found), pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(task, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
