"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each partition normalises and hashes its texts and sends, to the owner of
   each range of the fingerprint space, its sorted distinct fingerprints as one
   Golomb-coded message.
2. Each owner decodes its messages and answers each with a bitmap: bit i is set
   if the i-th fingerprint came from another message too.
3. Rows behind a set bit, or repeated within their own message, are suspects.
   Only their texts are shuffled, grouped by their bytes with partial
   aggregation first, so that a text held by a third of all rows is one row
   for each map task.

White space is compared as one space for each run of [\\x20\\x09-\\x0D].  A null
text counts as empty; empty texts are equal to each other.  Repeated rows are
copies like any other.  Texts are compared as bytes, also where these are not
valid UTF-8.  Of equal texts the row with the smallest id stays; null
ids come last; between rows of the same id and text exactly one stays.  Only the
id and text columns are read, so extra columns of any name do no harm.  An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm import golomb
from skyfare.llm.common import join_by_class, prepare, rows_of_ids, slices, text_bytes
from skyfare.session import write_once

FINGERPRINT_BITS = 48
#: Documents in a message at most: what a task holds is bounded by it.
RUN_DOCS = 1 << 17
MAX_OWNERS = (1 << 15) - 1

WHITE = b" \t\n\x0b\x0c\r"


def squeeze(text: bytes) -> bytes:
    """Each run of ASCII white space as one space (also at the ends)."""
    words = text.split()
    if not words:
        return b" " if text else b""
    out = b" ".join(words)
    if text[0] in WHITE:
        out = b" " + out
    return out + b" " if text[-1] in WHITE else out


def _normed(batches):
    """Task function: normalised texts as bytes, by the function that the fingerprints are made with."""
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([squeeze(t) for t in text_bytes(batch.column("text"))], pa.binary())], names=["norm"])


def _send(owners: int, id_type: pa.DataType):
    """Task function: document rows (kind 0) and messages to the owners (kind 1)."""
    fields = [("kind", pa.int32()), ("run", pa.int64()), ("owner", pa.int32()), ("pos", pa.int32()),
              ("ord", pa.int32()),
              ("again", pa.bool_()), ("id", id_type), ("sha", pa.binary()), ("n", pa.int32()), ("code", pa.binary())]
    schema = pa.schema(fields)

    def rows(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def flush(run, ids, shas):
        digests = np.frombuffer(b"".join(shas), np.uint8).reshape(-1, 32)
        wide = np.zeros((len(shas), 8), np.uint8)
        wide[:, 2:] = digests[:, :6]
        prints = wide.view(">u8").ravel().astype(np.int64)
        found, inverse, count = np.unique(prints, return_inverse=True, return_counts=True)
        owner = (found * owners) >> FINGERPRINT_BITS
        first = np.searchsorted(owner, np.arange(owners))
        pos = np.arange(len(found)) - first[owner]
        all_ids = pa.concat_arrays(ids)
        for at in range(0, len(shas), 16384):
            part = inverse[at:at + 16384]
            yield rows(kind=pa.nulls(len(part), pa.int32()).fill_null(0),
                       run=pa.array(np.full(len(part), run)),
                       owner=pa.array(owner[part].astype(np.int32)), pos=pa.array(pos[part].astype(np.int32)),
                       ord=pa.array(np.arange(at, at + len(part), dtype=np.int32)), again=pa.array(count[part] > 1), id=all_ids.slice(at, len(part)),
                       sha=pa.array(shas[at:at + 16384], pa.binary()))
        ends = np.append(first[1:], len(found))
        to = np.flatnonzero(ends > first)
        codes = [golomb.encode(found[first[o]:ends[o]] - -(-(int(o) << FINGERPRINT_BITS) // owners),
                               (1 << FINGERPRINT_BITS) // owners + 1) for o in to]
        yield rows(kind=pa.nulls(len(to), pa.int32()).fill_null(1), run=pa.array(np.full(len(to), run)),
                   owner=pa.array(to.astype(np.int32)), n=pa.array((ends - first)[to].astype(np.int32)),
                   code=pa.array(codes, pa.binary()))

    def task(batches):
        run = TaskContext.get().partitionId() << 24
        ids, shas = [], []
        for batch in slices(batches):
            shas += [hashlib.sha256(squeeze(t)).digest() for t in text_bytes(batch.column("text"))]
            ids.append(batch.column("id"))
            if len(shas) >= RUN_DOCS:
                yield from flush(run, ids, shas)
                run, ids, shas = run + 1, [], []
        if shas:
            yield from flush(run, ids, shas)

    return task


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """Owner: for each message, the bitmap of fingerprints that other messages hold too."""
    sizes = messages["n"].to_numpy(np.int64)
    values = np.concatenate([golomb.decode(c, n) for c, n in zip(messages["code"], sizes, strict=True)])
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    held = np.zeros(len(values), bool)
    held[order[1:][same]] = True
    held[order[:-1][same]] = True
    starts = np.cumsum(sizes) - sizes
    bitmaps = [np.packbits(held[s:s + n], bitorder="little").tobytes() if held[s:s + n].any() else None
               for s, n in zip(starts, sizes, strict=True)]
    out = pd.DataFrame({"run": messages["run"], "owner": messages["owner"], "bitmap": bitmaps})
    return out[out["bitmap"].notna()]


def fingerprint_exchange(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """(id, run, ord, sha, suspect) for each row of ``docs`` (id, text), written once."""
    prepare(docs)
    owners = min(MAX_OWNERS, owners or max(1, docs.rdd.getNumPartitions()))
    id_type = docs.schema["id"].dataType.simpleString()
    arrow_id = docs.select("id").limit(0).toArrow().schema.field("id").type
    sent = docs.mapInArrow(
        _send(owners, arrow_id),
        f"kind int, run long, owner int, pos int, ord int, again boolean, id {id_type}, sha binary, n int, code binary")
    sent = write_once(sent, "exact-dedup-sent")
    rows = sent.filter("kind = 0").select("id", "run", "owner", "pos", "ord", "again", "sha")
    messages = sent.filter("kind = 1").select("run", "owner", "n", "code")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer, "run long, owner int, bitmap binary")
    byte = F.conv(F.hex(F.expr("substring(bitmap, pos div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("1 << (pos % 8)").bitwiseAND(byte) != 0
    flagged = rows.join(bitmaps, ["run", "owner"], "left").select(
        "id", "run", "ord", "sha", (F.col("again") | F.coalesce(bit, F.lit(False))).alias("suspect"))
    return write_once(flagged, "exact-dedup-flagged")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                owners: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``owners``: number of fingerprint ranges (default: the input's partitions).
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    flagged = fingerprint_exchange(docs, owners)
    suspects = flagged.filter("suspect")
    # byte verification: the grouping key is the whole normalised text
    texts = rows_of_ids(docs, suspects, "id", "left_semi").select("text").mapInArrow(_normed, "norm binary")
    distinct = texts.groupBy("norm").agg(F.count(F.lit(1)).alias("rows"))
    verified = (distinct.select(F.unhex(F.sha2("norm", 256)).alias("sha"))
                .groupBy("sha").agg(F.count(F.lit(1)).alias("texts")))
    groups = (suspects.groupBy("sha")
              .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "run", "ord")).alias("first"),
                   F.count(F.lit(1)).alias("group_size"))
              .join(verified, "sha", "left")
              .select("sha", F.col("first.id").alias("keep_id"), F.col("first.run").alias("keep_run"),
                      F.col("first.ord").alias("keep_ord"),
                      F.when(F.col("texts") == 1, F.col("group_size"))
                      .when(F.col("texts").isNull(), F.raise_error(F.lit("no text has a suspect's SHA-256")))
                      .otherwise(F.raise_error(F.lit("two different texts have one SHA-256"))).alias("group_size")))
    groups = write_once(groups, "exact-dedup-groups")
    members = join_by_class(suspects, groups, "sha", "group_size").select(
        "id", "keep_id", "group_size",
        ((F.col("run") == F.col("keep_run")) & (F.col("ord") == F.col("keep_ord"))).alias("kept"), "sha")
    single = flagged.filter("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return single.unionByName(members).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
