"""Line dedup by two Bloom filters for line keys seen once and seen twice.

1. Every partition enters its documents' distinct keys into a once-seen and a
   twice-seen filter and emits them as compressed segments.
2. For each segment the partitions' filters are merged as a stream: a bit that
   two partitions set is a twice-seen bit.  The merged twice-seen filter, of a
   fixed size at most, is broadcast.
3. Only lines whose key the filter suspects are shuffled: grouped by their exact
   key, with partial aggregation, for the number of documents and the document
   that keeps the line.  Documents without a suspect pass as they are.

A key is the line with [\\x20\\x09-\\x0D] stripped at both ends and A-Z in lower
case.  Keys of at least ``min_chars`` code points that at least ``min_docs``
documents hold lose all their lines but those in the largest id that holds
them.  A filter that is too small for the input suspects more lines, which costs
time but never changes the result.

A null text counts as empty, and an empty text is one empty line.  Texts of
invalid UTF-8 keep their bytes and keys compare by bytes; an invalid sequence
counts as one code point.  Each row
counts as one document, repeated rows too; rows with the largest id all keep the
line.  Null ids are below all others.  Extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import join_by_class, prepare, slices, text_bytes
from skyfare.session import write_once

HASHES = 4
#: A filter has about so many bits for each line, between these bounds (powers of two; 64 MB at most).
BITS_PER_LINE, MIN_LOG2, MAX_LOG2 = 8, 16, 29
SEGMENT_LOG2 = 20
#: Hashes entered into the filters at once.
ENTER = 1 << 18


def keys_of(text: bytes, min_chars: int) -> tuple[list[bytes], list[int], int]:
    """(keys long enough, their line numbers, number of lines)."""
    lines = text.split(b"\n")
    keys, at = [], []
    for i, line in enumerate(lines):
        if len(line) >= min_chars:
            key = line.strip().lower()
            if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode(errors="replace")) >= min_chars:
                keys.append(key)
                at.append(i)
    return keys, at, len(lines)


def places(hashes: np.ndarray, log2: int) -> np.ndarray:
    """(HASHES, n) bit places by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes[None, :] + step[None, :] * np.arange(HASHES, dtype=np.uint64)[:, None])
            & np.uint64((1 << log2) - 1)).astype(np.int64)


class TwoFilters:
    """Once-seen and twice-seen bits, one byte each while a partition is read."""

    def __init__(self, log2: int):
        self.log2 = log2
        self.once = np.zeros(1 << max(0, log2 - 3), np.uint8)
        self.twice = np.zeros(1 << max(0, log2 - 3), np.uint8)

    @staticmethod
    def _set(bits, at):
        np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def enter(self, hashes: np.ndarray) -> None:
        found, count = np.unique(hashes, return_counts=True)
        at = places(found, self.log2)
        seen = ((self.once[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0) | (count > 1)
        self._set(self.twice, at[:, seen].ravel())
        self._set(self.once, at.ravel())


def _fill(log2: int, min_chars: int):
    segment = 1 << (min(log2, SEGMENT_LOG2) - 3)

    def task(batches):
        filters, held, n = TwoFilters(log2), [], 0
        for batch in slices(batches):
            for text in text_bytes(batch.column("text")):
                own = {xxhash.xxh64_intdigest(k) for k in keys_of(text, min_chars)[0]}
                held.append(np.fromiter(own, np.uint64, len(own)))
                n += len(own)
            if n >= ENTER:
                filters.enter(np.concatenate(held))
                held, n = [], 0
        if n:
            filters.enter(np.concatenate(held))
        part = TaskContext.get().partitionId()
        for s in range(0, len(filters.once), segment):
            once, twice = filters.once[s:s + segment], filters.twice[s:s + segment]
            if once.any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([s // segment], pa.int32()), "part": pa.array([part], pa.int32()),
                    "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
                    "twice": pa.array([zlib.compress(twice.tobytes(), 1) if twice.any() else None], pa.binary())})

    return task


def _merge(batches):
    """Merge each segment's filters; the rows come sorted by segment."""
    def close(now, twice):
        return pa.RecordBatch.from_pydict({"segment": pa.array([now], pa.int32()),
                                           "bits": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    now, once, twice = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            bits = np.frombuffer(zlib.decompress(row["once"]), np.uint8)
            if row["segment"] != now:
                if now is not None and twice.any():
                    yield close(now, twice)
                now, once, twice = row["segment"], np.zeros_like(bits), np.zeros_like(bits)
            twice |= once & bits
            once |= bits
            if row["twice"] is not None:
                twice |= np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    if now is not None and twice.any():
        yield close(now, twice)


def repeated_filter(docs: DataFrame, min_chars: int) -> tuple[int, bytes]:
    """(log2 of the bits, compressed bits) of the twice-seen filter over all of ``docs``."""
    # an upper estimate of the keys: a line is a newline at least and min_chars long
    size = F.octet_length("text")
    newlines = size - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = docs.agg(F.sum(F.least(newlines + 1, F.floor(size / min_chars)).cast("long"))).first()[0]
    log2 = min(MAX_LOG2, max(MIN_LOG2, int(BITS_PER_LINE * max(1, lines or 0) - 1).bit_length()))
    filled = docs.select("text").mapInArrow(_fill(log2, min_chars),
                                            "segment int, part int, once binary, twice binary")
    segments = 1 << max(0, log2 - SEGMENT_LOG2)
    merged = (filled.repartition(segments, "segment").sortWithinPartitions("segment")
              .mapInArrow(_merge, "segment int, bits binary")).collect()  # bounded by MAX_LOG2
    size = 1 << (min(log2, SEGMENT_LOG2) - 3)
    bits = np.zeros(1 << (log2 - 3), np.uint8)
    for row in merged:
        bits[row["segment"] * size:(row["segment"] + 1) * size] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return log2, bits.tobytes()


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, text without the repeated lines, n_lines before, n_dropped) for each row of ``docs``."""
    spark = prepare(docs)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_kind = docs.schema["id"].dataType.simpleString()
    log2, bits = repeated_filter(docs, min_chars)
    shared = spark.sparkContext.broadcast(bits)

    def suspect(batches):
        row = TaskContext.get().partitionId() << 33
        twice = np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches):
            found = [keys_of(t, min_chars) for t in text_bytes(batch.column("text"))]
            hashes = np.array([xxhash.xxh64_intdigest(k) for keys, _, _ in found for k in keys], np.uint64)
            at = places(hashes, log2)
            hit = ((twice[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)
            suspects, start = [], 0
            for keys, lines, _ in found:
                own: dict[bytes, list[int]] = {}
                for i in np.flatnonzero(hit[start:start + len(keys)]).tolist():
                    own.setdefault(keys[i], []).append(lines[i])
                suspects.append([{"key": k, "lines": v} for k, v in own.items()])
                start += len(keys)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column("id"), batch.column("text"),
                 pa.array([x[2] for x in found], pa.int64()),
                 pa.array(suspects, pa.list_(pa.struct([("key", pa.binary()), ("lines", pa.list_(pa.int32()))])))],
                names=["row", "id", "text", "n_lines", "suspects"])
            row += n

    def cut(batches):
        for batch in slices(batches):
            out = []
            for text, drop in zip(text_bytes(batch.column("text")), batch.column("drop").to_pylist(), strict=True):
                gone = set(drop or ())
                out.append(b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(out, pa.binary()).view(pa.string()), batch.column("n_lines"),
                 pa.array([len(x or ()) for x in batch.column("drop").to_pylist()], pa.int64())],
                names=["id", "text", "n_lines", "n_dropped"])

    marked = write_once(docs.mapInArrow(
        suspect, f"row long, id {id_kind}, text string, n_lines long, "
                 "suspects array<struct<key: binary, lines: array<int>>>"), "line-dedup-marked")
    held = marked.filter("size(suspects) > 0")
    lines = held.select("row", "id", F.explode("suspects").alias("s")).select("row", "id", "s.key", "s.lines")
    # counted by the exact key; what goes back to the rows is its digest, so the join's rows are small
    digest = F.unhex(F.sha2("key", 256)).alias("digest")
    repeated = (lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
                .filter(F.col("docs") >= min_docs).select(digest, "docs", "keeper"))
    repeated = write_once(repeated, "line-dedup-repeated")
    drops = (join_by_class(lines.select("row", "id", digest, "lines"), repeated, "digest", "docs").filter(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy("row").agg(F.flatten(F.collect_list("lines")).alias("drop")))
    columns = ["id", "text", "n_lines", "n_dropped"]
    changed = (held.select("row", "id", "text", "n_lines").join(drops, "row", "left").drop("row")
               .mapInArrow(cut, f"id {id_kind}, text string, n_lines long, n_dropped long"))
    same = marked.filter("size(suspects) = 0").select(
        "id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", F.lit(0).cast("long").alias("n_dropped"))
    return same.select(columns).unionByName(changed.select(columns)).withColumnsRenamed(
        {"id": id_col, "text": text_col})
