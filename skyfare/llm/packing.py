"""Packing into length buckets whose boundaries minimise padding.

A dynamic program over the global length histogram (at most ``max_len`` rows)
chooses at most ``buckets`` padded lengths such that the total padding is least.
Inside each bucket, batches of ``budget // padded length`` sequences form; only a
bucket's last batch may hold fewer.

Texts longer than ``max_len`` tokens are cut into pieces of that length and a
rest, so that every token stands in exactly one sequence.  Rows of null length
or no tokens give one row with piece 0, no tokens and null bucket and batch.
Repeated rows are packed each; null ids pass through; extra columns are not
read; an empty table gives an empty result.

Sequences of a bucket are numbered without passing through one task: they are
spread over shards by a hash, numbered inside each shard, and the shards' sizes
give the offsets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfare.session import write_once

#: Sequences of a bucket that are numbered by one task, about.
SHARD_ROWS = 1 << 16


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Padded lengths (ascending) of least total padding for a histogram of ascending ``lengths``."""
    m = len(lengths)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    # best[j]: least padding of the first j lengths; a bucket of lengths i..j-1 is padded to lengths[j-1]
    best = np.concatenate([[0.0], lengths * n[1:] - tokens[1:]])
    came = [np.zeros(m + 1, np.int64)]
    for _ in range(1, min(buckets, m)):
        now, source = best.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (n[j] - n[:j]) - (tokens[j] - tokens[:j])
            source[j] = int(np.argmin(cost))
            now[j] = cost[source[j]]
        best = now
        came.append(source)
    bounds, j = [], m
    for source in reversed(came):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(source[j])
    return bounds[::-1]


def pack(lengths: DataFrame, max_len: int, budget: int, buckets: int = 16, id_col: str = "doc_id",
         tokens_col: str = "n_tokens", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each sequence: id, piece, n_tokens, bucket, bucket_len, batch_id, slot."""
    if budget < max_len:
        raise ValueError("a batch must have room for one sequence of max_len tokens")
    rows = write_once(
        lengths.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)).alias("n")), "packing-lengths")
    found = (rows.groupBy((F.col("n") % max_len).alias("rest"))
             .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(f"n div {max_len}")).alias("full")).collect())
    histogram = {r["rest"]: r["rows"] for r in found if r["rest"]}
    if full := sum(r["full"] for r in found):
        histogram[max_len] = full
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[x] for x in sizes.tolist()], np.int64)
    bounds = bucket_bounds(sizes, counts, buckets)
    per_batch = [budget // b for b in bounds]
    held = [int(counts[(sizes <= b) & (sizes > a)].sum()) for a, b in zip([0, *bounds], bounds)]
    batches = [-(-h // p) for h, p in zip(held, per_batch, strict=True)]
    first_batch = [sum(batches[:i]) for i in range(len(bounds))]
    shards = max(1, -(-int(counts.sum()) // shard_rows))

    def of_bucket(values, kind):
        table = F.array(*[F.lit(x) for x in values]) if values else F.array(F.lit(0))
        return F.get(table, F.col("bucket")).cast(kind)

    pieces = rows.filter("n > 0").select(
        "row", "id", F.explode(F.expr(f"sequence(0L, (n - 1) div {max_len})")).alias("piece"), "n")
    pieces = pieces.select("row", "id", "piece", F.least(F.lit(max_len), F.col("n") - F.col("piece") * max_len).alias("n"))
    below = F.filter(F.array(*[F.lit(b) for b in bounds] or [F.lit(0)]), lambda b: b < F.col("n"))
    pieces = (pieces.withColumn("bucket", F.size(below))
              .withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int")))
    before = F.sum("size").over(
        Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (pieces.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("size"))
               .select("bucket", "shard", F.coalesce(before, F.lit(0)).alias("offset")))
    nth = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("row", "piece"))
    placed = (pieces.withColumn("nth", nth).join(offsets, ["bucket", "shard"])
              .withColumn("place", F.col("offset") + F.col("nth") - 1)
              .withColumn("per_batch", of_bucket(per_batch, "long")))
    packed = placed.select(
        F.col("id").alias(id_col), "piece", F.col("n").alias("n_tokens"), "bucket",
        of_bucket(bounds, "long").alias("bucket_len"),
        (of_bucket(first_batch, "long") + F.expr("place div per_batch")).alias("batch_id"),
        F.expr("place % per_batch").cast("int").alias("slot"))
    none = rows.filter("n = 0").select(
        F.col("id").alias(id_col), F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("n_tokens"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in
          (("bucket", "int"), ("bucket_len", "long"), ("batch_id", "long"), ("slot", "int"))])
    return packed.unionByName(none)
