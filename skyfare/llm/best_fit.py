"""Best-fit packing with exact complements: few sequences, only long documents cut.

``cut_documents`` turns texts into pieces of at most ``capacity`` tokens, and
``pack_best_fit`` gives each piece a place in a sequence.  A piece's length is
all that counts, so the plan is made from the number of pieces of each length:
at most ``capacity`` numbers, whatever the size of the table.

The plan (``complements``) opens a sequence with the longest piece left and
looks for one, two or three pieces whose lengths sum to exactly the gap, by an
index from a sum to the pieces that make it, under the counts that are left.
Where there are none, the longest piece that fits goes in (the best fit) and the
gap that remains is tried again; a sequence ends with a gap only when nothing
left is short enough.  A combination is used as many times at once as the counts
allow, so the number of steps depends on the different lengths, not on pieces.
Plans with pairs only and with single complements only are made too; the one of
fewest sequences is taken (that of triples first), as few pieces can be unlucky.

Pieces then take their places: they are numbered by length over the cluster
(``with_places``, no task sees all pieces of a length), and a piece's number says
by a table of intervals which sequence and which offset it gets.

Texts of null count as empty, and each document has its end id, so an empty text
is a piece of one token.  Repeated rows are packed each; ids of any type, also
null, pass through; an empty table gives an empty result.  Which of several
pieces of one length goes where is decided by a hash of their rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import prepare, slices, valid_texts, worker_state
from skyfare.llm.ordering import with_places
from skyfare.llm.token_counts import shared_file
from skyfare.llm.word_ids import RaggedEncoder
from skyfare.session import write_once

ID_BYTES = 4
#: Bytes of text that are encoded at once: the more, the more words repeat.
ENCODE_BYTES = 8 << 20
#: Bytes of ids in an Arrow batch of pieces, about.
BATCH_BYTES = 32 << 20


class _Sums:
    """Witnesses of sums: one, two or three lengths at hand that make it.

    Counts only fall, so a sum that cannot be made any more never can again, and
    a witness is looked for anew only when its pieces have run out.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts  # shared with the caller, who takes pieces away
        self.pairs: dict[int, tuple[int, int] | None] = {}
        self.triples: dict[int, tuple[int, int, int] | None] = {}

    def _there(self, *lengths: int) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def pair(self, total: int) -> tuple[int, int] | None:
        """The two lengths of ``total`` with the longest one longest."""
        known = self.pairs.get(total, ())
        if known == () or (known and not self._there(*known)):
            known, low = None, np.arange(1, total // 2 + 1)
            high = total - low
            fits = (self.counts[low] > 0) & (self.counts[high] > (low == high))
            if fits.any():
                first = int(low[np.argmax(fits)])
                known = (total - first, first)
            self.pairs[total] = known
        return known

    def triple(self, total: int) -> tuple[int, int, int] | None:
        known = self.triples.get(total, ())
        if known == () or (known and not self._there(*known)):
            known = None
            for longest in np.flatnonzero(self.counts[:total - 1])[::-1].tolist():
                if 3 * longest < total:
                    break
                rest = self.pair(total - longest)
                if rest and rest[0] <= longest and self._there(longest, *rest):
                    known = (longest, *rest)
                    break
                if rest and longest in rest:  # that pair needs a piece too many of one length: any other pair
                    low = np.arange(1, (total - longest) // 2 + 1)
                    for x in low[(self.counts[low] > 0) & (self.counts[total - longest - low] > 0)].tolist():
                        if self._there(longest, total - longest - x, x):
                            known = (longest, total - longest - x, x)
                            break
                    if known:
                        break
            self.triples[total] = known
        return known

    def exact(self, gap: int, most: int) -> tuple[int, ...] | None:
        """One to ``most`` lengths that sum to ``gap``, the fewest."""
        if self.counts[gap]:
            return (gap,)
        return (self.pair(gap) if most > 1 else None) or (self.triple(gap) if most > 2 else None)


def complements(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """The plan of fewest sequences among those with combinations of up to 3, 2 and 1 pieces."""
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: np.ndarray, capacity: int, most: int) -> list[tuple[dict[int, int], int]]:
    """Sequences as (pieces of each length, times); ``counts[n]`` is the number of pieces of length n."""
    left = np.zeros(capacity + 1, np.int64)
    left[:len(counts)] = counts
    sums, plan = _Sums(left), []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            start, held, gap = left.copy(), [longest], capacity - longest
            left[longest] -= 1
            while gap:
                found = sums.exact(gap, most)
                if found is None:
                    shorter = np.flatnonzero(left[1:gap + 1])
                    if not len(shorter):
                        break
                    found = (int(shorter[-1]) + 1,)
                for x in found:
                    left[x] -= 1
                held += found
                gap -= sum(found)
            used = {x: held.count(x) for x in sorted(set(held), reverse=True)}
            times = min(int(start[x]) // k for x, k in used.items())
            for x, k in used.items():
                left[x] = start[x] - k * times
            plan.append((used, times))
    return plan


def intervals(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Runs of pieces numbered by ascending length: (first, sequence, each, offset) of each run.

    The pieces from ``first`` on fill sequences from ``sequence`` on, ``each``
    in every one, one after the other from ``offset``.
    """
    rows, sequence = [], 0
    for used, times in plan:
        offset = 0
        for length, k in used.items():
            rows.append((length, sequence, k, offset, k * times))
            offset += length * k
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    first = np.cumsum(table[:, 4]) - table[:, 4]
    return {"first": first, "sequence": table[:, 1], "each": table[:, 2], "offset": table[:, 3]}


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int | None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of whole texts: id, piece, start, length, ids (little-endian unsigned 32-bit integers).

    Only documents of more than ``capacity`` ids are cut; their last piece may be shorter.
    """
    content = shared_file(prepare(docs), tokenizer_path)
    last = np.array([] if end_id is None else [end_id], np.uint32)

    def task(batches):
        encoder = worker_state(("ragged", hash(content.value)), lambda: RaggedEncoder(content.value))
        for batch in slices(batches, limit=ENCODE_BYTES):
            ids, ends = encoder.ragged(valid_texts(batch.column("text")))
            if len(last):
                ids = np.insert(ids, ends, last[0])
                ends = ends + np.arange(1, len(ends) + 1)
            sizes = np.diff(ends, prepend=0)
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            at = (ends - sizes)[owner] + start
            step = max(1, BATCH_BYTES // (capacity * ID_BYTES))
            for i in range(0, len(owner), step):
                part = slice(i, i + step)
                low, high = at[i], (at[part] + length[part])[-1]
                offsets = np.append(at[part], high) - low
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(owner[part])), pa.array(piece[part], pa.int32()),
                     pa.array(start[part]), pa.array(length[part]),
                     pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [
                         None, pa.py_buffer((offsets * ID_BYTES).astype(np.int32)),
                         pa.py_buffer(ids[low:high].astype("<u4"))])],
                    names=["id", "piece", "start", "length", "ids"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(task, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def pack_best_fit(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset; lengths must be from 1 to ``capacity``, rows of null or 0 are not packed."""
    spark = prepare(pieces)
    rows = write_once(pieces.filter(F.col(length_col) != 0).withColumn("__row", F.monotonically_increasing_id()),
                      "best-fit-pieces")
    wrong = F.raise_error(F.format_string("a piece of length %s", F.col(length_col).cast("string"))).cast("long")
    length = F.when(F.col(length_col).between(1, capacity), F.col(length_col).cast("long")).otherwise(wrong)
    counts = np.zeros(capacity + 1, np.int64)  # one number for each length
    for found in rows.groupBy(length.alias("n")).agg(F.count(F.lit(1)).alias("c")).collect():
        counts[found["n"]] = found["c"]
    table = spark.sparkContext.broadcast(intervals(complements(counts, capacity)))
    placed = with_places(rows, [length_col, F.xxhash64("__row"), "__row"], "best-fit-order", place="__place").drop("__row")

    def task(batches):
        runs = table.value
        for batch in batches:
            place = batch.column("__place").to_numpy()
            run = np.searchsorted(runs["first"], place, side="right") - 1
            nth, each = place - runs["first"][run], runs["each"][run]
            offset = runs["offset"][run] + nth % each * batch.column(length_col).to_numpy().astype(np.int64)
            keep = [i for i, n in enumerate(batch.schema.names) if n != "__place"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(runs["sequence"][run] + nth // each), pa.array(offset)],
                names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])

    columns = [c for c in placed.columns if c != "__place"]
    kinds = ", ".join(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in columns)
    return placed.select(*columns, "__place").mapInArrow(task, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """One row for each sequence: sequence_id, pieces, ids of its pieces one after the other."""
    run = F.sort_array(F.collect_list(F.struct("offset", F.col(ids_col).alias("ids"))))
    joined = F.aggregate(F.col("run.ids"), F.lit(b""), lambda got, x: F.concat(got, x))
    return (packed.groupBy("sequence_id").agg(run.alias("run"))
            .select("sequence_id", F.size("run").alias("pieces"), joined.alias("ids")))
