"""Conversation structure repair: faults, cheapest edits, repaired rows.

``repair`` finds each conversation's faults and its cheapest edits (``audit_ranks``)
so that the role initials become ``(s?(ua)+)?``; ``repaired_rows`` applies them, and
``repaired_digests`` digests what they leave.

Rows stand in the order of their turns, nulls first; rows of one turn in the order
of role and then of the digest of role and text, so that equal rows are adjacent.
A null role or text counts as one space.  Of several faults of a row the first
counts: blank (no character but ``[\\x20\\x09-\\x0D]``), duplicate (role and text
occur earlier), truncated (the last such character is not ``.``, ``!`` or ``?``).
An empty role, or one of another initial than s, u, a, fits nowhere: its row is
given a role or deleted.  Null conversation ids are one conversation.  An empty
table gives empty results; extra columns are not read.

Long conversations.  No task holds a conversation of more than ``block_rows``
rows: its rows are numbered over the cluster, duplicates are found by the least
number of each (conversation, role, text), and the conversation is cut into
blocks.  A block's rows become one min-plus matrix; the matrices of a
conversation (one small row for each block) give the costs at each block's end,
with which each block is ranked by itself for all four states before it, and the
states behind each block say which of the four audits is taken.  Only
``repaired_digests`` reads a conversation as one stream, since a SHA-256 over
its rows can't be split; it holds one Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyfare.llm.audit_ranks import (AT_END, NEXT, OTHER, ROLE_CODES, audits, costs_to_end, entry_costs, kinds)
from skyfare.llm.common import joined_on, prepare
from skyfare.llm.ordering import with_places
from skyfare.session import write_once

WHITE = " \t\n\x0b\x0c\r"
#: Rows of a conversation that one task holds.
BLOCK_ROWS = 1 << 15
#: Rows that are repaired at once, about.
AT_ONCE = 1 << 15
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
ROLE_NAMES = {2: "user", 3: "assistant"}


@dataclass
class Repair:
    report: DataFrame  # conversation, rows, gaps, blank, duplicate, truncated, illegal, cost, audit
    plans: DataFrame   # conversation, block, audit of the block, and the order of the block's first row


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def _ordered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with what their order is made of: conv, turn, role, digest (of role and text), text."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        _text(F.col(role_col)).alias("role"), _text(F.col(text_col)).alias("text"))
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(both, 256)))


ORDER = ["turn", "role", "digest"]


def _groups(batches, keys: list[str], rows: int):
    """Tables of about ``rows`` rows that hold whole groups of equal ``keys``; the input is sorted by them."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.flatnonzero(_begins(table, keys))[-1]) if table.num_rows else 0
            if cut:
                yield table.slice(0, cut)
            rest = table.slice(cut)
            held, n = rest.to_batches(), rest.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _begins(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Whether each row begins a group; nulls are equal."""
    out = np.zeros(table.num_rows, bool)
    out[:1] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        a, b = column[1:], column[:-1]
        out[1:] |= np.asarray(pc.fill_null(pc.not_equal(a, b), False)) | np.asarray(pc.xor(a.is_null(), b.is_null()))
    return out


def _block(table: pa.Table) -> dict[str, np.ndarray]:
    """Per block of the table (conv, block): its row numbers and sums; per row: its kind."""
    begins = np.flatnonzero(_begins(table, ["conv", "block"]))
    sizes = np.diff(begins, append=table.num_rows)
    owner = np.repeat(np.arange(len(begins)), sizes)
    blank, closed = np.asarray(table.column("blank")), np.asarray(table.column("closed"))
    role = np.asarray(table.column("code")).astype(np.int64)
    known = table.column("again").combine_chunks()
    if known.null_count:  # the conversation is whole: of equal rows all but the first are duplicates
        code = np.asarray(table.column("digest").combine_chunks().dictionary_encode().indices).astype(np.int64)
        _, first = np.unique(owner * (code.max(initial=0) + 1) + code, return_index=True)
        again = np.ones(len(owner), bool)
        again[first] = False
    else:
        again = np.asarray(known)
    duplicate = ~blank & again
    truncated = ~blank & ~duplicate & ~closed

    pair = role[:-1] * 4 + role[1:]
    legal = (pair == 1) | (pair == 6) | (pair == 9)  # su, ua, au
    illegal = np.append(~legal & (owner[1:] == owner[:-1]), False)
    turn = table.column("turn").combine_chunks()
    there = np.asarray(turn.is_valid())
    number = np.asarray(turn.fill_null(0))
    fresh = there.copy()  # nulls come first, so the first number follows a null or begins the block
    fresh[1:] &= ~(there[:-1] & (number[1:] == number[:-1]) & (owner[1:] == owner[:-1]))

    def sums(x):
        return np.add.reduceat(x.astype(np.int64), begins) if len(begins) else np.zeros(0, np.int64)

    far = np.iinfo(np.int64).max
    low = np.minimum.reduceat(np.where(there, number, far), begins)
    high = np.maximum.reduceat(np.where(there, number, -far), begins)
    return {"begins": begins, "sizes": sizes, "kind": kinds(role, blank | duplicate, truncated), "blank": sums(blank),
            "duplicate": sums(duplicate), "truncated": sums(truncated), "illegal": sums(illegal), "turns": sums(fresh),
            "low": low, "high": high, "first": role[begins], "last": role[begins + sizes - 1]}


def _gaps(low: np.ndarray, high: np.ndarray, turns: np.ndarray) -> np.ndarray:
    return np.where(turns > 0, np.where(turns > 0, high - low, 0) + 1 - turns, 0)


WHOLE = ["rows", *COUNTS]


def _repair_whole(batches):
    """A report row and plan for each conversation that one task holds."""
    for table in _groups(batches, ["conv"], AT_ONCE):
        b = _block(table)
        m = len(b["sizes"])
        cost, found, _ = audits(b["kind"], b["sizes"], np.tile(AT_END, (m, 1)), np.ones(m, bool), [0])
        numbers = {"rows": b["sizes"], "gaps": _gaps(b["low"], b["high"], b["turns"]), "blank": b["blank"],
                   "duplicate": b["duplicate"], "truncated": b["truncated"], "illegal": b["illegal"], "cost": cost[:, 0]}
        head = table.take(pa.array(b["begins"]))
        yield pa.RecordBatch.from_arrays(
            [head.column(k).combine_chunks() for k in ("conv", "block", *ORDER)]
            + [pa.array(numbers[k].astype(np.int64)) for k in WHOLE] + [pa.array([x[0] for x in found], pa.string())],
            names=["conv", "block", *ORDER, *WHOLE, "audit"])


BLOCK_SUMS = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last"]


def _summarise(batches):
    """For each block of a long conversation its sums and its min-plus matrix."""
    for table in _groups(batches, ["conv", "block"], AT_ONCE):
        b = _block(table)
        matrix = costs_to_end(b["kind"], b["sizes"])[b["begins"]].reshape(-1, 16)
        head = table.take(pa.array(b["begins"]))
        yield pa.RecordBatch.from_arrays(
            [head.column(k).combine_chunks() for k in ("conv", "block", *ORDER)] + [pa.array(b["sizes"].astype(np.int64))]
            + [pa.array(b[k].astype(np.int64)) for k in BLOCK_SUMS] + [pa.array(matrix.tolist(), pa.list_(pa.int64()))],
            names=["conv", "block", *ORDER, "rows", *BLOCK_SUMS, "matrix"])


def _rank_blocks(batches):
    """For each block, given the costs behind it, the audits from its four states and the states behind it."""
    for table in _groups(batches, ["conv", "block"], AT_ONCE):
        b = _block(table)
        head = table.take(pa.array(b["begins"]))
        end = np.array(head.column("behind").to_pylist(), np.int64).reshape(-1, 4)
        _, found, to = audits(b["kind"], b["sizes"], end, np.asarray(head.column("last")), [0, 1, 2, 3])
        yield pa.RecordBatch.from_arrays(
            [head.column("conv").combine_chunks(), head.column("block").combine_chunks(),
             pa.array(found, pa.list_(pa.string())), pa.array(to.tolist(), pa.list_(pa.int64()))],
            names=["conv", "block", "audits", "exits"])


def _costs_behind(blocks: pd.DataFrame) -> pd.DataFrame:
    """One conversation's blocks, one row each: the costs behind each block, and the conversation's numbers."""
    blocks = blocks.sort_values("block", ignore_index=True)
    behind, cost = [], AT_END
    for matrix in blocks["matrix"][::-1]:
        behind.append(cost)
        cost = entry_costs(np.array(matrix, np.int64).reshape(1, 4, 4), cost[None])[0]
    first, last = blocks["first"].to_numpy(), blocks["last"].to_numpy()
    pair = last[:-1] * 4 + first[1:]
    seam = int((~np.isin(pair, (1, 6, 9))).sum())
    shared = int(((blocks["high"].to_numpy()[:-1] == blocks["low"].to_numpy()[1:])
                  & (blocks["turns"].to_numpy()[:-1] > 0) & (blocks["turns"].to_numpy()[1:] > 0)).sum())
    out = blocks[["conv", "block", *ORDER]].copy()
    out["behind"], out["last"] = [x.tolist() for x in behind[::-1]], out["block"] == out["block"].max()
    out["rows"], out["illegal"] = int(blocks["rows"].sum()), int(blocks["illegal"].sum()) + seam
    for k in ("blank", "duplicate", "truncated"):
        out[k] = int(blocks[k].sum())
    out["gaps"] = int(_gaps(blocks["low"].min(), blocks["high"].max(), blocks["turns"].sum() - shared))
    out["cost"] = int(cost[0])
    return out


def _entries(blocks: pd.DataFrame) -> pd.DataFrame:
    """One conversation's blocks, one row each: the state before each block."""
    blocks = blocks.sort_values("block", ignore_index=True)
    entry, state = [], 0
    for to in blocks["exits"]:
        entry.append(state)
        state = int(to[state])
    return blocks[["conv", "block"]].assign(entry=entry)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block_rows: int = BLOCK_ROWS) -> Repair:
    """Faults, costs and audits of all conversations of ``turns``; see ``Repair``."""
    prepare(turns)
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    code = F.lit(OTHER)
    for letter, number in ROLE_CODES.items():
        code = F.when(initial == letter, number).otherwise(code)
    light = write_once(_ordered(turns, conv_col, turn_col, role_col, text_col).select(
        "conv", *ORDER, code.cast("int").alias("code"), (F.octet_length(trimmed) == 0).alias("blank"),
        F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("closed")), "repair-rows")
    conv_kind = light.schema["conv"].dataType.simpleString()
    order_kind = "turn long, role string, digest binary"
    # of conversations of more than block_rows rows there are at most rows / block_rows
    long = write_once(light.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows)
                      .select("conv"), "repair-long")
    any_long = not long.isEmpty()
    short = joined_on(light, F.broadcast(long), ["conv"], "left_anti") if any_long else light
    columns = ["conv", "block", *ORDER, "code", "blank", "closed", "again"]
    short = short.withColumns({"block": F.lit(0).cast("long"), "again": F.lit(None).cast("boolean")}).select(columns)
    numbers = ", ".join(f"{k} long" for k in WHOLE)
    done = write_once(
        short.repartition("conv").sortWithinPartitions("conv", *ORDER)
        .mapInArrow(_repair_whole, f"conv {conv_kind}, block long, {order_kind}, {numbers}, audit string"), "repair-whole")
    report, plans = done.select("conv", *WHOLE, "audit"), done.select("conv", "block", *ORDER, "audit")
    if any_long:
        more = _repair_long(joined_on(light, F.broadcast(long), ["conv"], "left_semi"), block_rows, columns, conv_kind,
                            order_kind)
        report, plans = report.unionByName(more.report), plans.unionByName(more.plans)
    return Repair(report.withColumnRenamed("conv", conv_col), plans.withColumnRenamed("conv", conv_col))


def _repair_long(light: DataFrame, block_rows: int, columns: list[str], conv_kind: str, order_kind: str) -> Repair:
    """``repair`` for conversations that no task holds as a whole."""
    rows = write_once(light.withColumn("__row", F.monotonically_increasing_id()), "repair-long-rows")
    placed = with_places(rows, ["conv", *ORDER, "__row"], "repair-long-order").drop("__row")
    starts = F.broadcast(placed.groupBy("conv").agg(F.min("place").alias("start")))  # one row for each long conversation
    firsts = placed.groupBy("conv", "digest").agg(F.min("place").alias("place")).select("place")
    placed = placed.join(firsts.withColumn("is_first", F.lit(True)), "place", "left")
    placed = joined_on(placed, starts, ["conv"], "inner")
    blocks = write_once(
        placed.withColumns({"block": F.expr(f"(place - start) div {block_rows}"), "again": F.col("is_first").isNull()})
        .select(*columns, "place"), "repair-long-blocks")

    def in_blocks(df):
        return df.repartition("conv", "block").sortWithinPartitions("conv", "block", "place").drop("place")

    sums = ", ".join(f"{k} long" for k in BLOCK_SUMS)
    summed = in_blocks(blocks).mapInArrow(
        _summarise, f"conv {conv_kind}, block long, {order_kind}, rows long, {sums}, matrix array<long>")
    costs = write_once(summed.groupBy("conv").applyInPandas(
        _costs_behind, f"conv {conv_kind}, block long, {order_kind}, behind array<long>, last boolean, rows long, "
                       "illegal long, blank long, duplicate long, truncated long, gaps long, cost long"), "repair-costs")
    ready = joined_on(blocks, costs.select("conv", "block", "behind", "last"), ["conv", "block"], "inner")
    ranked = write_once(in_blocks(ready).mapInArrow(
        _rank_blocks, f"conv {conv_kind}, block long, audits array<string>, exits array<long>"), "repair-ranked")
    entries = ranked.drop("audits").groupBy("conv").applyInPandas(_entries, f"conv {conv_kind}, block long, entry int")
    taken = joined_on(ranked, entries, ["conv", "block"], "inner").select("conv", "block", F.get("audits", F.col("entry")).alias("audit"))
    plans = write_once(joined_on(costs.select("conv", "block", *ORDER), taken, ["conv", "block"], "inner"), "repair-plans")
    whole = plans.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("parts")).select(
        "conv", F.array_join("parts.audit", "").alias("audit"))
    report = joined_on(costs.filter("block = 0").select("conv", *WHOLE), whole, ["conv"], "inner")
    return Repair(report, plans)


class _Editor:
    """Applies one conversation's audit to its rows as they come."""

    def __init__(self):
        self.plans, self.audit, self.at, self.state, self.place = [], "", 0, 0, 0

    def _insert(self):
        self.state = int(NEXT[self.state])
        self.at += 1
        return ROLE_NAMES[self.state], b"", "insert"

    def inserts(self, end: bool):
        """Rows inserted before the next row, or (``end``) behind the last one."""
        while True:
            if self.at < len(self.audit):
                if self.audit[self.at] != "I":
                    return
                yield self._insert()
            elif self.plans:
                self.audit, self.at = self.plans.pop(0), 0
            elif end:
                return
            else:
                raise ValueError("an audit ends before its conversation")

    def row(self, role: str, text: bytes):
        """The row as it stays, or None."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return None
        if edit == "R":
            self.state = int(NEXT[self.state])
            return ROLE_NAMES[self.state], text, "rerole"
        self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
        return role, text, "keep"


def _streamed(turns: DataFrame, repaired: Repair, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows of whole conversations in their order, each block's audit before its first row."""
    rows = _ordered(turns, conv_col, turn_col, role_col, text_col).select(
        "conv", *ORDER, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), F.col("text").cast("binary").alias("text"))
    plans = repaired.plans.select(
        F.col(conv_col).alias("conv"), *ORDER, F.lit(0).alias("kind"), "block", F.col("audit").cast("binary").alias("text"))
    order = ["conv", *ORDER, "kind", "block"]
    return rows.unionByName(plans).repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "role", "kind", "text")


#: Bytes of text that are taken from Arrow at once.
PIECE_ROWS = 1 << 10


def _edited(batches):
    """(conversation, whether it begins, turn, repaired row or None when it ends) of a sorted stream."""
    editor, conv, here = None, None, False
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            part = batch.slice(at, PIECE_ROWS)
            for c, turn, role, kind, text in zip(*[part.column(k).to_pylist() for k in ("conv", "turn", "role", "kind", "text")],
                                                 strict=True):
                if not here or c != conv:
                    if here:
                        for row in editor.inserts(True):
                            yield conv, None, row
                        yield conv, None, None
                    editor, conv, here = _Editor(), c, True
                if kind == 0:
                    editor.plans.append(text.decode())
                    continue
                for row in editor.inserts(False):
                    yield conv, None, row
                row = editor.row(role, text)
                if row:
                    yield conv, turn, row
    if here:
        for row in editor.inserts(True):
            yield conv, None, row
        yield conv, None, None


def repaired_rows(turns: DataFrame, repaired: Repair, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conversation, place (from 0), turn (null if inserted), role, text, edit."""
    prepare(turns)
    stream = _streamed(turns, repaired, conv_col, turn_col, role_col, text_col)
    kind, batch_type = stream.schema["conv"].dataType.simpleString(), to_arrow_type(stream.schema["conv"].dataType)

    def task(batches):
        place, held, size = 0, [], 0
        for conv, turn, row in _edited(batches):
            if row is None:
                place = 0
                continue
            held.append((conv, place, turn, row[0], row[1], row[2]))
            place, size = place + 1, size + len(row[1])
            if size >= 4 << 20 or len(held) >= 1 << 14:
                yield _rows_batch(held, batch_type)
                held, size = [], 0
        if held:
            yield _rows_batch(held, batch_type)

    out = stream.mapInArrow(task, f"conv {kind}, place long, turn long, role string, text binary, edit string")
    return out.select(F.col("conv").alias(conv_col), "place", F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                      F.col("text").cast("string").alias(text_col), "edit")


def _rows_batch(rows: list[tuple], conv_type) -> pa.RecordBatch:
    kinds_ = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds_, strict=True)],
                                      names=["conv", "place", "turn", "role", "text", "edit"])


def repaired_digests(turns: DataFrame, repaired: Repair, conv_col: str = "conv_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conversation, repaired_sha256): SHA-256 of the repaired ``role:text``, joined by newlines."""
    prepare(turns)
    stream = _streamed(turns, repaired, conv_col, turn_col, role_col, text_col)
    conv_type = to_arrow_type(stream.schema["conv"].dataType)

    def task(batches):
        sha, empty, convs, digests = hashlib.sha256(), True, [], []
        for conv, _, row in _edited(batches):
            if row is not None:
                sha.update((b"" if empty else b"\n") + row[0].encode() + b":" + row[1])
                empty = False
                continue
            convs.append(conv)
            digests.append(sha.hexdigest())
            sha, empty = hashlib.sha256(), True
            if len(convs) >= 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(digests)], names=["conv", "sha"])
                convs, digests = [], []
        if convs:
            yield pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(digests)], names=["conv", "sha"])

    kind = stream.schema["conv"].dataType.simpleString()
    return stream.mapInArrow(task, f"conv {kind}, sha string").select(
        F.col("conv").alias(conv_col), F.col("sha").alias("repaired_sha256"))
