"""Cheapest repairs of many conversations at once: cost DP, then prefix-doubling path ranking.

A conversation's rows are consumed from left to right in one of four states: 0
nothing yet, 1 after the system row, 2 after a user's, 3 after an assistant's.
A node is (position, state).  Its arcs are the edits: D deletes the next row, I
inserts the role that must follow, K keeps the next row, R gives it that role.

1. Costs.  Each row is one of a few 4 x 4 min-plus matrices (what it costs to
   come from one state before it to another behind it, inserts included).  The
   products of all rows from each position to the end of its block come from
   doubling: after round k a position's product covers 2^k rows.
2. Optimal arcs are those whose cost and target's cost add up to the node's.
3. Ranks.  Nodes are ranked by their least audit of length 1, 2, 4, ...: the rank
   at twice the length is that of (own rank, rank of the node that the pointer of
   this length leads to), and pointers are doubled by following them twice.  At
   the full length the rank of an arc is (label, rank of its target), and each
   node takes its least optimal arc.  A node and a label fix the target, so the
   pointer of each length is unique and no other path of equal label is lost.
4. Audits.  The node after t steps from a start is reached by the doubled
   pointers of the bits of t; its arc's label is the t-th letter.

All steps are numpy operations over all nodes of a block of rows at once.
"""

from __future__ import annotations

import numpy as np

#: Codes of a row's role by its initial; any other role fits nowhere.
ROLE_CODES = {"s": 0, "u": 1, "a": 2}
OTHER = 3
LABELS = np.frombuffer(b"DIKR", np.uint8)  # in ASCII order
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 40
#: The state after an inserted or reroled row.
NEXT = np.array([2, 2, 3, 2])
#: The state after keeping a row of each role code, -1 where it may not stand.
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: Costs left at the end of a conversation: nothing, s, u (an assistant lacks), a.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of the matrices of ``a`` and ``b``."""
    return (a[:, :, :, None] + b[:, None, :, :]).min(axis=2)


def _row_matrices() -> np.ndarray:
    """Matrices by kind of row: (role code * 2 + must go) * 2 + truncated."""
    insert = np.full((4, 4), FAR)
    for state in range(4):
        cost, at = 0, state
        for _ in range(3):
            insert[state, at] = min(insert[state, at], cost)
            cost, at = cost + INSERT, int(NEXT[at])
    out = np.full((16, 4, 4), FAR)
    for kind in range(16):
        role, gone, cut = kind >> 2, kind >> 1 & 1, kind & 1
        for state in range(4):
            out[kind, state, state] = DELETE
            if not gone:
                ways = [(int(NEXT[state]), REROLE + cut * TRUNCATED)]
                if KEPT[state, role] >= 0:
                    ways.append((int(KEPT[state, role]), KEEP + cut * TRUNCATED))
                for to, cost in ways:
                    out[kind, state, to] = min(out[kind, state, to], cost)
    return np.minimum(_product(np.broadcast_to(insert, (16, 4, 4)), out), FAR)


ROWS = _row_matrices()


def kinds(role: np.ndarray, gone: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return (role.astype(np.int64) * 2 + gone) * 2 + cut


def costs_to_end(kind: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each row the min-plus product of its row and all behind it in its block; ``sizes``: rows of each block."""
    out = ROWS[kind]
    ahead = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(kind))  # rows to the end, its own included
    reach = 1
    while True:
        rows = np.flatnonzero(ahead > reach)
        if not len(rows):
            return out
        out[rows] = np.minimum(_product(out[rows], out[rows + reach]), FAR)
        reach *= 2


def entry_costs(product: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs at the states before products, given the costs ``end`` at the states behind them."""
    return np.minimum((product + end[:, None, :]).min(axis=2), FAR)


def audits(kind: np.ndarray, sizes: np.ndarray, end: np.ndarray, last: np.ndarray,
           starts: list[int]) -> tuple[np.ndarray, list[list[str]], np.ndarray]:
    """(costs at the starts, audits, states behind the block) for each block and start state.

    ``end``: the costs at the four states behind each block.  Where ``last`` is
    true the block ends its conversation, so that states from which an audit must
    go on (inserts at the end) do; else each state behind the block ends it.
    """
    n, blocks = len(kind), len(sizes)
    behind = np.cumsum(sizes + 1) - 1                      # position behind each block
    at = np.arange(n) + np.repeat(np.arange(blocks), sizes)  # position before each row
    worth = np.zeros((n + blocks, 4), np.int64)
    worth[behind] = end
    worth[at] = entry_costs(costs_to_end(kind, sizes), np.repeat(end, sizes, axis=0))

    # arcs of all nodes: label, target, whether optimal
    states = np.arange(4)
    role, gone, cut = kind >> 2, (kind >> 1 & 1).astype(bool)[:, None], (kind & 1)[:, None]
    target = np.zeros((n + blocks, 4, 4), np.int64)
    good = np.zeros((n + blocks, 4, 4), bool)
    after, here = worth[at + 1], worth[at]
    target[at, :, 0], good[at, :, 0] = 4 * (at + 1)[:, None] + states, after + DELETE == here
    kept = KEPT[:, role].T
    onto = np.take_along_axis(after, np.maximum(kept, 0), axis=1)
    target[at, :, 2] = 4 * (at + 1)[:, None] + np.maximum(kept, 0)
    good[at, :, 2] = ~gone & (kept >= 0) & (onto + KEEP + cut * TRUNCATED == here)
    target[at, :, 3] = 4 * (at + 1)[:, None] + NEXT
    good[at, :, 3] = ~gone & (after[:, NEXT] + REROLE + cut * TRUNCATED == here)
    target[:, :, 1] = 4 * np.arange(n + blocks)[:, None] + NEXT
    good[:, :, 1] = worth[:, NEXT] + INSERT == worth
    good[behind[~last], :, :] = False
    target, good = target.reshape(-1, 4), good.reshape(-1, 4)

    # ranks of the least audits of 1, 2, 4, ... letters; nodes without an arc end theirs
    goes = good.any(axis=1)
    label = np.where(goes, good.argmax(axis=1), 0)
    pointer = np.where(goes, np.take_along_axis(target, label[:, None], axis=1)[:, 0], np.arange(len(goes)))
    rank, length = np.where(goes, label + 1, 0), goes.astype(np.int64)
    doubled = [pointer]
    while goes[pointer].any():
        _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
        length = length + length[pointer]
        pointer = pointer[pointer]
        doubled.append(pointer)
    arc = np.where(good, np.arange(4) * (rank.max() + 1) + rank[target], FAR).argmin(axis=1)
    assert (~goes | (arc == label)).all(), "a node and a label must fix the target"

    begins = (4 * (behind - sizes)[:, None] + np.array(starts)).ravel()
    steps = length[begins]
    nth = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    node = np.repeat(begins, steps)
    for k, jump in enumerate(doubled):
        node = np.where(nth >> k & 1, jump[node], node)
    text = LABELS[arc[node]].tobytes().decode()
    stops = np.cumsum(steps).tolist()
    found = [text[a:b] for a, b in zip([0, *stops], stops)]
    m = len(starts)
    return (worth.reshape(-1)[begins].reshape(blocks, m), [found[i * m:(i + 1) * m] for i in range(blocks)],
            (pointer[begins] % 4).reshape(blocks, m))
