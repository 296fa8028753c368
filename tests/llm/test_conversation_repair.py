import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from skyfare.llm import oracle, queries
from skyfare.llm.audit_ranks import AT_END, KEPT, NEXT, OTHER, ROLE_CODES, audits, kinds
from skyfare.llm.conversation_repair import repair, repaired_digests, repaired_rows

WHITE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit) by a DP over whole audits; rows: (initial, gone, truncated)."""
    best = {"": (0, ""), "a": (0, ""), "s": (10**9, ""), "u": (10**9, "")}

    def with_inserts(c):
        for _ in range(4):
            for q in c:
                x = c["a" if q == "u" else "u"]
                c[q] = min(c[q], (x[0] + 2, "I" + x[1]))
        return c

    best = with_inserts(best)
    for ini, gone, cut in reversed(rows):
        now = {}
        for q in ("", "s", "u", "a"):
            need = "a" if q == "u" else "u"
            options = [(best[q][0] + 3, "D" + best[q][1])]
            if not gone:
                options.append((best[need][0] + 2 + cut, "R" + best[need][1]))
                if ini == need or (q == "" and ini == "s"):
                    options.append((best[ini][0] + cut, "K" + best[ini][1]))
            now[q] = min(options)
        best = with_inserts(now)
    return best[""]


def brute(rows):
    """Report and repaired rows of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]

    def digest(r, x):
        return hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()

    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))
    seen, faults = set(), []
    for _, r, x in rows:
        end = x.rstrip(WHITE)
        faults.append("blank" if not end else "duplicate" if (r, x) in seen else "" if end[-1] in ".!?" else "truncated")
        seen.add((r, x))
    ini = [r[:1] if r[:1] in ("s", "u", "a") else "?" for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = cheapest([(i, f in ("blank", "duplicate"), int(f == "truncated")) for i, f in zip(ini, faults)])
    out, at, state = [], 0, ""
    for letter in audit:
        need = "a" if state == "u" else "u"
        if letter == "I":
            out.append((NAMES[need], "", "insert"))
            state = need
            continue
        _, r, x = rows[at]
        at += 1
        if letter == "K":
            out.append((r, x, "keep"))
            state = r[0]
        elif letter == "R":
            out.append((NAMES[need], x, "rerole"))
            state = need
    report = (len(rows), max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
              faults.count("duplicate"), faults.count("truncated"),
              sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit)
    return report, out


def by_conversation(rows):
    groups = {}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, r, x))
    return {c: brute(g) for c, g in groups.items()}


def edge_conversations():
    rng = random.Random(7)
    texts = ["Hi.", "Why?", "no end", "", " \t\x0b", "Yes!\n ", "é. ", "ok", None, "\x1c", "中。", "a.\xa0", "Hi."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "s", "u", "a"]
    rows = []
    for c in range(60):
        for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 30])):
            rows.append((c, rng.choice([None, *range(12), 40]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}."))
    rows += [(None, 1, "user", "Null id."), (None, 2, "assistant", "Yes.")]
    rows += [(100, 1, "user", "Same.")] * 40 + [(101, i % 3, "user", "Same turn.") for i in range(7)]
    rows += [(102, i, ["user", "assistant"][i % 2], f"long talk {i}.") for i in range(300)]
    rows += [(103, i, "user", f"only users {i}") for i in range(50)] + [(104, 1, "assistant", "x " * 100_000 + ".")]
    rows += [(105, 3, "system", "Only a system row.")]
    return rows


@pytest.fixture(scope="module")
def edge_turns(spark):
    rows = [(*r, 1, "x", 2) for r in edge_conversations()]
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, block int, audit string, place int").repartition(5)


def test_ranks_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        convs = [[(rng.choice("sua?"), rng.random() < 0.15, int(rng.random() < 0.3)) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 21]))]
                 for _ in range(rng.randint(1, 6))]
        flat = [x for c in convs for x in c]
        sizes = np.array([len(c) for c in convs])
        kind = kinds(np.array([ROLE_CODES.get(x[0], OTHER) for x in flat], int), np.array([x[1] for x in flat], int),
                     np.array([x[2] for x in flat], int))
        cost, found, _ = audits(kind, sizes, np.tile(AT_END, (len(sizes), 1)), np.ones(len(sizes), bool), [0])
        assert [(c, a[0]) for c, a in zip(cost[:, 0].tolist(), found)] == [cheapest(c) for c in convs]


def test_states_are_a_deterministic_automaton():
    # a label leads from a state to one state only: what the single pointer of each length rests on
    assert KEPT.shape == (4, 4) and NEXT.tolist() == [2, 2, 3, 2]


@pytest.mark.parametrize("block_rows", [1 << 15, 7])
def test_edges_against_brute_force(spark, edge_turns, block_rows):
    want = by_conversation(edge_conversations())
    found = repair(edge_turns, block_rows=block_rows)
    got = {r.conv_id: (r.rows, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in found.report.collect()}
    assert got == {c: report for c, (report, _) in want.items()}
    rows = {}
    for r in repaired_rows(edge_turns, found).orderBy("conv_id", "place").collect():
        assert r.place == len(rows.setdefault(r.conv_id, []))
        rows[r.conv_id].append((r.role, r.text, r.edit))
    assert rows == {c: out for c, (_, out) in want.items() if out}
    digests = {r.conv_id: r.repaired_sha256 for r in repaired_digests(edge_turns, found).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x, _ in out).encode()).hexdigest()
                       for c, (_, out) in want.items()}


def damaged_by_rule(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if how == 0:
            continue
        x = "" if how == 1 else x.translate({ord(k): None for k in ".!?"}) if how == 2 else x
        out += [(c, t, "user" if how == 4 else r, x)] * (2 if how == 3 else 1)
    return out


def test_query_against_brute_force(spark, tmp_dir):
    rows = edge_conversations() + [(200, 3, "user", "x.")] * 2 + [(c, 1, "user", "One.") for c in range(300, 400)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    want = by_conversation(damaged_by_rule(rows))
    got = queries.op11_conversation_repair(spark, tmp_dir).collect()
    assert sorted({c for c, *_ in rows}, key=str) == sorted([r.conv_id for r in got], key=str)
    for r in got:
        report, out = want.get(r.conv_id, ((0,) * 7 + ("",), []))
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == report[1:]
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b, _ in out).encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = repair(none)
    assert found.report.count() == repaired_rows(none, found).count() == repaired_digests(none, found).count() == 0


def test_sql_against_brute_force():
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    seen, rows = set(), []
    for r in edge_conversations():  # several rows of one turn stand in another order in SQL
        if (r[0], r[1]) not in seen and (r[3] is None or len(r[3]) < 1000):
            seen.add((r[0], r[1]))
            rows.append(r)
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = by_conversation(damaged_by_rule(rows))
    for c, *numbers, sha in con.execute(f"select conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 from ({oracle.OP11})").fetchall():
        report, out = want.get(c, ((0,) * 7 + ("",), []))
        assert tuple(numbers) == report[1:]
        assert sha == hashlib.sha256("\n".join(f"{a}:{b}" for a, b, _ in out).encode()).hexdigest()
