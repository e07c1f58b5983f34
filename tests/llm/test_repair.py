"""Structure repair against a plain dynamic program over single rows, with blocks of a few rows."""

from __future__ import annotations

import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import queries, repair

BLANKS = " \t\n\x0b\x0c\r"
STATES = {"": 0, "s": 1, "u": 2, "a": 3}
TURN = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}


def plain(rows):
    """Best ``(cost, audit)`` and the repaired lines, and the counts, row by row."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, marks = set(), []
    for _, role, text in rows:
        cut = text.strip(BLANKS)
        marks.append("blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(best):
        for _ in range(4):
            for p, (c, a, lines) in list(best.items()):
                role, q = TURN[p]
                new = (c + 2, a + "I", lines + [("user" if role == "u" else "assistant") + ":"])
                if q not in best or new[:2] < best[q][:2]:
                    best[q] = new
        return best

    best = inserted({0: (0, "", [])})
    for (_, role, text), mark in zip(rows, marks):
        after: dict = {}

        def offer(q, new):
            if q not in after or new[:2] < after[q][:2]:
                after[q] = new

        for p, (c, a, lines) in best.items():
            offer(p, (c + 3, a + "D", lines))
            if mark not in ("blank", "duplicate"):
                more = mark == "truncated"
                kind, q = TURN[p]
                offer(q, (c + 2 + more, a + "R", lines + [("user" if kind == "u" else "assistant") + ":" + text]))
                kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], p))
                if kept:
                    offer(kept, (c + more, a + "K", lines + [role + ":" + text]))
        best = inserted(after)
    cost, audit, lines = min(best[q] for q in (0, 3) if q in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def worked(turns, block_bits):
    placed = repair.place(turns)
    marked = repair.faults(placed).persist()
    found = repair.scripts(marked, block_bits).persist()
    audits: dict = {}
    for r in sorted(found.select("conv", "at", repair.audit(F.col("script")).alias("a")).collect(), key=lambda r: r["at"]):
        audits[r["conv"]] = audits.get(r["conv"], "") + r["a"]
    sums = {r["conv"]: r["sha256"] for r in repair.digests(repair.repaired(placed, found)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    out = {}
    for r in repair.report(marked, found).collect():
        out[r["conv"]] = (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), audits[r["conv"]], sums.get(r["conv"], empty))
    return out, found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = ["Fine.", "Yes!", "cut off", "", " \n", "Why? ", "é🚀.", None, "x" * 80 + "a.", "x" * 80 + "b."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "unicorn"]
    out = []
    for conv in [*range(60), None]:
        wide = conv is not None and conv % 10 == 0
        for t in range(rng.randint(0, 90 if wide else 9)):
            turn = rng.choice([t, t, t, t + 5, None])
            role = "user" if wide and t < 40 else rng.choice(roles[: rng.choice([3, 5, 10])])
            text = "Fine." + str(t) + "." if wide and t < 40 else rng.choice(texts)
            out += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return out


@pytest.mark.parametrize("block_bits", [1, 3, 16])
def test_repair_equals_plain_program(spark, rows, block_bits):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found, segments = worked(turns, block_bits)
    expected = {}
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        expected[conv] = plain([r[1:] for r in group])
    assert found == expected
    assert segments.count() > len(expected) or block_bits == 16


def test_runs_equal_single_rows():
    program, rng = repair.Program(), random.Random(5)
    for _ in range(300):
        symbols = [s for s in (rng.randrange(9) for _ in range(rng.randint(1, 6))) for _ in range(rng.choice([1, 2, 7, 33]))]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        assert program.script(runs, 0, program.final, True) == program.script([(s, 1) for s in symbols], 0, program.final, True)
        after = program.final
        for symbol in reversed(symbols):
            after = program.before(symbol, 1, after)
        assert program.script(runs, 0, program.final, True)[2] == after[0]


def test_long_run_needs_few_products(monkeypatch):
    calls = []
    least = repair._least
    monkeypatch.setattr(repair, "_least", lambda rows, vector: calls.append(1) or least(rows, vector))
    program = repair.Program()
    calls.clear()
    program.before(3, 10**9, program.final)
    assert len(calls) < 31 * 6


def test_repaired_turns_follow_the_pattern(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    placed = repair.place(turns)
    found = repair.scripts(repair.faults(placed), 2)
    lines: dict = {}
    for r in sorted(repair.repaired(placed, found).collect(), key=lambda r: r["pos"]):
        lines.setdefault(r["conv"], []).extend(t["role"][:1] for t in r["turns"])
    for said in lines.values():
        said = "".join(said)
        body = said[1:] if said.startswith("s") else said
        assert body == "ua" * (len(body) // 2) and (not said or body)


def test_repair_edge_tables(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, conv string, pos int, at int, script string, fault int, _tie int"
    odd = [(None, None, None, None), (None, None, None, None), (1, 3, "user", "a."), (1, 3, "user", "a."), (2, None, "system", "b")]
    odd.append((3, 0, "assistant", "word " * 200_000 + "."))
    odd += [(4, 0, "user", "x."), (9, 1, "", "")]
    for name, rows in (("odd", odd), ("none", [])):
        table = spark.createDataFrame([(*r, "c", 1, 2, "s", 3, 4) for r in rows], schema)
        folder = tmp_path / name
        table.write.parquet(f"{folder}/conversations.parquet")
        mine = {r["conv_id"]: tuple(r) for r in queries.op12_structure_repair(spark, str(folder)).collect()}
        con = duckdb.connect()
        con.execute(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
        theirs = {r[0]: tuple(r) for r in con.execute(queries.ORACLE["op12_structure_repair"]).fetchall()}
        assert mine == theirs and set(mine) == {r[0] for r in rows}
