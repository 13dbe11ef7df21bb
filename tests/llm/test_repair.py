"""Conversation repair against a search over all edit sequences, and its streams against whole conversations."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from parley.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, part int, cost string, present string"
BLANK = "\t\n\x0b\x0c\r "


def cheapest(rows):
    """(cost, audit, repaired rows) of (role, text, must go, truncated) rows, by a search for the least (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, kept
        if (i, state) in seen:
            continue
        seen.add((i, state))
        wanted = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, wanted[0], (*kept, (wanted, ""))))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, kept))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, wanted[0], (*kept, (wanted, text))))
                if role[:1] == wanted[0] or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role[0], (*kept, (role, text))))


def brute(rows):
    """The result of each conversation of damaged (conv_id, turn, role, text, present) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv and r[4]]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in mine} - {None}
        counts, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, _, role, text, _ in mine:
            end = text.rstrip(BLANK)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, kept = cheapest(marked)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, sha)
    return out


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def odd_rows():
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "no", "", " \t", None, "Why?", f"x{rng.random()}.", "ünï! \x0b"])
            rows.append((conv if conv else None, rng.choice([turn, turn, 2 * turn, None]), role, text, 1, "y", "z"))
    return rows + rows[:5] + [(500, i // 2, ("user", "assistant")[i % 3 == 1], f"t{i % 90}.", 1, "y", "z") for i in range(400)]


@pytest.mark.parametrize("part_rows", [repair.PART_ROWS, 3])
def test_repair_against_a_search(spark, part_rows):
    rows = odd_rows()
    got = results(repair.repaired(spark.createDataFrame(rows, SCHEMA).repartition(3), part_rows=part_rows))
    assert got == brute([(c, t, " " if r is None else r, " " if x is None else x, True) for c, t, r, x, *_ in rows])


def test_every_symbol_run(spark):
    rng = random.Random(1)
    for _ in range(3000):
        word = "".join(rng.choice("xsuaoSUAO") * rng.choice([1, 1, 1, 2, 7]) for _ in range(rng.randint(0, 6)))
        done = repair.Output(False)
        done.add(word, [c.lower() for c in word], [""] * len(word), repair.END)
        done.close()
        rows = [(c.lower(), "", c == "x", c.isupper()) for c in word]
        assert (done.cost, "".join(done.audit)) == cheapest(rows)[:2]
        assert repair.apply(repair.matrix_of(word), repair.END)[0] == done.cost


def test_long_run_of_one_symbol():
    done = repair.Output(False)
    done.add("u" * 100_001, ["user"] * 100_001, ["a."] * 100_001, repair.END)
    done.close()
    # a reroled turn costs as much as an inserted one, and both settle two turns at once
    assert done.cost == 2 * 50_001 and len(done.audit) >= 100_001


@pytest.mark.parametrize("part_rows", [repair.PART_ROWS, 4])
def test_edited_turns_give_the_digest(spark, part_rows):
    table = spark.createDataFrame(odd_rows(), SCHEMA)
    want = results(repair.repaired(table))
    edits = {}
    for r in repair.repaired_turns(table, part_rows=part_rows).collect():
        edits.setdefault(r.conv_id, []).append((r.step, r.edit, r.role, r.text))
    for conv, steps in edits.items():
        steps.sort()
        assert [s[0] for s in steps] == list(range(len(steps))) and "".join(s[1] for s in steps) == want[conv][-2]
        kept = "\n".join(f"{s[2]}:{s[3]}" for s in steps if s[1] != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == want[conv][-1]
    assert set(edits) == {c for c in want if want[c][-2]}


def test_no_rows(spark):
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.repaired_turns(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = results(repair.repaired(spark.createDataFrame([(7, 1, "user", "a", 1, "y", "z")], SCHEMA), F.lit(False)))
    assert gone == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_against_brute_force(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind == 1 else r.text.translate({ord(c): None for c in ".!?"}) if kind == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if kind == 4 else r.role, text, kind != 0)] * (2 if kind == 3 else 1)
    assert results(queries.op13_repair(spark, sf)) == brute(rows)
