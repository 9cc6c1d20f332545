"""Conversation repair against an exhaustive search and a plain rendering of its rules."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

from hearthline.llm import queries, structure_repair

SMALL = Path("/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, cost int, audit string, copies int"
BLANK = " \t\n\x0b\x0c\r"
ONWARD = {"": "u", "s": "u", "u": "a", "a": "u"}


def slow_repair(turns):
    """Cost, audit, and the repaired turns, of (role, text, fault) by trying cheapest and least audits first."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if at == len(turns) and last in ("", "a"):
            return cost, audit, out
        if (at, last) in seen:
            continue
        seen.add((at, last))
        new = ONWARD[last]
        name = {"u": "user", "a": "assistant"}[new]
        heapq.heappush(heap, (cost + 2, audit + "I", at, new, (*out, f"{name}:")))
        if at == len(turns):
            continue
        role, text, fault = turns[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, new, (*out, f"{name}:{text}")))
            if role[:1] == new or role[:1] == "s" and not last:
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))


def slow(rows, damage=True):
    conversations, given = defaultdict(list), set()
    for conv, turn, role, text in rows:
        given.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20 if damage else 9
        if how == 0:
            continue
        if how == 1:
            text = ""
        if how == 2:
            text = "".join(c for c in text if c not in ".!?")
        if how == 4:
            role = "user"
        conversations[conv] += [(turn, role, text)] * (2 if how == 3 else 1)
    out = {}
    for conv in given:
        rows = sorted(conversations[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        numbers = {t for t, _, _ in rows if t is not None}
        said, turns = set(), []
        for _, role, text in rows:
            body = text.rstrip(BLANK)
            fault = "blank" if not body else "duplicate" if (role, text) in said else "truncated" if body[-1] not in ".!?" else ""
            said.add((role, text))
            turns.append((role, text, fault))
        cost, audit, final = slow_repair(turns)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(sum(f == kind for _, _, f in turns) for kind in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
            cost, audit, hashlib.sha256("\n".join(final).encode()).hexdigest(),
        )
    return out


def got_of(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def made(seed, conversations, longest):
    chosen = random.Random(seed)
    says = ["Yes.", "No!", "well", " ", "Good day. ", "Why?\n", "Yes.", ""]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "aide"]
    return [
        (conv, chosen.choice([k, k, k, k // 2, None]), chosen.choice(roles), chosen.choice([*says, f"{k}.", f"{k}", None]))
        for conv in [*range(conversations), None]
        for k in range(chosen.randint(1, longest))
    ]


def test_search_finds_the_least_repair():
    chosen = random.Random(5)
    for n in range(12):
        for _ in range(60):
            codes = "".join(chosen.choice("suaoxSUAO") for _ in range(n))
            fault = {c: "blank" if c == "x" else "truncated" if c.isupper() else "" for c in codes}
            want = slow_repair([({"s": "s", "u": "u", "a": "a"}.get(c.lower(), "o"), "t", fault[c]) for c in codes])[:2]
            assert structure_repair.cheapest(codes) == want
            for cut in (0, n // 3, n):
                tables = [structure_repair.segment_table(part) for part in (codes[:cut], codes[cut:])]
                assert structure_repair.ended(structure_repair.chained(*tables)) == want


@pytest.mark.parametrize("segment", [3, 128])
def test_equals_plain_rules(spark, monkeypatch, segment):
    monkeypatch.setattr(structure_repair, "SEGMENT", segment)
    rows = made(1, 120, 9)
    assert got_of(structure_repair.structure_repair(frame(spark, rows))) == slow(rows)


def test_one_conversation_over_many_tasks(spark):
    chosen = random.Random(2)
    rows = [(7, k, chosen.choice(["user", "assistant"]), f"{k}.") for k in range(1500)] + made(3, 5, 6)
    rows += [(7, 600, "user", "again.")] * 400 + [(7, 900, "user", "again.")] * 3
    spread = frame(spark, rows).repartition(8)
    assert got_of(structure_repair.structure_repair(spread)) == slow(rows)


def test_odd_conversations(spark):
    nothing = hashlib.sha256(b"").hexdigest()
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone."), (-5, None, None, None), (-5, None, "assistant", "x" * 200_000), (None, 3, "user", "Hm.")]
    got = got_of(structure_repair.structure_repair(frame(spark, rows)))
    assert got == slow(rows) and got[dropped] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert structure_repair.structure_repair(frame(spark, [])).collect() == []


@pytest.mark.skipif(not SMALL.exists(), reason="no given tables")
def test_query_equals_plain_rules(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got_of(queries.op12_structure_repair(spark, str(SMALL))) == slow(rows)
