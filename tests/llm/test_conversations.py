"""Conversation repair against a plain shortest path over whole conversations."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from firnline.llm import conversations, queries

TURNS = {"": "u", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def fault(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit) by Dijkstra over (rows used, last role)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, n, last, kept = heapq.heappop(heap)
        if n == len(rows) and last in ("", "a"):
            return cost, audit, kept
        if (n, last) in done:
            continue
        done.add((n, last))
        word = {"u": "user", "a": "assistant"}[TURNS[last]]
        heapq.heappush(heap, (cost + 2, audit + "I", n, TURNS[last], (*kept, (word, ""))))
        if n == len(rows):
            continue
        role, text = rows[n][2:]
        heapq.heappush(heap, (cost + 3, audit + "D", n + 1, last, kept))
        if faults[n] not in ("blank", "duplicate"):
            more = faults[n] == "truncated"
            heapq.heappush(heap, (cost + 2 + more, audit + "R", n + 1, TURNS[last], (*kept, (word, text))))
            initial = role[:1]
            if initial and (initial == TURNS[last] or (initial == "s" and last == "")):
                heapq.heappush(heap, (cost + more, audit + "K", n + 1, initial, (*kept, (role, text))))
    raise AssertionError


def plain(rows, harmed=True):
    by = defaultdict(list)
    for r in damage(rows) if harmed else rows:
        by[r[0]].append(r)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = fault(mine)
        cost, audit, kept = cheapest(mine, faults)
        turns = [r[1] for r in mine if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def query_of(spark, tmp_path, rows, partitions=3):
    spark.createDataFrame(rows, SCHEMA).repartition(partitions).write.parquet(str(tmp_path / "conversations.parquet"))
    return sorted(map(tuple, queries.op11_conversations(spark, str(tmp_path)).collect()), key=str)


def random_rows(seed, n, turns=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Umbrella", "u"]
    texts = ["Hi.", "Yes!", "no end", "", " \n", "What? ", "Hi.", None, "e.\x0b", "x "]
    return [(rng.randrange(n) if rng.random() < 0.98 else None, rng.randrange(turns) if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts)) for _ in range(6 * n)]


def test_random_conversations(spark, tmp_path):
    rows = random_rows(1, 120)
    assert query_of(spark, tmp_path, rows) == plain(rows)


def test_long_runs_and_pieces(spark, tmp_path, monkeypatch):
    """One conversation over many ranges, runs of one symbol, equal rows in masses."""
    rng = random.Random(4)
    rows = [(1, n, "user", f"text {n}.") for n in range(700)] + [(1, 700 + n, "assistant", f"text {n}") for n in range(350)]
    rows += [(2, 5, "user", "same.")] * 400 + [(2, n, rng.choice(["user", "assistant", "system"]), f"t{n}.") for n in range(300)]
    rows += [(3, 0, "system", "s.")] + [(3, n, "system", f"{n}!") for n in range(1, 90)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert query_of(spark, tmp_path, rows) == plain(rows)
        repair = conversations.Repair(conversations.damaged(spark.createDataFrame(rows, SCHEMA)))
        assert repair.pieces.where("_conv = 1").count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op11_conversations(spark, "/root/testdata/sf0.01").collect()), key=str) == plain(rows)


def test_repaired_rows(spark):
    rows = [r for r in random_rows(7, 30) if r[0] is not None]
    given = spark.createDataFrame(rows, SCHEMA)
    got = defaultdict(list)
    for r in sorted(conversations.Repair(given).repaired().collect(), key=lambda r: (r.conv_id, r.piece, r.place)):
        got[r.conv_id].append(f"{r.role}:{r.text}")
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = {w[0]: w[-1] for w in plain(clean, harmed=False)}
    assert {c: hashlib.sha256("\n".join(got[c]).encode()).hexdigest() for c in want} == want


def test_powers_are_products():
    for symbol in range(12):
        one, many = conversations.power(symbol, 0), conversations.power(symbol, 0)
        for _ in range(7):
            many = conversations._least(many, one)
        assert (conversations.power(symbol, 3) == many).all()


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (1, None, None, None), (2, 3, "user", "é" * 300_000 + ".")]])
def test_few_rows(spark, tmp_path, rows):
    assert query_of(spark, tmp_path, rows, 1) == plain(rows)


def test_a_conversation_without_rows(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = query_of(spark, tmp_path, [(conv, 0, "user", "Gone.")])
    assert got == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
