"""Conversation repair against a search over all edit lists."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakeload.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLES = {2: "user", 3: "assistant"}


def cheapest(codes):
    """(cost, least audit) by a search in order of (cost, audit)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(codes) and state in (0, 3):
            return cost, audit
        heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state]))
        if i < len(codes):
            code = codes[i]
            extra = code.isupper()
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if code != "x":
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, NEXT[state]))
                after = KEEPS.get(code.lower(), {}).get(state)
                if after is not None:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, after))


def expected(rows):
    """The contract's result for planted damage, by plain loops."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        sp = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, codes, kept, count = set(), "", [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for turn, role, text in own:
            word = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not word else "duplicate" if (role, text) in seen else "truncated" if word[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                count[fault] += 1
            if fault in ("blank", "duplicate"):
                codes += "x"
            else:
                letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
                codes += letter.upper() if fault else letter
        cost, audit = cheapest(codes)
        state, i = 0, 0
        for edit in audit:
            if edit == "I":
                state = NEXT[state]
                kept.append(ROLES[state] + ":")
                continue
            turn, role, text = own[i]
            if edit == "K":
                state = KEEPS[codes[i].lower()][state]
                kept.append(f"{role}:{text}")
            elif edit == "R":
                state = NEXT[state]
                kept.append(f"{ROLES[state]}:{text}")
            i += 1
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], pairs, cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def got(frame):
    rows = C.repair(C.damage(frame), outputs=("repaired_sha256",)).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def conversations(seed, n, long=0):
    rnd, rows = random.Random(seed), []
    texts = ["Yes.", "no", "Why? ", "", " \t\n", "a b.\n", "Hello!", "é。", None, "x" * 300 + "."]
    for conv in [*range(n), None]:
        for turn in rnd.sample(range(14), rnd.randint(1, 9)):
            rows.append((conv, turn if rnd.random() < 0.98 or conv is None else None, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rnd.choice(texts) if rnd.random() < 0.6 else f"{rnd.random()}."))
    # two rows of one turn have no order in the contract: keep one
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    return rows + [(-1, t, "user" if t % 2 else "assistant", f"m{t % 97 if t % 5 else t}" + "." * (t % 3 > 0)) for t in range(long)]


def test_against_a_search_over_all_edits(spark):
    rows = conversations(3, 120)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_long_conversations_are_joined_from_pieces(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rows = conversations(4, 25, long=600)
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_repeated_rows_null_turns_and_clashing_columns(spark):
    rows = [(1, None, "user", "a.")] * 3000 + [(1, 5, "user", "a.")] + [(2, 3, "user", " ")] * 40
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"copies": F.lit(7), "h1": F.lit(1), "n": F.lit("x")})
    result = C.repair(rows_of(frame), outputs=("messages",)).collect()
    by = {r["conv_id"]: r for r in result}
    assert by[1]["duplicate"] == 3000 and by[1]["audit"] == "K" + "D" * 3000 + "I" and by[1]["cost"] == 3 * 3000 + 2
    assert [(m["role"], m["text"]) for m in by[1]["messages"]] == [("user", "a."), ("assistant", "")]
    assert by[2]["blank"] == 40 and by[2]["audit"] == "D" * 40 and by[2]["messages"] == []


def rows_of(frame):
    return frame.withColumn("copies", F.lit(1))


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(C, "MOD", 3)
    rnd = random.Random(5)
    for _ in range(300):
        codes = "".join(rnd.choice("suaSUAoOxu") for _ in range(rnd.randint(0, 12)))
        assert C.whole(codes) == cheapest(codes)
