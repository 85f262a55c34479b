"""Structure repair against an exhaustive search over the grammar's states, and a plain reading of the tables."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from lakeshift.llm import turn_repair as t

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
NAMES = ["conv_id", *COUNTS, "audit", "repaired_sha256"]


def search(letters):
    """Cheapest (cost, audit) by uniform-cost search over (turn, grammar state); the queue's order breaks ties by audit."""
    n = len(letters)
    queue, done = [(0, "", 0, "start")], set()
    while queue:
        cost, audit, i, state = heapq.heappop(queue)
        if i == n and state in ("start", "u"):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        if i < n:
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state))
            if letters[i] not in t.BLANKS + t.DUPLICATES:
                extra, own = letters[i].isupper(), letters[i].lower()
                if state == "start" and own == "s":
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, "s"))
                awaited, then = ("a", "u") if state == "a" else ("u", "a")
                heapq.heappush(queue, (cost + extra + (0 if own == awaited else 2), audit + ("K" if own == awaited else "R"), i + 1, then))
        heapq.heappush(queue, (cost + 2, audit + "I", i, "u" if state == "a" else "a"))
    raise AssertionError


def test_search_is_exhaustive_for_short_ones():
    """The search against all audits up to a length, so that the model itself is checked."""
    from itertools import product

    rng = random.Random(1)
    for _ in range(60):
        letters = "".join(rng.choice("suaxSUAX04") for _ in range(rng.randint(0, 3)))
        best = (10**9, "")
        for size in range(len(letters) + 4):
            for audit in product("DIKR", repeat=size):
                if sum(e != "I" for e in audit) != len(letters):
                    continue
                initials, cost, turns, ok = "", 0, iter(letters), True
                length = size - audit.count("D")
                for e in audit:
                    want = t.target(length)[len(initials)] if e != "D" and len(initials) < length else ""
                    if e == "I":
                        cost, initials, ok = cost + 2, initials + want, ok and want in "ua"
                        continue
                    x = next(turns)
                    if e == "D":
                        cost += 3
                        continue
                    ok = ok and x not in t.BLANKS + t.DUPLICATES and (e == "K" or want in "ua") and (e == "R" or x.lower() == want)
                    cost, initials = cost + x.isupper() + 2 * (e == "R"), initials + want
                if ok and re.fullmatch("(s?(ua)+)?", initials):
                    best = min(best, (cost, "".join(audit)))
        assert search(letters) == best, letters


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1024])
def test_alignment_equals_search(piece):
    rng = random.Random(piece)
    for _ in range(150):
        pool = rng.choice(["suaxSUAX04", "ua", "uaUA", "sS", "uuuuas", "x", "04", "aaaau4", "su"])
        letters = "".join(rng.choice(pool) for _ in range(rng.randint(0, 24)))
        assert t.repair(letters, piece) == search(letters), letters


def test_long_conversations():
    rng = random.Random(2)
    for pool in ("ua", "uauauaua0", "suaxSUAX04", "s", "a"):
        letters = "".join(rng.choice(pool) for _ in range(1300))
        cost, audit = t.repair(letters)
        assert cost == search(letters)[0] and audit == t.repair(letters, 700)[1]


def brute(rows):
    out, by_conv = [], {}
    for conv_id, turn, role, text in rows:
        by_conv.setdefault(conv_id, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by_conv[conv_id] += [(turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    for conv_id, turns in by_conv.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, letters, counts = set(), "", dict.fromkeys(COUNTS, 0)
        for _, role, text in turns:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            k = "sua".find(role[:1]) if role[:1] else -1
            letters += {"blank": t.BLANKS, "duplicate": t.DUPLICATES, "truncated": "SUAX"}.get(fault, "suax")[k if k >= 0 else 3]
        initials = [role[:1] for _, role, _ in turns]
        counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
        numbers = {turn for turn, _, _ in turns if turn is not None}
        counts["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        counts["cost"], audit = search(letters)
        lines, source, made = [], iter(turns), t.target(len(audit) - audit.count("D"))
        for e in audit:
            if e == "I":
                lines.append({"u": "user", "a": "assistant"}[made[len(lines)]] + ":")
                continue
            _, role, text = next(source)
            if e != "D":
                lines.append((role if e == "K" else {"u": "user", "a": "assistant"}[made[len(lines)]]) + ":" + text)
        out.append((conv_id, *[counts[c] for c in COUNTS], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(spark, rows, schema=SCHEMA):
    got = t.structure_repairs(spark.createDataFrame(rows, schema)).collect()
    return sorted((tuple(r[c] for c in NAMES) for r in got), key=lambda r: (r[0] is None, r[0] or 0))


def test_tables_equal_the_plain_reading(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", " ", None, "uncle", "User"]
    texts = ["Fine.", "Why?\n", "cut off", "", " \t", None, "é!", "Same.", "a.b.c", "No ", "x" * 3000 + "."]
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(roles)
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, rng.choice([*texts, f"Text {turn}.", f"Text {turn}!", f"More {turn}."])))
    rows += [(1000 + c, 0, "user", "Dropped or not.") for c in range(60)]
    rows += [(5000, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(3000)]  # longer than a piece
    rows += rows[:50]
    rng.shuffle(rows)
    assert repaired(spark, rows) == brute(rows)


def test_registered_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repaired(spark, rows) == brute(rows)


def test_defined_cases(spark):
    schema = SCHEMA + ", audit string, part int, at array<int>, letters double"
    assert repaired(spark, [], schema) == []
    rows = [(None, None, None, None), (1, None, "user", None), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (2, 1, "assistant", "z" * 300_000)]
    assert repaired(spark, [(*r, "x", 1, [1], 0.5) for r in rows], schema) == brute(rows)


def test_one_conversation_of_many_copies(spark):
    rows = [(1, i // 500, "user", "Same.") for i in range(6000)]
    assert repaired(spark, rows) == brute(rows)
