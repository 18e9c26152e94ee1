"""Repair of conversations against a plain dynamic program, and that against all edit strings."""

import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from riskloom.llm import conversations as C
from riskloom.llm.catalog import QUERIES

WHITE = " \t\n\x0b\x0c\r"
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    """Rows (conv, turn, role, text) after the planted faults, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    """Rows in order with their first fault."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, found = set(), []
    for turn, role, text in rows:
        end = text.rstrip(WHITE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append((turn, role, text, fault))
    return found


def choices(last, row):
    """(letter, initial afterwards, cost) of every edit that consumes the row."""
    _, role, _, fault = row
    options = [("D", last, 4)]
    if fault not in ("blank", "duplicate"):
        extra = 3 if fault == "truncated" else 0
        if role[:1] and role[:1] in AFTER[last]:
            options.append(("K", role[0], extra))
        options += [("R", to, 3 + extra) for to in AFTER[last] if to in "ua"]
    return options


def cheapest(rows):
    """(cost, letters, repaired text) from the cost of what is left, letter by letter."""
    n = len(rows)

    @lru_cache(None)
    def rest(i, last, inserts):
        found = []
        if i == n and last in ("", "a"):
            found.append((0, "", ()))
        if i < n:
            for letter, to, cost in choices(last, rows[i]):
                more = rest(i + 1, to, 0)
                role = rows[i][1] if letter == "K" else {"u": "user", "a": "assistant"}.get(to)
                line = () if letter == "D" else (f"{role}:{rows[i][2]}",)
                if more:
                    found.append((cost + more[0], letter + more[1], line + more[2]))
        if inserts < 4:
            for to in AFTER[last]:
                if to in "ua":
                    more = rest(i, to, inserts + 1)
                    if more:
                        found.append((3 + more[0], "I" + more[1], ({"u": "user:", "a": "assistant:"}[to],) + more[2]))
        return min(found) if found else None

    return rest(0, "", 0)


def expected(rows):
    result = {}
    for conv, some in damaged(rows).items():
        some = faults(some)
        turns = {r[0] for r in some if r[0] is not None}
        cost, audit, lines = cheapest(tuple(some))
        count = [sum(r[3] == f for r in some) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def actual(frame):
    rows = frame.select("conv_id", *C.NAMES[1:]).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_plain_program_is_cheapest():
    """Over all edit strings of short conversations."""
    rng = random.Random(1)
    for _ in range(60):
        rows = faults([(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["", "a.", "b", "c!"]))
                       for i in range(rng.randint(0, 3))])
        best = None
        for size in range(len(rows) + 4):
            for letters in itertools.product("DIKR", repeat=size):
                states = {("", 0): 0}
                for letter in letters:
                    following = {}
                    for (last, i), cost in states.items():
                        if letter == "I":
                            steps = [(to, i, 3) for to in AFTER[last] if to in "ua"]
                        elif i < len(rows):
                            steps = [(to, i + 1, c) for e, to, c in choices(last, rows[i]) if e == letter]
                        else:
                            steps = []
                        for to, j, c in steps:
                            following[to, j] = min(following.get((to, j), 99), cost + c)
                    states = following
                done = [c for (last, i), c in states.items() if i == len(rows) and last in ("", "a")]
                if done and (best is None or (min(done), "".join(letters)) < best):
                    best = (min(done), "".join(letters))
        assert best == cheapest(tuple(rows))[:2]


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert actual(QUERIES["op12_conversations"](spark, path)) == expected(rows)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def random_rows(seed, conversations, length):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", None, "änder", "Unknown"]
    texts = ["Hello.", "Yes!", "cut off", "", " \n", "Really?", "end.\x0b ", "ünd ", None, "x" * 3000 + "."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, length)):
            rows.append((conv if rng.random() < .98 else None, rng.choice([turn, turn, turn, turn + 3, None]),
                         rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < .6 else f"text {rng.random()}."))
    return rows + rows[:5]


@pytest.mark.parametrize("spill", [C.SPILL_ROWS, 3])
def test_odd_rows(spark, spill):
    rows = random_rows(4, 60, 14)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    frame = frame.select("*", *[F.lit(1).alias(n) for n in ("key", "gone", "seen", "conversation", "blank")])
    assert actual(C.damaged_and_repaired(frame, spill_rows=spill)) == expected(rows)


def test_one_long_conversation(spark):
    """More turns than an Arrow batch or a block of backpointers, and as costly as the plain program says."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"turn {i}" + rng.choice(".?,")) for i in range(25_000)]
    found = actual(C.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA), spill_rows=1000))[1]
    some = faults(damaged(rows)[1])
    costs = {"": 0}
    for row in some + [None]:
        for _ in range(3):
            for last in list(costs):
                for to in AFTER[last]:
                    if to in "ua":
                        costs[to] = min(costs.get(to, 1 << 30), costs[last] + 3)
        if row is None:
            break
        following = {}
        for last, cost in costs.items():
            for _, to, c in choices(last, row):
                following[to] = min(following.get(to, 1 << 30), cost + c)
        costs = following
    assert found[5] == min(costs.get("", 1 << 30), costs["a"])
    assert sum(c != "I" for c in found[6]) == len(some)


def test_all_rows_lost_and_empty(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Hi.")]
    assert actual(C.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA))) == {
        lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert actual(C.damaged_and_repaired(spark.createDataFrame([], SCHEMA))) == {}
