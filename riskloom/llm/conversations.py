"""Repair of conversations: damaged turns are found and mended by the cheapest edits.

A well-formed conversation has the role initials ``(s?(ua)+)?``: at most one
system turn, then user and assistant in turn. ``repair`` reads one row per turn
and returns one row per conversation: what is wrong, the cheapest edits and the
digest of the mended turns.

Edits, with their letter and cost: K keep 0, R give the role user or assistant
3, D delete 4, I insert an empty turn of user or assistant 3. A blank turn (no
character but white space) and a duplicate (role and text of an earlier turn)
must be deleted; a truncated one (last character no ``.!?``) costs 3 more unless
it is deleted. Among equally cheap edits the ASCII-least letters win.

Rows are dealt by conversation and sorted by turn, which Spark does on disk if
need be; the same exchange serves the window that marks duplicates. A task then
streams over its rows and carries, from Arrow batch to Arrow batch, for each of
the four places in the pattern: the least cost, the order of the edit letters so
far and the running digest of the mended turns. Dominated places are dropped, so
the cost differences are bounded and every step is one of a few hundred entries
of a table built as it is needed. The number of the step, two bytes a row, is the
backpointer; conversations longer than ``SPILL_ROWS`` write theirs block by block
to the shared folder and read them back from the end. No conversation's texts are
ever held together. A digest cannot be put together from parts, so one
conversation is one task's stream, however long it is.

NULL roles and texts read as one space. Rows with a NULL turn come first; equal
turns are ordered by role and text. A NULL conversation id is an id of its own.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.token_files import file_system
from riskloom.session import parallelism, scratch_path

# Turns of one conversation whose backpointers a task holds before it writes them.
SPILL_ROWS = 1 << 20

KEEP, RENAME, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
# Places in the pattern, the place an inserted turn leads to, and the role it has.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = (None, None, b"user:", b"assistant:")
# Inserts that can pay before a row: more would come back to a place that cost less.
INSERTS = (2, 2, 1, 1)
ENDS = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
NEVER = 1 << 30

# Row kinds: the initial's class (0 system, 1 user, 2 assistant, 3 other), must go, truncated.
KINDS = {b"s": 0, b"u": 1, b"a": 2}
LEGAL = {b"su", b"ua", b"au"}


def _step(costs: tuple, ranks: tuple, initial: int, must_go: bool, truncated: bool) -> tuple:
    """(added cost, costs, ranks, moves) after one more row; a move is (place before, inserts, letter) per place."""
    best: list = [None] * 4
    extra = TRUNCATED if truncated else 0
    for before in range(4):
        if costs[before] >= NEVER:
            continue
        place = before
        for inserts in range(INSERTS[before] + 1):
            cost, letters = costs[before] + INSERT * inserts, "I" * inserts
            options = [("D", place, DELETE)]
            if not must_go:
                options.append(("R", NEXT[place], RENAME + extra))
                if initial == 0 and place == START:
                    options.append(("K", SYSTEM, KEEP + extra))
                elif initial in (1, 2) and NEXT[place] == (USER if initial == 1 else ASSISTANT):
                    options.append(("K", NEXT[place], KEEP + extra))
            for letter, to, price in options:
                found = (cost + price, ranks[before], letters + letter, before, inserts)
                if best[to] is None or found < best[to]:
                    best[to] = found
            place = NEXT[place]
    total = [b[0] if b else NEVER for b in best]
    # What another place does at no more cost can go: inserts lead from user to assistant and back, and a
    # conversation that is done can delete a system turn where an empty one would keep it.
    if total[USER] > total[ASSISTANT] + INSERT:
        total[USER] = NEVER
    if total[ASSISTANT] > total[USER] + INSERT:
        total[ASSISTANT] = NEVER
    if total[SYSTEM] > total[ASSISTANT]:
        total[SYSTEM] = NEVER
    if total[START] > total[ASSISTANT] + DELETE:
        total[START] = NEVER
    low = min(total)
    live = [p for p in range(4) if total[p] < NEVER]
    order = {p: i for i, p in enumerate(sorted(live, key=lambda p: best[p][1:3]))}
    return (low, tuple(c - low if c < NEVER else NEVER for c in total), tuple(order.get(p, 0) for p in range(4)),
            tuple((best[p][3], best[p][4], best[p][2][-1]) if total[p] < NEVER else None for p in range(4)))


class Steps:
    """All steps met so far, numbered: the automaton of the dynamic program."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.table: list[tuple] = []
        self.sources: dict[tuple, int] = {}
        self.states: list[tuple] = []

    def state(self, costs: tuple, ranks: tuple) -> int:
        key = (costs, ranks)
        if key not in self.sources:
            self.sources[key] = len(self.states)
            self.states.append(key)
        return self.sources[key]

    def take(self, state: int, kind: tuple) -> int:
        number = self.known.get((state, kind))
        if number is None:
            added, costs, ranks, moves = _step(*self.states[state], *kind)
            number = self.known[state, kind] = len(self.table)
            self.table.append((added, self.state(costs, ranks), moves))
            if number >= 1 << 16:
                raise OverflowError("more steps than a backpointer can name")
        return number


_STEPS = Steps()


class Blocks:
    """Backpointers of one conversation: the latest in memory, earlier ones in files of the shared folder."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit = folder, limit
        self.held, self.files = array("H"), []

    def add(self, number: int) -> None:
        self.held.append(number)
        if len(self.held) >= self.limit:
            system, path = file_system(f"{self.folder}/{uuid.uuid4().hex}")
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(path) as sink:
                sink.write(self.held.tobytes())
            self.files.append((system, path))
            self.held = array("H")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        for system, path in reversed(self.files):
            block = array("H")
            with system.open_input_stream(path) as source:
                block.frombytes(source.read())
            yield from reversed(block)
            system.delete_file(path)


class Conversation:
    """The running state of one conversation."""

    def __init__(self, folder: str, limit: int):
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.cost = self.rows = 0
        self.initial: bytes | None = None
        self.state = _STEPS.state((0, NEVER, NEVER, NEVER), (0, 0, 0, 0))
        self.digests: list = [hashlib.sha256(), None, None, None]
        self.blocks = Blocks(folder, limit)

    def add(self, turn: str | None, role: bytes, text: bytes, blank: bool, seen: bool, unfinished: bool) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            self.high = int(turn)
            if self.low is None:
                self.low = self.high
        initial = role[:1] if role[:1] < b"\x80" else b"?"
        if self.rows and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.rows += 1
        if blank:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif unfinished:
            self.truncated += 1
        must_go = blank or seen
        number = _STEPS.take(self.state, (KINDS.get(initial, 3), must_go, unfinished and not must_go))
        added, self.state, moves = _STEPS.table[number]
        self.cost += added
        self.blocks.add(number)
        if must_go and all(m is None or (m[0] == p and m[1] == 0) for p, m in enumerate(moves)):
            self.digests = [d if m else None for d, m in zip(self.digests, moves)]
            return
        digests: list = [None] * 4
        for place, move in enumerate(moves):
            if move is not None:
                before, inserts, letter = move
                digest = self.digests[before]
                if inserts or letter != "D":
                    digest = digest.copy()
                    at = _inserted(digest, before, inserts)
                    if letter != "D":
                        if at != START:
                            digest.update(b"\n")
                        digest.update(role + b":" if letter == "K" else ROLE[place])
                        digest.update(text)
                digests[place] = digest
        self.digests = digests

    def close(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        costs, ranks = _STEPS.states[self.state]
        final = min((costs[p] + INSERT * n, ranks[p], p) for p, n in ENDS.items() if costs[p] < NEVER)
        place = final[2]
        inserts = ENDS[place]
        digest = self.digests[place]
        if inserts:
            digest = digest.copy()
            _inserted(digest, place, inserts)
        letters = bytearray(b"I" * inserts)
        for number in self.blocks.backwards():
            place, n, letter = _STEPS.table[number][2][place]
            letters.append(ord(letter))
            letters += b"I" * n
        letters.reverse()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + final[0], letters.decode(),
                digest.hexdigest())


def _inserted(digest, place: int, inserts: int) -> int:
    """Adds empty turns to the digest; the place after them."""
    for _ in range(inserts):
        if place != START:
            digest.update(b"\n")
        place = NEXT[place]
        digest.update(ROLE[place])
    return place


def damage(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conversation, turn, role, text, gone) after planted faults, chosen by crc32 of ``conversation:turn``.

    Of twenty rows one is lost (``gone``, kept so that its conversation is known), one loses its text, one its
    ``.!?``, one is doubled and one gets the role user. NULLs read as one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conversation).cast("string"), space), F.lit(":"),
                   F.coalesce(F.col(turn).cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    rows = turns.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), space).alias("role"),
                        F.coalesce(F.col(text).cast("string"), space).alias("text"), fault.alias("fault"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conversation", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def repair(rows: DataFrame, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (columns conversation, turn, role, text, gone; gone rows count as absent).

    Returns conversation, gaps (turn numbers missing between the least and the greatest), blank, duplicate,
    truncated, illegal (neighbours whose initials are not su, ua or au), cost, audit (letters of the edits) and
    repaired_sha256 (digest of the mended ``role:text``, joined by newlines).
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, "backpointers")
    kind = rows.schema["conversation"].dataType
    space = F.lit(" ")
    dealt = rows.select("conversation", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"), F.coalesce("gone", F.lit(False)).alias("gone")) \
        .repartition(parallelism(spark), "conversation")
    # Dealt by conversation already: the window needs no exchange of its own.
    same = Window.partitionBy("conversation", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    ended = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    marked = dealt.select(
        F.col("conversation"), F.col("turn"), F.col("role"), F.col("text"), F.col("gone"),
        (F.row_number().over(same) > 1).alias("seen"), (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("unfinished"))
    ordered = marked.sortWithinPartitions("conversation", F.asc_nulls_first("turn"), "role", "text")
    sent = ordered.select(F.col("conversation").cast("string").alias("key"), F.col("turn").cast("string").alias("turn"),
                          F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
                          "gone", "seen", "blank", "unfinished")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, key, done = None, None, []
        for batch in batches:
            for name, turn, role, text, gone, seen, blank, unfinished in zip(
                    *(batch[c].tolist() for c in ("key", "turn", "role", "text", "gone", "seen", "blank", "unfinished"))):
                if current is None or name != key:
                    if current is not None:
                        done.append((key, *current.close()))
                    current, key = Conversation(folder, spill_rows), name
                if not gone:
                    current.add(turn, role, text, blank, seen, unfinished)
            if len(done) >= 1000:
                yield pd.DataFrame(done, columns=NAMES)
                done = []
        if current is not None:
            done.append((key, *current.close()))
        if done:
            yield pd.DataFrame(done, columns=NAMES)

    found = sent.mapInPandas(walk, "key string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                                   "illegal bigint, cost bigint, audit string, repaired_sha256 string")
    return found.select(F.col("key").cast(kind).alias("conversation"), *[F.col(c) for c in NAMES[1:]])


NAMES = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged_and_repaired(turns: DataFrame, **options) -> DataFrame:
    """``repair`` of ``turns`` after ``damage``; every conversation of ``turns`` is returned, as conv_id."""
    return repair(damage(turns), **options).withColumnRenamed("conversation", "conv_id")
