"""Conversation structure repair: the cheapest edits that make a conversation's turns alternate, found by IDA*.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Edits are Delete, Insert (an empty user or
assistant turn), Keep and Rerole (to user or assistant). Conversations are cut into pieces of SEGMENT consecutive rows.
Each piece is searched on its own, for the grammar states it may begin and end in, and the pieces of a conversation are
put together in order: a piece's audits end with an edit of a row, so none of them is the beginning of another, and the
cheapest, ASCII-least whole is made of cheapest, ASCII-least parts. So a conversation of any length is searched by many
tasks, and only its audit (which is one value of the result) and the digest of its text pass through one.

Defined cases: a null or unknown role can only be reroled or deleted; an empty role has no initial and counts as unknown.
Rows of one turn are ordered by role and text. Rows with a null conv_id are one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.session import materialise
from ratingloom.skew import global_rank

SEGMENT = 256  # rows of a piece
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
INITIALS = "sua?"
HEALTHY, CUT, GONE = range(3)  # of a row: nothing wrong, truncated, to be deleted
# Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURNED = (2, 2, 3, 2)  # the state that a reroled or inserted turn leads to
ENDING = (0, 2 * INSERT, INSERT, 0)  # what ends a conversation in each state
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 40


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``conversations`` with reproducible faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it the user's. Nulls are read
    as one space, a null turn and a null conv_id stay null as well.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _initial(code: str) -> str:
    return INITIALS[int(code, 16) % 4]


def _fault(code: str) -> int:
    return int(code, 16) // 4


class _Piece:
    """What is known of a piece before the search: its rows and lower bounds of what the rest of it costs."""

    def __init__(self, codes: str):
        self.initial = [_initial(c) for c in codes]
        self.fault = [_fault(c) for c in codes]
        n = len(codes)
        self.least = [self._row(i) for i in range(n)]
        left = [i for i in range(n) if self.fault[i] != GONE]
        bound = [0] * (len(left) + 2)  # of the rows left[k:], without those that must go
        for k in range(len(left) - 1, -1, -1):
            bound[k] = self.least[left[k]] + bound[k + 1]
            if k + 1 < len(left):
                i, j = left[k], left[k + 1]
                bound[k] = max(bound[k], self.least[i] + self._clash(i, j) + self.least[j] + bound[k + 2])
        self.rest, self.after, self.first = [0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        gone, k = 0, len(left)
        for i in range(n, -1, -1):
            if i < n and self.fault[i] == GONE:
                gone += DELETE
            elif i < n:
                k -= 1
            self.rest[i] = gone + bound[k]
            if k < len(left):
                self.first[i], self.after[i] = left[k], gone + self.least[left[k]] + bound[k + 1]

    def _row(self, i: int) -> int:
        if self.fault[i] == GONE:
            return DELETE
        keep = (REROLE if self.initial[i] == "?" else 0) + (TRUNCATED if self.fault[i] == CUT else 0)
        return min(keep, DELETE)

    def _clash(self, i: int, j: int) -> int:
        """Least cost, beyond that of the rows themselves, of two neighbours that stay and don't go together."""
        if "?" in (self.initial[i], self.initial[j]) or self.initial[i] + self.initial[j] in LEGAL:
            return 0
        return min(INSERT, REROLE, DELETE - self.least[i], DELETE - self.least[j])

    def bound(self, i: int, state: int, goal: int | None) -> int:
        """At most the cost of all edits from row ``i`` on, in grammar state ``state``."""
        if goal is not None and goal < min(state, 2):
            return NEVER  # no edit leads back to before the first user turn
        j = self.first[i]
        if j >= 0:
            fits = self.initial[j] == "?" or self.initial[j] in KEPT[state]
            return max(self.rest[i], self.after[i] + (0 if fits else min(INSERT, REROLE, DELETE - self.least[j])))
        if i == len(self.initial):
            return ENDING[state] if goal is None else 0 if state == goal else NEVER
        return self.rest[i] + (ENDING[state] if goal is None else 0)

    def edits(self, i: int, state: int, goal: int | None) -> Iterator[tuple[str, int, int, int]]:
        """(initial, row after it, state after it, cost) of each edit, in ASCII order."""
        turned = TURNED[state]
        if i == len(self.initial):
            if goal is None:
                yield "I", i, turned, INSERT
            return
        yield "D", i + 1, state, DELETE
        yield "I", i, turned, INSERT
        if self.fault[i] != GONE:
            cut = TRUNCATED if self.fault[i] == CUT else 0
            kept = KEPT[state].get(self.initial[i])
            if kept is not None:
                yield "K", i + 1, kept, cut
            if kept != turned:
                yield "R", i + 1, turned, REROLE + cut


def search(codes: str, start: int = 0, goal: int | None = None) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of a piece, the ASCII-least of them; None where there are none.

    ``goal`` None ends a conversation, after inserts if need be; a state ends a piece in that state, without inserts
    after its last row. Iterative-deepening A*: depth first in ASCII order, bounded by cost so far and lower bound of the
    rest; the next bound is the least that was exceeded. A state (row, grammar state) that failed keeps the cost it
    is now known to need at least, so it is entered again only with more to spend.
    """
    n = len(codes)
    if goal is not None and goal < 2:
        keeps_system = goal == 1 and start == 0 and any(_initial(c) == "s" and _fault(c) != GONE for c in codes)
        if start != goal and not keeps_system:
            return None
    piece = _Piece(codes)
    done = lambda i, state: i == n and (state in (0, 3) if goal is None else state == goal)
    if done(0, start):
        return 0, ""
    if not n and goal is not None:
        return None
    failed: dict[tuple[int, int], int] = {}
    need = lambda i, state: max(piece.bound(i, state, goal), failed.get((i, state), 0))
    bound = need(0, start)
    while bound < NEVER:
        # frames: row, state, what may be spent from here, edits left to try, least need seen, edit and cost that led here
        stack = [[0, start, bound, piece.edits(0, start, goal), NEVER, "", 0]]
        while stack:
            frame = stack[-1]
            step = next(frame[3], None)
            if step is None:
                stack.pop()
                failed[frame[0], frame[1]] = max(frame[4], failed.get((frame[0], frame[1]), 0))
                if stack:
                    stack[-1][4] = min(stack[-1][4], frame[6] + frame[4])
                continue
            edit, i, state, cost = step
            room = frame[2] - cost
            if done(i, state) and room >= 0:
                return bound - room, "".join(f[5] for f in stack) + edit
            rest = need(i, state)
            if rest > room:
                frame[4] = min(frame[4], cost + rest)
            else:
                stack.append([i, state, room, piece.edits(i, state, goal), NEVER, edit, cost])
        bound = failed[0, start]
    return None


@lru_cache(maxsize=1 << 14)  # short conversations look alike
def _options(codes: str, first: bool, last: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of a piece; a last piece ends in acceptance, written as state 0."""
    out = []
    for start in (0,) if first else range(4):
        for goal in (None,) if last else range(4):
            found = search(codes, start, goal)
            if found:
                out.append((start, goal or 0, *found))
    return tuple(out)


_SEARCHED = "struct<start:int,stop:int,cost:long,audit:string>"


def _search_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    options = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        codes, firsts, lasts = (batch.column(c).to_pylist() for c in ("codes", "first", "last"))
        found = [[dict(zip(("start", "stop", "cost", "audit"), o, strict=True)) for o in _options(*p)] for p in zip(codes, firsts, lasts, strict=True)]
        pairs = [[_initial(c) for c in p] for p in codes]
        illegal = [sum(a + b not in LEGAL for a, b in zip(p, p[1:], strict=False)) for p in pairs]
        ends = [p[0] for p in pairs], [p[-1] for p in pairs]
        columns = [batch.column("conv_id"), batch.column("at"), batch.column("last"), pa.array(illegal, pa.int64()), *map(pa.array, ends), pa.array(found, options)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "at", "last", "illegal", "head", "tail", "options"])


class _Fold:
    """Pieces of one conversation in order: the best way into each grammar state, by cost, then by audit."""

    def __init__(self):
        self.best = {0: (0, 0)}  # state: cost, place of its audit among those of the other states
        self.back: list[tuple[int, dict]] = []  # of each piece: where it begins, state: (state before, audit part)
        self.illegal, self.tail = 0, None

    def add(self, piece: dict) -> None:
        if self.tail is not None and self.tail + piece["head"] not in LEGAL:
            self.illegal += 1
        self.illegal, self.tail = self.illegal + piece["illegal"], piece["tail"]
        ways: dict[int, tuple] = {}
        for o in piece["options"]:
            if o["start"] in self.best:
                cost, place = self.best[o["start"]]
                way = (cost + o["cost"], place, o["audit"], o["start"])
                ways[o["stop"]] = min(way, ways.get(o["stop"], way))
        order = sorted(ways, key=lambda s: ways[s][1:3])
        self.best = {s: (ways[s][0], order.index(s)) for s in ways}
        self.back.append((piece["at"], {s: (ways[s][3], ways[s][2]) for s in ways}))

    def parts(self) -> tuple[int, list[tuple[int, int, str]]]:
        """Cost, and for each piece where it begins, its first state and its part of the audit."""
        state, out = 0, []
        for at, ways in reversed(self.back):
            before, audit = ways[state]
            out.append((at, before, audit))
            state = before
        return self.best[0][0], out[::-1]


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = _Fold()
    names = ["conv_id", "at", "state", "part", "cost", "illegal"]
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            fold.add(row)
            if row["last"]:
                cost, parts = fold.parts()
                for k, (at, state, part) in enumerate(parts):
                    out.append((row["conv_id"], at, state, part, 0 if k else cost, 0 if k else fold.illegal))
                fold = _Fold()
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies the parts to the rows that follow them. Both are sorted by conversation and place, a part before its rows."""
    conv, part, state, at, names = None, iter(()), 0, 0, ["conv_id", "place", "role", "text"]
    for batch in batches:
        out: list[tuple] = []

        def turn(role: str, text: str) -> None:
            nonlocal at
            at += 1
            out.append((conv, at, role, text))

        def inserted(edit: str | None) -> str | None:
            nonlocal state
            while edit == "I":
                state = TURNED[state]
                turn("user" if state == 2 else "assistant", "")
                edit = next(part, None)
            return edit

        for row in batch.to_pylist():
            if row["kind"] == 0:
                inserted(next(part, None))  # at the end of the piece before
                at = at if row["conv_id"] == conv else 0
                conv, part, state = row["conv_id"], iter(row["text"]), int(row["role"])
                continue
            edit = inserted(next(part, None))
            if edit == "K":
                state = KEPT[state][row["role"][:1]]
                turn(row["role"], row["text"])
            elif edit == "R":
                state = TURNED[state]
                turn("user" if state == 2 else "assistant", row["text"])
        yield _batch(out, names, [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()])
    left = list(part)
    if left:  # the inserts that end the task's last conversation
        out = []
        for _ in left:
            state, at = TURNED[state], at + 1
            out.append((conv, at, "user" if state == 2 else "assistant", ""))
        yield _batch(out, names, [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()])


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha, kinds = None, None, []
    for batch in batches:
        out: list[tuple] = []
        kinds = [batch.schema.field("conv_id").type, pa.string()]
        for row in batch.to_pylist():
            if row["place"] == 1:
                if sha:
                    out.append((conv, sha.hexdigest()))
                conv, sha = row["conv_id"], hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{row['role']}:{row['text']}".encode())
        yield _batch(out, ["conv_id", "repaired_sha256"], kinds)
    if sha:
        yield _batch([(conv, sha.hexdigest())], ["conv_id", "repaired_sha256"], kinds)


class Repair:
    """The repair of ``rows`` (conv_id, turn, role, text): ``report`` and ``turns``."""

    def __init__(self, rows: DataFrame):
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
        self._id_type = rows.schema["conv_id"].dataType.simpleString()
        # one sort of the texts puts every row in its place; what follows moves short rows only, until turns()
        self.rows = global_rank(rows, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "at")
        seen = self._marked()
        spans = seen.groupBy("conv_id").agg(*self._counts(), F.min("at").alias("_from"), F.max("at").alias("_to"))
        self._spans = materialise(spans, "conversations")
        self._parts = materialise(self._searched(seen), "repairs")

    def _marked(self) -> DataFrame:
        """conv_id, turn, at, code, fault of every row; the first row with a role and a text isn't a duplicate."""
        end = F.rtrim("text", F.lit(SPACE))
        light = self.rows.select(
            "conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("says"),
            (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
        )
        light = materialise(light, "turns")
        firsts = light.filter("not blank").groupBy("conv_id", "says").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
        same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.says") == F.col("b.says"))
        joined = light.alias("a").join(firsts.alias("b"), same, "left")
        repeated = ~F.col("blank") & F.coalesce(F.col("b.first") < F.col("a.at"), F.lit(False))
        fault = F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("cut"), "truncated")
        found = joined.select("a.conv_id", "turn", "at", "initial", fault.alias("fault"))
        state = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(HEALTHY)
        number = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
        return materialise(found.withColumn("code", F.lower(F.hex((state * 4 + number).cast("long")))).drop("initial"), "marked")

    @staticmethod
    def _counts() -> list[Column]:
        wide = lambda c: c.cast("decimal(20,0)")
        gaps = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
        faults = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
        return [F.coalesce(gaps.try_cast("long"), F.lit(0)).alias("gaps"), *faults]

    def _searched(self, seen: DataFrame) -> DataFrame:
        seen = seen.withColumn("piece", F.floor(F.col("at") / SEGMENT))
        codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]), "")
        pieces = seen.groupBy("conv_id", "piece").agg(F.min("at").alias("at"), F.max("at").alias("to"), codes.alias("codes"))
        spans = self._spans.select(F.col("conv_id").alias("_conv"), "_from", "_to")
        pieces = pieces.join(spans, F.col("conv_id").eqNullSafe(F.col("_conv")))
        pieces = pieces.select("conv_id", "at", "codes", (F.col("at") == F.col("_from")).alias("first"), (F.col("to") == F.col("_to")).alias("last"))
        found = pieces.mapInArrow(_search_pieces, f"conv_id {self._id_type}, at long, last boolean, illegal long, head string, tail string, options array<{_SEARCHED}>")
        ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "at")
        return ordered.mapInArrow(_join_pieces, f"conv_id {self._id_type}, at long, state int, part string, cost long, illegal long")

    def report(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation that has rows."""
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda r: r["part"]), "")
        paths = self._parts.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
        found = self._spans.alias("s").join(paths.alias("p"), F.col("s.conv_id").eqNullSafe(F.col("p.conv_id")))
        return found.select("s.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def turns(self) -> DataFrame:
        """conv_id, place (from 1), role, text of the repaired conversations, each in one partition and in order.

        Rows are streamed, so a conversation of any length needs no more memory than a batch.
        """
        parts = self._parts.select("conv_id", "at", F.lit(0).alias("kind"), F.col("state").cast("string").alias("role"), F.col("part").alias("text"))
        rows = self.rows.select("conv_id", "at", F.lit(1).alias("kind"), "role", "text")
        both = parts.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
        return both.mapInArrow(_edit_rows, f"conv_id {self._id_type}, place long, role string, text string")

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256 of every conversation that has turns: of ``role:text``, newline-joined.

        SHA-256 reads its input in order, so the turns of one conversation pass through one task, as a stream.
        """
        return self.turns().mapInArrow(_digests, f"conv_id {self._id_type}, repaired_sha256 string")


def repair(rows: DataFrame) -> Repair:
    """Repairs conversations of any length; other columns of ``rows`` are left out."""
    return Repair(rows)


def audit(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged ``conversations``: one row per original conv_id (null too).

    A conversation without rows after the damage has zeros, an empty audit and the hash of the empty text. No rows: no rows.
    """
    fixed = repair(damage(conversations))
    ids = conversations.select("conv_id").distinct()
    out = ids.alias("i").join(fixed.report().alias("r"), F.col("i.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    out = out.join(fixed.digests().alias("d"), F.col("i.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "i.conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
