"""Finds faults in conversations and repairs their structure at the least cost.

A conversation is well formed if the initials of its roles match `(s?(ua)+)?`.  Its rows, in order,
are kept, given another role or deleted, and empty turns may be inserted anywhere.  The cheapest way
is a shortest path through a graph of (row, state), where the state tells what may follow: nothing
yet, after the system turn, after a user, after an assistant.

A path's weight is one whole number: the cost in its high digits and, below them, the letters of its
edits as digits of fixed width, the first edit highest and zeros after the last one.  The smaller number is
the cheaper path and, of equally cheap ones, the one whose letters come first; so taking the
smallest integer decides everything.  Paths are built from the end: an edit shifts the digits behind it down
by one and puts its letter in front.  Over the same rows no path's letters begin another's of equal
cost (what would be left are insertions, which cost), so a stretch of rows can be solved by itself,
for each state before and after it, and stretches put together by the same minimum.

How the work is dealt: rows without their texts are sorted over all tasks by conversation and turn, so
a conversation of any length is cut where the task ends.  Each task solves its stretches; only
conversations that were cut go through a second step, which joins one matrix of 16 paths per task.
Repaired texts are then streamed through the task of their conversation, in order and a batch at a time,
since a digest has no parallel form; only the letters of one conversation are held there.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import short_batches
from lenstrail.sources.tables import cut_lineage

SPACE = r"\x20\x09-\x0D"
RUN = 256  # rows solved at a time; a longer stretch is put together from such runs

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # state after an inserted turn, or one given a new role
ENDS = {START: (0, b""), ASSISTANT: (0, b""), USER: (2, b"I"), SYSTEM: (4, b"II")}  # ways to finish
KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}  # state after a kept turn, by its initial
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
LEGAL = {"su", "ua", "au"}

Path = tuple[int, bytes]  # cost, letters


# --- weights ------------------------------------------------------------------------


class Digits:
    """Weights with room for `length` letters of eight bits below the cost."""

    def __init__(self, length: int):
        self.length, self.bits = length, 8 * length
        self.mask = (1 << self.bits) - 1

    def weight(self, path: Path) -> int:
        return path[0] << self.bits | int.from_bytes(path[1].ljust(self.length, b"\0"), "big")

    def path(self, weight: int) -> Path:
        return weight >> self.bits, (weight & self.mask).to_bytes(self.length, "big").rstrip(b"\0")

    def before(self, letters: bytes, cost: int, weight: int | None) -> int | None:
        """The weight of an edit, or of several, followed by the path of `weight`."""
        if weight is None:
            return None
        low, n = weight & self.mask, len(letters)
        own = int.from_bytes(letters, "big") << self.bits - 8 * n
        return weight - low + (cost << self.bits) + (low >> 8 * n | own)


def least(weights) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def solve(steps: list[tuple[str, str, int]], end: dict[int, Path]) -> list[Path | None]:
    """Best path from each state before `steps` to the states of `end` with what these add.

    A step is (initial of the role, fault, further copies to delete).
    """
    room = sum(3 + n for _, _, n in steps) + max((len(p[1]) for p in end.values()), default=0)
    digits = Digits(room)
    best = [digits.weight(end[s]) if s in end else None for s in range(4)]
    for initial, fault, further in reversed(steps):
        if further:
            best = [digits.before(b"D" * further, 3 * further, w) for w in best]
        after = best
        best = [digits.before(b"D", 3, w) for w in after]
        if fault not in (BLANK, DUPLICATE):
            extra = int(fault == TRUNCATED)
            kept = KEPT.get(initial, {})
            for s in range(4):
                keep = digits.before(b"K", extra, after[kept[s]]) if s in kept else None
                best[s] = least((best[s], keep, digits.before(b"R", 2 + extra, after[NEXT[s]])))
        # Up to two turns inserted before the row; three or more only repeat a state at a cost.
        once = [digits.before(b"I", 2, best[NEXT[s]]) for s in range(4)]
        twice = [digits.before(b"I", 2, once[NEXT[s]]) for s in range(4)]
        best = [least(ws) for ws in zip(best, once, twice, strict=True)]
    return [None if w is None else digits.path(w) for w in best]


Matrix = list[list[Path | None]]  # [state before][state after]


def matrix(steps: list[tuple[str, str, int]]) -> Matrix:
    columns = [solve(steps, {t: (0, b"")}) for t in range(4)]
    return [[columns[t][s] for t in range(4)] for s in range(4)]


def best_of(paths: list[Path]) -> Path | None:
    if not paths:
        return None
    digits = Digits(max(len(p[1]) for p in paths))
    return digits.path(min(digits.weight(p) for p in paths))


def joined(a: Matrix, b: Matrix) -> Matrix:
    """Paths through two stretches, one after the other."""

    def cell(s: int, t: int) -> Path | None:
        ways = [(x, b[u][t]) for u, x in enumerate(a[s])]
        return best_of([(x[0] + y[0], x[1] + y[1]) for x, y in ways if x is not None and y is not None])

    return [[cell(s, t) for t in range(4)] for s in range(4)]


class Stretch:
    """Matrices of runs in order, joined in pairs of like size, so each is copied few times."""

    def __init__(self):
        self.stack: list[tuple[int, Matrix]] = []

    def add(self, m: Matrix) -> None:
        size = 1
        while self.stack and self.stack[-1][0] <= size:
            n, before = self.stack.pop()
            m, size = joined(before, m), size + n
        self.stack.append((size, m))

    def result(self) -> Matrix:
        m = self.stack[-1][1]
        for _, before in reversed(self.stack[:-1]):
            m = joined(before, m)
        return m


def finished(m: Matrix) -> Path:
    ways = [(p[0] + ENDS[t][0], p[1] + ENDS[t][1]) for t, p in enumerate(m[START]) if p is not None]
    return best_of(ways)


# --- rows ---------------------------------------------------------------------------


def plain_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies), NULL roles and texts as one space."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """Rows with one in four of them damaged, by the checksum of `conv_id:turn`.

    Of twenty remainders, 0 drops the row (no copies), 1 empties its text, 2 takes out its full stops, question
    and exclamation marks, 3 repeats it and 4 makes it the user's.  NULLs count as one space.
    """
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kept = plain_rows(conversations).withColumn("_kind", F.crc32(F.concat_ws(":", *own).cast("binary")) % 20)
    return kept.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _fault(text: str = "text") -> Column:
    """Fault that the text alone shows."""
    return (
        F.when(~F.col(text).rlike(f"[^{SPACE}]"), BLANK)
        .when(~F.col(text).rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED)
        .otherwise(SOUND)
    )


def _turn_key() -> Column:
    """Turns in order, NULL first."""
    return F.struct(F.col("turn").isNotNull().alias("known"), "turn")


ORDER = ("conv_id", "turn", "role", "text_hash")


def _in_order(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _units(rows: DataFrame) -> DataFrame:
    """Rows without texts, equal ones counted: (conv_id, turn, role, text_hash, fault, copies)."""
    units = (
        rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("text_hash"), _fault().alias("fault"), "copies")
        .groupBy("conv_id", "turn", "role", "text_hash", "fault")
        .agg(F.sum("copies").alias("copies"))
    )
    told = ("role", "text_hash")
    again = (
        units.where((F.col("copies") > 0) & (F.col("fault") != BLANK))
        .groupBy(F.col("conv_id").alias("of"), *told)
        .agg(F.min(_turn_key()).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .withColumnsRenamed({"role": "r", "text_hash": "h"})
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("r")) & (F.col("text_hash") == F.col("h"))
    later = (F.col("copies") > 0) & F.col("first").isNotNull() & (F.col("first") != _turn_key()) & (F.col("fault") != BLANK)
    return units.join(again, same, "left").select(
        "conv_id", "turn", "role", "text_hash", F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "copies"
    )


FACTS = "n long, blank long, duplicate long, truncated long, illegal long, initial string, final string, low long, high long, turns long"
PATHS = "cost long, audit binary, costs array<long>, audits array<binary>"


class _Facts:
    """What a stretch of one conversation adds up to."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.final = self.low = self.high = None
        self.steps: list[tuple[str, str, int]] = []
        self.stretch = Stretch()

    def add(self, turn: int | None, role: str, fault: str, copies: int) -> None:
        if not copies:
            return
        first = role[:1]
        if self.final is None:
            self.initial = first
        elif self.final + first not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # a role never follows itself
        self.final = first
        self.n += copies
        blank = fault == BLANK
        self.blank += copies if blank else 0
        self.duplicate += (copies if fault == DUPLICATE else copies - 1) if not blank else 0
        self.truncated += fault == TRUNCATED
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.steps.append((first, fault, copies - 1))
        if len(self.steps) >= RUN:
            self.stretch.add(matrix(self.steps))
            self.steps = []

    def path(self) -> Path:
        if not self.stretch.stack:
            return solve(self.steps, ENDS)[START]
        return finished(self.matrix())

    def matrix(self) -> Matrix:
        if self.steps or not self.stretch.stack:
            self.stretch.add(matrix(self.steps))
            self.steps = []
        return self.stretch.result()

    def facts(self) -> dict:
        names = ("conv_id", "n", "blank", "duplicate", "truncated", "illegal", "initial", "final", "low", "high", "turns")
        return {name: getattr(self, name) for name in names}

    def whole_row(self) -> dict:
        cost, letters = self.path()
        return self.facts() | {"cost": cost, "audit": letters, "costs": None, "audits": None}

    def part_row(self) -> dict:
        cells = [c for row in self.matrix() for c in row]
        costs = [None if c is None else c[0] for c in cells]
        audits = [None if c is None else c[1] for c in cells]
        return self.facts() | {"cost": None, "audit": None, "costs": costs, "audits": audits}


def _stretches(units: DataFrame) -> DataFrame:
    """Rows (conv_id, part, facts, path): conversations that one task held, and parts of others."""
    id_type = dict(units.dtypes)["conv_id"]
    schema = f"conv_id {id_type}, {FACTS}, {PATHS}, part int"

    def run(batches):
        part = TaskContext.get().partitionId()
        now, begun, out, arrow = None, False, [], None
        for batch in batches:
            arrow = arrow or pa.schema([
                pa.field("conv_id", batch.schema.field("conv_id").type),
                *[pa.field(n, pa.int64()) for n in ("n", "blank", "duplicate", "truncated", "illegal")],
                pa.field("initial", pa.string()), pa.field("final", pa.string()),
                *[pa.field(n, pa.int64()) for n in ("low", "high", "turns", "cost")],
                pa.field("audit", pa.binary()), pa.field("costs", pa.list_(pa.int64())), pa.field("audits", pa.list_(pa.binary())),
                pa.field("part", pa.int32()),
            ])
            ids, turns, roles, faults, copies = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "fault", "copies"))
            for conv_id, turn, role, fault, n in zip(ids, turns, roles, faults, copies, strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append((now.whole_row() if begun else now.part_row()) | {"part": part})
                        begun = True  # the next one starts in this task
                    now = _Facts(conv_id)
                now.add(turn, role, fault, n)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([*out, now.part_row() | {"part": part}], arrow)

    order = _in_order(*ORDER)
    return units.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def _put_together(table: pa.Table) -> pa.Table:
    """One conversation from its parts, in order of tasks."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    stretch, out = Stretch(), None
    for r in rows:
        cells = [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)]
        stretch.add([cells[4 * s : 4 * s + 4] for s in range(4)])
        if out is None:
            out = r
            continue
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += r[name]
        if r["n"]:
            out["illegal"] += out["final"] is not None and out["final"] + r["initial"] not in LEGAL
            out["initial"] = r["initial"] if out["initial"] is None else out["initial"]
            out["final"] = r["final"]
        out["turns"] += r["turns"] - (r["low"] is not None and r["low"] == out["high"])
        out["low"] = r["low"] if out["low"] is None else out["low"]
        out["high"] = out["high"] if r["high"] is None else r["high"]
        out["n"] += r["n"]
    out["cost"], out["audit"] = finished(stretch.result())
    return pa.Table.from_pylist([out | {"costs": None, "audits": None}], table.schema)


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    `rows` is (conv_id, turn, role, text, copies); one with 0 copies is not there, but keeps its
    conversation in the result.
    """
    parts = cut_lineage(_stretches(_units(rows)))
    cut = parts.where("costs IS NOT NULL")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    whole = parts.where("costs IS NULL").union(cut.groupBy("conv_id").applyInArrow(_put_together, schema))
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0)
    return whole.select(
        "conv_id",
        gaps.cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        F.col("audit").cast("string").alias("audit"),
    )


class _Writer:
    """Applies the letters of one conversation to its rows, in order."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state = letters, 0, START

    def _inserted(self):
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "insert", "user" if self.state == USER else "assistant", ""

    def row(self, role: str, text: str):
        """Repaired turns up to and with this row."""
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEPT[role[:1]][self.state]
            yield "keep", role, text
        elif letter == "R":
            self.state = NEXT[self.state]
            yield "rerole", "user" if self.state == USER else "assistant", text

    def end(self):
        yield from self._inserted()


def _streamed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each conversation's plan and then its rows, in one task and in order."""
    planned = plan.withColumns({"kind": F.lit(0), "turn": F.lit(None).cast("long"), "copies": F.lit(0)})
    texts = rows.where("copies > 0").select(
        "conv_id", "turn", "role", "text", "copies", F.lit(1).alias("kind"), F.unhex(F.sha2("text", 256)).alias("text_hash")
    )
    both = planned.unionByName(texts, allowMissingColumns=True)
    return short_batches(both.repartition("conv_id").sortWithinPartitions(*_in_order("conv_id", "kind", "turn", "role", "text_hash")))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation its counts, cost and audit, and the SHA-256 of its repaired turns as `role:text` lines.

    Conversations without rows have zeros, an empty audit and the digest of an empty text.
    """
    plan = plans(rows)
    stream = _streamed(rows, plan)
    id_type = dict(plan.dtypes)["conv_id"]
    schema = f"conv_id {id_type}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"

    def run(batches):
        row = writer = digest = None
        between, id_type = b"", None

        def put(turns) -> None:
            nonlocal between
            for _, role, text in turns:
                digest.update(between + role.encode() + b":" + text.encode())
                between = b"\n"

        def closed() -> dict:
            put(writer.end())
            return row | {"repaired_sha256": digest.hexdigest()}

        def rows_of(done: list[dict]) -> pa.RecordBatch:
            names = ("conv_id", *COUNTS, "audit", "repaired_sha256")
            types = [id_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_pylist(done, pa.schema(list(zip(names, types, strict=True))))

        for batch in batches:
            id_type, done = batch.schema.field("conv_id").type, []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    if row is not None:
                        done.append(closed())
                    row = {c: r[c] for c in ("conv_id", *COUNTS, "audit")}
                    writer, digest, between = _Writer(r["audit"]), hashlib.sha256(), b""
                else:
                    for _ in range(r["copies"]):
                        put(writer.row(r["role"], r["text"]))
            if done:
                yield rows_of(done)
        if row is not None:
            yield rows_of([closed()])

    return stream.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position from 0, edit (keep, rerole or insert), role, text."""
    stream = _streamed(rows, plans(rows))
    id_type = dict(stream.dtypes)["conv_id"]

    def run(batches):
        now = writer = None
        position = 0
        for batch in batches:
            out = {"conv_id": [], "position": [], "edit": [], "role": [], "text": []}

            def put(turns, out=out) -> None:
                nonlocal position
                for turn in turns:
                    for name, value in zip(out, (now, position, *turn), strict=True):
                        out[name].append(value)
                    position += 1

            for r in batch.to_pylist():
                if r["kind"] == 0:
                    if writer:
                        put(writer.end())
                    now, writer, position = r["conv_id"], _Writer(r["audit"]), 0
                else:
                    for _ in range(r["copies"]):
                        put(writer.row(r["role"], r["text"]))
            kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))
        if writer:
            last = list(writer.end())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([now] * len(last), kinds[0]),
                    pa.array(range(position, position + len(last)), pa.int64()),
                    *[pa.array([t[i] for t in last], pa.string()) for i in range(3)],
                ],
                list(out),
            )

    return stream.mapInArrow(run, f"conv_id {id_type}, position long, edit string, role string, text string")


def repair(conversations: DataFrame, *, damage: bool = False) -> DataFrame:
    """Row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, NULL first; those of one turn by role and the hash of their text, so the
    result does not depend on how rows are dealt.  A row's first fault counts: blank (only white
    space), duplicate (role and text seen earlier in the conversation), truncated (its last character is no
    full stop, question or exclamation mark).  NULL roles and texts are one space.  A role counts by its
    first character; an empty one fits nowhere.  `gaps` are turns missing between the least and the
    greatest.  Rows with a NULL conv_id are one conversation.  Repeated rows are duplicates.  Other
    columns are ignored; no rows give no rows.
    """
    return digests(damaged_rows(conversations) if damage else plain_rows(conversations))


# The same in SQL, going forward: over the same rows, no equally cheap audit begins another.
ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT i AS n, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v::BIGINT ORDER BY n) AS t FROM bits WHERE k = 8),
named AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(2) c(copy) WHERE kind != 0 AND (copy = 0 OR kind = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         left(role, 1) AS first,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM damaged),
rows AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, first, blank,
         NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) = 1 AND cut AS cut,
         lag(first) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
convs AS MATERIALIZED (SELECT DISTINCT conv_id FROM conversations),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows GROUP BY conv_id),
-- states: 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant
gap(s, t, cost, letters) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
                                    (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
keep(s, first, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
move AS MATERIALIZED (
  SELECT conv_id, i, gap.s, m.t, gap.cost + m.cost AS cost, letters || letter AS letters
  FROM rows JOIN gap ON true, LATERAL (
    SELECT gap.t AS t, 3 AS cost, 'D' AS letter
    UNION ALL SELECT keep.t, cut::INT, 'K' FROM keep WHERE keep.s = gap.t AND keep.first = rows.first AND NOT blank AND NOT again
    UNION ALL SELECT CASE gap.t WHEN 2 THEN 3 ELSE 2 END, 2 + cut::INT, 'R' WHERE NOT blank AND NOT again) m),
way AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, (0::BIGINT, '') AS best FROM convs
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.t, min((w.best[1] + m.cost, w.best[2] || m.letters))
  FROM way w JOIN move m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1 AND m.s = w.s
  GROUP BY w.conv_id, w.i + 1, m.t),
ends AS (
  SELECT w.conv_id, min((w.best[1] + gap.cost, w.best[2] || gap.letters)) AS best
  FROM way w JOIN gap ON gap.s = w.s AND gap.t IN (0, 3) LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.i = coalesce(f.n, 0) GROUP BY w.conv_id),
letters AS (SELECT conv_id, unnest(string_split(best[2], '')) AS letter, unnest(range(len(best[2]))) AS pos FROM ends WHERE best[2] != ''),
placed AS (
  SELECT *, count(*) FILTER (letter != 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i,
         count(*) FILTER (letter != 'D') OVER (PARTITION BY conv_id ORDER BY pos) - 1 AS place FROM letters),
turns AS (
  SELECT p.conv_id, p.place, p.letter, r.role, CASE WHEN letter = 'I' THEN '' ELSE r.text END AS text,
         bool_or(p.place = 0 AND letter = 'K' AND r.first = 's') OVER (PARTITION BY p.conv_id) AS led
  FROM placed p LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i WHERE letter != 'D'),
made AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - led::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || text, chr(10) ORDER BY place) AS told FROM turns GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best[1]::BIGINT AS cost, best[2] AS audit,
       sha256(coalesce(told, '')) AS repaired_sha256
FROM convs c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN made m ON c.conv_id IS NOT DISTINCT FROM m.conv_id
"""
