"""Conversation structure repair: the cheapest edits by a lightest-derivation agenda."""

from __future__ import annotations

import hashlib
import heapq
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.session import materialise

# What the roles before a place allow next.  Repaired initials read (s?(ua)+)?
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
        (AFTER_A, "u"): AFTER_U}
#: The role a rerole or an insertion brings, and the state after it.
NEXT = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
GOALS = (START, AFTER_A)

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SOUND, BLANK, DUPLICATE, CUT = "-bdt"

BLOCK = 256                 # rows of one agenda; longer conversations are joined from blocks
MEMO = 100_000              # shapes of conversations a worker remembers; then it starts anew
HELD_ROWS = 4_096           # a conversation with more rows, or
HELD_CHARS = 8_000_000      # more text, is not held by a task: its segments are

Weight = tuple[int, str]    # cost, audit: compared in this order
Table = dict[tuple[int, int], Weight]


def lightest(shape: str, start: int, goals: tuple[int, ...] = tuple(range(4)), wanted: int = 4) -> dict[int, Weight]:
    """The lightest derivations of ``wanted`` goal states after the rows of ``shape``, two letters a row: initial, fault.

    Items are (rows read, state).  Deductions extend an item by one edit, adding its cost and appending its initial:
    superior functions, monotone in (cost, audit), so the item popped first from the agenda is final.  The goals are
    final when popped; nothing behind the last of them is explored.
    """
    rows = len(shape) // 2
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    while agenda and len(found) < wanted:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == rows and state in goals:
            found[state] = (cost, audit)
        after = NEXT[state][1]
        if (at, after) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, after))
        if at == rows:
            continue
        initial, fault = shape[2 * at], shape[2 * at + 1]
        heapq.heappush(agenda, (cost + DELETE, audit + "D", at + 1, state))
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED if fault == CUT else 0
        heapq.heappush(agenda, (cost + REROLE + extra, audit + "R", at + 1, after))
        kept = KEEP.get((state, initial))
        if kept is not None:
            heapq.heappush(agenda, (cost + extra, audit + "K", at + 1, kept))
    return found


def table_of(shape: str) -> Table:
    """Lightest derivations from every state to every state over a shape; long ones are joined from blocks."""
    stack: list[tuple[int, Table]] = []
    for i in range(0, len(shape), 2 * BLOCK):
        block = shape[i:i + 2 * BLOCK]
        _push(stack, 1, {(p, q): w for p in range(4) for q, w in lightest(block, p).items()})
    return _folded(stack)


def joined(left: Table, right: Table) -> Table:
    """Deduction over two neighbouring spans: from p to r and from r to q gives p to q.

    Derivations of one span and cost never are prefixes of each other (another length means another number of
    insertions), so appending keeps their order.
    """
    out: Table = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                more, rest = right[r, q]
                old = out.get((p, q))
                if old is None or cost + more < old[0] or cost + more == old[0] and audit + rest < old[1]:
                    out[p, q] = (cost + more, audit + rest)
    return out


def _push(stack: list[tuple[int, Table]], size: int, table: Table) -> None:
    """Spans on the stack at least halve in size, so a text is copied a logarithmic number of times."""
    while stack and stack[-1][0] <= size:
        before, left = stack.pop()
        size, table = before + size, joined(left, table)
    stack.append((size, table))


def _folded(stack: list[tuple[int, Table]]) -> Table:
    """All spans of the stack as one; of no spans, the way from each state to itself."""
    if not stack:
        return {(p, p): (0, "") for p in range(4)}
    _, table = stack.pop()
    while stack:
        table = joined(stack.pop()[1], table)
    return table


def best(table: Table) -> Weight:
    """The lightest repair of a whole conversation."""
    return min(table[START, q] for q in GOALS if (START, q) in table)


def repair(shape: str, known: dict[str, Weight] | None = None) -> Weight:
    """Cost and audit of the cheapest repair; of equal costs, the least audit.  Shapes met before are looked up."""
    found = known.get(shape) if known is not None else None
    if found is None:
        if len(shape) <= 2 * BLOCK:
            found = min(lightest(shape, START, GOALS, 1).values())
        else:
            found = best(table_of(shape))
        if known is not None and len(shape) <= 2 * BLOCK:
            if len(known) >= MEMO:
                known.clear()
            known[shape] = found
    return found


class Repaired:
    """Hashes a repaired conversation while its rows pass, so it is never held."""

    def __init__(self, audit: str):
        self.edits, self.at, self.state = audit, 0, START
        self.hash, self.empty = hashlib.sha256(), True

    def _line(self, line: str) -> None:
        self.hash.update((line if self.empty else "\n" + line).encode())
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            role, self.state = NEXT[self.state]
            self._line(f"{role}:")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEP[self.state, role[:1]]
        elif edit == "R":
            role, self.state = NEXT[self.state]
        else:
            return
        self._line(f"{role}:{text}")

    def done(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, present``: the rows after damage by ``crc32(conv:turn) % 20``.

    Nulls count as one blank in the key and as role and text.  0 drops the row (it stays with ``present`` false, so
    that no dialogue is lost), 1 empties the text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 sets the role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), blank).alias("role"),
                        F.coalesce(F.col(text), blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (fate != 0).alias("present"), F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))\
        .drop("col")


def _faults(rows: DataFrame) -> DataFrame:
    """Adds the rows' faults.  Rows seen earlier are found by the first turn of each (dialogue, role, text).

    That is an aggregate, combined before its shuffle, joined back: a text that most turns of a hot dialogue have is
    one row of the small side, and the large side of such a key may be split.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    same = ["conv_id", "role", "hash"]
    rows = rows.withColumn("hash", F.md5(F.col("text").cast("binary")))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.where("present").groupBy(*same).agg(F.min(order).alias("first")).select(
        *[F.col(c).alias(f"{c}_") for c in same], "first")
    met = rows.join(firsts, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in same], "left")
    later = F.when(F.col("present"), ~F.col("first").eqNullSafe(order)).otherwise(False)
    return met.select("conv_id", "turn", "role", "text", "present", "hash", blank.alias("blank"), later.alias("later"),
                      (~whole).alias("cut"))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows in order of dialogue, turn, role and text; a dialogue with most of the rows lies in many partitions."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("hash")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


class _Segment:
    """What a run of a dialogue's rows adds up to; neighbouring runs add up again."""

    NAMES = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None            # turns
        self.first = self.last = None          # initials
        self.first_key = self.last_key = None  # turn, role, text: repeated rows are duplicates
        self.shape: list[str] = []

    def row(self, turn: int | None, role: str, digest: str, blank: bool, later: bool, cut: bool) -> None:
        key, initial = (turn, role, digest), role[:1]
        fault = BLANK if blank else DUPLICATE if later or key == self.last_key else CUT if cut else SOUND
        self.shape.append((initial or "-") + fault)
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        if self.rows:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first, self.first_key = initial, key
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last, self.last_key = initial, key
        self.rows += 1

    def add(self, other: _Segment) -> None:
        """Counts of the run behind this one; shapes are joined apart from them."""
        if not other.rows:
            return
        if self.rows:
            self.illegal += self.last + other.first not in ("su", "ua", "au")
            self.turns -= other.low is not None and other.low == self.high
        for name in self.NAMES:
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        self.last, self.last_key = other.last, other.last_key

    def result(self, weight: Weight, sha: str) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, weight[0], weight[1], sha)


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_DONE, _SEGMENT, _ROW = range(3)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_RESULTS = [f.split()[0] for f in RESULT.split(", ")]


def _batches(rows: Iterator[dict], schema: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some MB; the dialogue's id comes first and is a number or a string."""
    kinds = [f.split() for f in schema.split(", ")]
    out, held = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], _TYPES.get(k, pa.int64())) for n, k in kinds],
                                          [n for n, _ in kinds])

    for row in rows:
        out.append(row)
        held += 500 + len(row.get("text") or "") + len(row.get("segment") or b"") + len(row.get("audit") or "")
        if held >= size:
            yield batch()
            out, held = [], 0
    if out:
        yield batch()


class _Open:
    """The dialogue a task is reading: held whole while it is small, and as a segment otherwise."""

    def __init__(self, conv, part: int, crossing: bool, known: dict[str, Weight], held_rows: int):
        self.conv, self.part, self.known, self.held_rows = conv, part, known, held_rows
        self.crossing = crossing               # rows of it may lie in the partition before
        self.segment, self.stack, self.held, self.chars, self.seq = _Segment(), [], [], 0, 0

    def add(self, turn, role: str, text: str, *facts) -> Iterator[dict]:
        self.segment.row(turn, role, *facts)
        self.held.append((role, text))
        self.chars += len(text)
        if self.crossing or len(self.held) > self.held_rows or self.chars > HELD_CHARS:
            self.crossing = True
            yield from self._release()

    def _release(self) -> Iterator[dict]:
        """Hands the held rows on and folds their shape."""
        for role, text in self.held:
            yield {"conv_id": self.conv, "kind": _ROW, "part": self.part, "seq": self.seq, "role": role, "text": text}
            self.seq += 1
        self.held, self.chars = [], 0
        if len(self.segment.shape) >= BLOCK:
            self._fold()

    def _fold(self) -> None:
        if self.segment.shape:
            _push(self.stack, len(self.segment.shape), table_of("".join(self.segment.shape)))
            self.segment.shape = []

    def close(self, last: bool) -> Iterator[dict]:
        if self.crossing or last:
            yield from self._release()
            self._fold()
            yield {"conv_id": self.conv, "kind": _SEGMENT, "part": self.part, "seq": 0,
                   "segment": pickle.dumps((self.segment, _folded(self.stack)))}
            return
        weight = repair("".join(self.segment.shape), self.known)
        repaired = Repaired(weight[1])
        for role, text in self.held:
            repaired.row(role, text)
        yield {"conv_id": self.conv, "kind": _DONE,
               **dict(zip(_RESULTS, self.segment.result(weight, repaired.done())))}


def _scanned(batches: Iterator[pa.RecordBatch], held_rows: int) -> Iterator[dict]:
    """Dialogues that end within the partition are done; its first and last, and large ones, are handed on."""
    part, known, now = TaskContext.get().partitionId(), {}, None
    for batch in batches:
        columns = [batch.column(n) for n in ("conv_id", "present", "turn", "role", "text", "hash", "blank", "later", "cut")]
        for conv, present, *row in zip(*([v.as_py() for v in c] for c in columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from now.close(False)
                now = _Open(conv, part, now is None, known, held_rows)
            if present:
                yield from now.add(*row)
    if now is not None:
        yield from now.close(True)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Dialogues handed on, in order: segments first, which give the repair, then the rows, which are only hashed."""
    conv, total, stack, repaired, weight = None, None, [], None, None

    def closed():
        found = weight or best(_folded(stack))
        return {"conv_id": conv, **dict(zip(_RESULTS, total.result(found, (repaired or Repaired(found[1])).done())))}

    for batch in batches:
        columns = [batch.column(n) for n in ("conv_id", "kind", "role", "text", "segment")]
        for key, kind, role, text, raw in zip(*([v.as_py() for v in c] for c in columns)):
            if total is None or key != conv:
                if total is not None:
                    yield closed()
                conv, total, stack, repaired, weight = key, _Segment(), [], None, None
            if kind == _SEGMENT:
                segment, table = pickle.loads(raw)
                total.add(segment)
                if segment.rows:
                    _push(stack, segment.rows, table)
                continue
            if repaired is None:
                weight = best(_folded(stack))
                repaired = Repaired(weight[1])
            repaired.row(role, text)
    if total is not None:
        yield closed()


def repair_structure(turns: DataFrame, *, held_rows: int = HELD_ROWS) -> DataFrame:
    """One row per dialogue: ``conv_id`` and ``RESULT``, from ``conv_id, turn, role, text, present``.

    Rows are taken by turn (nulls first), role and text; ``present`` is false for rows that only name their dialogue.
    A row's first fault counts: blank, duplicate (role and text seen earlier), truncated.  ``cost`` and ``audit`` are
    those of the lightest repair, ``repaired_sha256`` is of its ``role:text`` lines.  ``gaps`` are turn numbers
    missing between the least and the largest (0 where all are null).  Without rows: zeros, an empty audit, the hash
    of nothing.  Null dialogue ids are one dialogue, a null role or text is one blank.

    The order is dealt by range, so a dialogue with most of the rows lies in many tasks: each gives the table of
    lightest ways through its segment (16 letters a row at most) and neighbouring tables are joined.  Only the hash
    of such a dialogue's repaired text is one after the other, in one task that holds no text; its audit, a letter a
    row, is one value of the result and lies in that task's memory.
    """
    blank = F.lit(" ")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
                        F.coalesce("text", blank).alias("text"), F.coalesce("present", F.lit(True)).alias("present"))
    kind = {"string": "string"}.get(rows.schema["conv_id"].dataType.simpleString(), "long")
    rows = _sorted(_faults(rows.withColumn("conv_id", F.col("conv_id").cast(kind))))
    wide = f"conv_id {kind}, kind int, part int, seq long, role string, text string, segment binary, {RESULT}"
    slim = f"conv_id {kind}, {RESULT}"
    stored = materialise(rows.mapInArrow(lambda batches: _batches(_scanned(batches, held_rows), wide), wide), "dialogues")
    rest = stored.where(F.col("kind") != _DONE).select("conv_id", "kind", "part", "seq", "role", "text", "segment") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "seq")
    finished = rest.mapInArrow(lambda batches: _batches(_finished(batches), slim), slim)
    return stored.where(F.col("kind") == _DONE).select("conv_id", *_RESULTS).unionByName(finished)
