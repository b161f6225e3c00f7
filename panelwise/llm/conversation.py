"""Faults of conversations, and their cheapest repair by iterative-deepening A*.

A conversation is a sequence of turns; whole ones read ``(s?(ua)+)?`` in the initials
of their roles.  Edits keep a turn (K), give it the role user or assistant (R), delete
it (D) or insert an empty turn (I).  The search goes depth first, tries edits in the
order of their letters, cuts what the bound cannot pay for, remembers which states
failed with how much left, and raises the bound until a path is accepted.  That first
path is the cheapest, and of the cheapest the least in ASCII order.

The search sees one letter per turn.  Conversations of many turns are searched in
segments, from each state to each, and the segments' answers are chained from the end;
two paths over a segment's turns never are one the beginning of the other, so the
chained answer is the same.  Rows of long conversations are never brought together:
positions, faults and edits of theirs are tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.llm.common import fresh, whole
from panelwise.operators.ordering import with_position
from panelwise.session import broadcast_if_small, materialize

#: Conversations above either are worked on as tables, others by one task each.
LONG_ROWS, LONG_BYTES = 10_000, 16 << 20
#: Turns that are searched at once, and that travel together in a long conversation.
SEGMENT, CHUNK = 48, 4_096

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1

SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
#: States are the role before: none, system, user, assistant.
NONE, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_BEFORE = {SYSTEM: AFTER_SYSTEM, USER: AFTER_USER, ASSISTANT: AFTER_ASSISTANT}
_ALLOWED = {NONE: (SYSTEM, USER), AFTER_SYSTEM: (USER,), AFTER_USER: (ASSISTANT,), AFTER_ASSISTANT: (USER,)}
#: The role that an insertion or a new role has in each state.
_NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}


def letter(role: int, fault: int) -> str:
    return chr(65 + 4 * role + fault)


def _read(letters: str) -> list[tuple[int, int]]:
    return [divmod(ord(c) - 65, 4) for c in letters]


def _bounds(turns: list[tuple[int, int]], final: bool) -> list[tuple[int, ...]]:
    """Least cost from each turn on, for each state before it.

    Deletions that must be, additions for truncated turns, roles that fit nowhere, and two
    for each of as many neighbours as can be picked apart that may not follow each other.
    """
    bad = {(a, b) for a in range(3) for b in range(3)} - {(0, 1), (1, 2), (2, 1)}
    own, first = 0, None
    if final:
        bad |= {(SYSTEM, "end"), (USER, "end")}
        first = "end"
    free = [0, 0]  # picked from the first survivor on, and from the second on
    out = []

    def states() -> tuple[int, ...]:
        found = []
        for state in range(4):
            before = state - 1 if state else None
            clash = first is not None and ((before, first) in bad or (before is None and first == ASSISTANT))
            found.append(own + max(free[0], 2 + free[1] if clash else 0))
        return tuple(found)

    out.append(states())
    for role, fault in reversed(turns):
        if fault >= DUPLICATE:
            own += COST[DELETE]
        else:
            own += TRUNCATED_COST * (fault == TRUNCATED) + COST[REROLE] * (role == OTHER)
            here = max(free[0], 2 + free[1] if (role, first) in bad else 0)
            free, first = [here, free[0]], role
        out.append(states())
    return out[::-1]


@lru_cache(maxsize=50_000)
def _search(letters: str, start: int, goal: int | None) -> tuple[int, str] | None:
    """Cost and edits from a state over all turns to the state ``goal``, None if there are none.

    Without a goal the path must be accepted, and turns may be inserted after the last.
    """
    turns = _read(letters)
    n, final = len(turns), goal is None
    if goal in (NONE, AFTER_SYSTEM):  # nothing leads there but a kept system turn
        if goal == start:
            return COST[DELETE] * n, DELETE * n
        if goal == NONE or start != NONE or all(role != SYSTEM or fault >= DUPLICATE for role, fault in turns):
            return None
    least = _bounds(turns, final)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def visit(at: int, state: int, left: int) -> int:
        """0 if a path was found, else how much more the bound needs at least."""
        if at == n and (state == goal if not final else state in (NONE, AFTER_ASSISTANT)):
            return 0
        missing = least[at][state] - left
        if missing > 0:
            return missing
        if failed.get((at, state), -1) >= left:
            return 1
        need = 1 << 30
        role, fault = turns[at] if at < n else (OTHER, FINE)
        extra = TRUNCATED_COST * (fault == TRUNCATED)
        for edit in (DELETE, INSERT, KEEP, REROLE):
            if edit == INSERT:
                if at == n and not final:
                    continue
                step, after, cost = at, _BEFORE[_NEXT[state]], COST[INSERT]
            elif at == n or (edit != DELETE and fault >= DUPLICATE):
                continue
            elif edit == DELETE:
                step, after, cost = at + 1, state, COST[DELETE]
            elif edit == KEEP:
                if role not in _ALLOWED[state]:
                    continue
                step, after, cost = at + 1, _BEFORE[role], extra
            else:
                step, after, cost = at + 1, _BEFORE[_NEXT[state]], COST[REROLE] + extra
            if cost > left:
                need = min(need, cost - left)
                continue
            path.append(edit)
            short = visit(step, after, left - cost)
            if short == 0:
                return 0
            need = min(need, short)
            path.pop()
        failed[at, state] = max(left, failed.get((at, state), -1))
        return need

    bound, most = least[0][start], COST[DELETE] * n + 2 * COST[INSERT] + TRUNCATED_COST
    while bound <= most:
        short = visit(0, start, bound)
        if short == 0:
            return bound, "".join(path)
        bound += short
    return None


def cheapest_edits(letters: str) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, the least in ASCII order of several."""
    cuts = list(range(0, len(letters), SEGMENT)) or [0]
    rest: list[int | None] = []
    chosen: list[list[tuple[str, int] | None]] = []
    for at in reversed(cuts):
        part, costs, ways = letters[at : at + SEGMENT], [], []
        for state in range(4):
            if not chosen:
                found = _search(part, state, None)
                costs.append(found[0])
                ways.append((found[1], NONE))
                continue
            options = []
            for goal in range(4):
                found = _search(part, state, goal) if rest[goal] is not None else None
                if found is not None:
                    options.append((found[0] + rest[goal], found[1], goal))
            best = min(options) if options else None
            costs.append(best and best[0])
            ways.append(best and best[1:])
        rest = costs
        chosen.append(ways)
    state, edits = NONE, []
    for ways in reversed(chosen):
        text, state = ways[state]
        edits.append(text)
    return rest[NONE], "".join(edits)


def count_illegal(letters: str) -> int:
    """Neighbours whose roles may not follow each other."""
    roles = [role for role, _ in _read(letters)]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))


def repaired(letters: str, edits: str) -> list[tuple[str, int | None, int | None]]:
    """(edit, number of the turn or None, new role or None) of every edit."""
    turns, state, at, out = _read(letters), NONE, 0, []
    for edit in edits:
        if edit == INSERT:
            out.append((edit, None, _NEXT[state]))
            state = _BEFORE[_NEXT[state]]
            continue
        role = _NEXT[state] if edit == REROLE else None
        if edit != DELETE:
            state = _BEFORE[turns[at][0] if role is None else role]
        out.append((edit, at, role))
        at += 1
    return out


def damage(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str = "dropped"
) -> DataFrame:
    """The rows damaged by crc32 of ``conv:turn`` modulo 20; nulls there and in role and text are one space.

    0 marks the row in ``dropped``, 1 empties its text, 2 takes ``.!?`` out of it, 3 gives
    the row twice, 4 makes the role user.  Other columns stay; one named ``dropped`` is replaced.
    """
    roll, copy = fresh(rows, "roll", "copy")
    spaced = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)]
    marked = rows.withColumn(roll, F.crc32(F.concat_ws(":", *spaced)) % 20)
    new = {
        role: F.when(F.col(roll) == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`"), F.lit(" "))),
        text: F.when(F.col(roll) == 1, "")
        .when(F.col(roll) == 2, F.translate(F.coalesce(F.col(f"`{text}`"), F.lit(" ")), ".!?", ""))
        .otherwise(F.coalesce(F.col(f"`{text}`"), F.lit(" "))),
        dropped: F.col(roll) == 0,
    }
    twice = marked.withColumns(new).withColumn(copy, F.explode(F.when(F.col(roll) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.drop(roll, copy)


def _letters(role: Column, text: Column) -> Column:
    """The letter of a turn, as far as the turn alone tells it."""
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(FINE)
    )
    return (65 + 4 * kind + fault).cast("int")


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str, dropped: str | None) -> DataFrame:
    gone = F.col(f"`{dropped}`") if dropped else F.lit(False)
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), whole(F.col(f"`{role}`")).alias("role"),
        whole(F.col(f"`{text}`")).alias("text"), F.coalesce(gone, F.lit(False)).alias("gone"),
    )
    return named.withColumn("code", _letters(F.col("role"), F.col("text")))


_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ORDER = ["turn", "role", "text"]  # ascending, nulls first


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str | None = None
) -> DataFrame:
    """One row per conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Turns stand in the order of ``turn``, nulls first, then role and text.  Rows with
    ``dropped`` count for nothing but the conversation being there; one without other rows
    has zeros, no edits and the digest of nothing.  Null roles and texts are empty, an empty
    role fits nowhere; null conversations are one.  Each row's first fault counts: blank,
    duplicate (role and text of an earlier row), truncated (the last visible character is none
    of ``.!?``).  ``gaps`` are numbers missing among the turns.
    """
    turns = _turns(rows, conv, turn, role, text, dropped)
    long, turns, many = _long_ones(turns)
    schema = T.StructType([turns.schema["conv"], *T.StructType.fromDDL(_FOUND).fields])
    placed = turns.repartition("conv").sortWithinPartitions("conv", *_ORDER)
    out = placed.mapInArrow(_repair_each, schema)
    if long:
        out = out.unionByName(_repair_long(many).audits)
    return out.withColumnRenamed("conv", conv)


def repaired_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str | None = None
) -> DataFrame:
    """(conv, place, edit, role, text): the turns of the repaired conversations; deleted ones are not there."""
    turns = _turns(rows, conv, turn, role, text, dropped)
    long, turns, many = _long_ones(turns)
    schema = T.StructType([turns.schema["conv"], *T.StructType.fromDDL("place long, edit string, role string, text string").fields])
    out = turns.repartition("conv").sortWithinPartitions("conv", *_ORDER).mapInArrow(_turns_of_each, schema)
    if long:
        out = out.unionByName(_repair_long(many).turns)
    return out.withColumnRenamed("conv", conv)


def _long_ones(turns: DataFrame) -> tuple[bool, DataFrame, DataFrame]:
    """Whether there are long conversations, the rows of the others, and theirs."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    long = sizes.filter((F.col("rows") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv").alias("long"))
    long = broadcast_if_small(long)
    if not long.take(1):
        return False, turns, turns
    same = F.col("conv").eqNullSafe(F.col("long"))
    return True, turns.join(long, same, "left_anti"), turns.join(long, same, "left_semi")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its rows as (turn, role, text, code)) of rows sorted by conversation."""
    conv, rows, begun = None, [], False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "code", "gone")]
        for key, turn, role, text, code, gone in zip(*columns):
            if not begun or key != conv:
                if begun:
                    yield conv, rows
                conv, rows, begun = key, [], True
            if not gone:
                rows.append((turn, role, text, code))
    if begun:
        yield conv, rows


def _read_turns(rows: list[tuple]) -> str:
    seen, letters = set(), []
    for _, role, text, code in rows:
        fault = (code - 65) % 4
        if fault != BLANK and (role, text) in seen:
            code += DUPLICATE - fault
        seen.add((role, text))
        letters.append(chr(code))
    return "".join(letters)


def _lines(rows: list[tuple], letters: str, edits: str) -> Iterator[tuple[str, str, str]]:
    for edit, at, role in repaired(letters, edits):
        if edit != DELETE:
            old = rows[at] if at is not None else (None, "", "")
            yield edit, NAMES[role] if role is not None else old[1], old[2]


def _repair_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind, out = None, []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv").type
            yield batch

    for conv, rows in _groups(watched()):
        letters = _read_turns(rows)
        cost, edits = cheapest_edits(letters)
        faults = [fault for _, fault in _read(letters)]
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in _lines(rows, letters, edits)).encode()).hexdigest()
        counts = [faults.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)]
        out.append((conv, gaps, *counts, count_illegal(letters), cost, edits, digest))
        if len(out) == 5_000:
            yield flush()
            out.clear()
    if out:
        yield flush()


def _turns_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv").type
            yield batch

    for conv, rows in _groups(watched()):
        letters = _read_turns(rows)
        lines = list(_lines(rows, letters, cheapest_edits(letters)[1]))
        if lines:
            edit, role, text = (pa.array(c, pa.string()) for c in zip(*lines))
            place = pa.array(range(len(lines)), pa.int64())
            columns = [pa.array([conv] * len(lines), kind), place, edit, role, text]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "place", "edit", "role", "text"])


class _Long:
    """Audits and turns of conversations whose rows no task holds together."""

    def __init__(self, audits: DataFrame, turns: DataFrame):
        self.audits, self.turns = audits, turns


def _repair_long(rows: DataFrame) -> _Long:
    """As for short conversations; each step's groups are chunks of rows, or letters of one conversation.

    One letter per turn is what the audit of a conversation has too, so gathering those
    is bounded by a row of the result.  The digest of a conversation runs over its
    sorted lines, a batch at a time.
    """
    lone = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = materialize(with_position(lone, "conv", *_ORDER, "tie", name="pos").drop("tie"), "turns")
    same = F.sha2(F.concat_ws("\x00", "role", "text"), 256)
    live = placed.filter(~F.col("gone")).withColumn("same", same)
    first = live.groupBy(F.struct("conv", "same").alias("which")).agg(F.min("pos").alias("earliest"))
    known = live.join(first, F.struct("conv", "same") == F.col("which"))
    again = (F.col("pos") > F.col("earliest")) & ((F.col("code") - 65) % 4 != BLANK)
    fault = (F.col("code") - 65) % 4
    coded = known.withColumn("code", F.when(again, F.col("code") - fault + DUPLICATE).otherwise(F.col("code")))
    coded = materialize(coded.select("conv", "turn", "pos", "code", (F.floor(F.col("pos") / CHUNK)).alias("chunk")), "codes")
    chunks = coded.groupBy("conv", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: F.chr(x["code"])), "").alias("part"),
    )
    texts = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "part"))).alias("parts"))
    field = rows.schema["conv"]
    schema = T.StructType([field, *T.StructType.fromDDL("chunk long, edits string, illegal long, cost long, at long").fields])
    found = materialize(texts.mapInArrow(_search_long, schema), "edits")

    live_fault = (F.col("code") - 65) % 4
    counts = [F.count_if(live_fault == k).alias(n) for k, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))]
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    there = placed.groupBy("conv").agg(F.lit(1).alias("there"))
    stats = coded.groupBy("conv").agg(span.cast("long").alias("gaps"), *counts)
    edits = found.groupBy("conv").agg(
        F.max("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "edits"))), lambda x: x["edits"]), "").alias("audit"),
    )

    split = found.select("conv", "chunk", "at", F.posexplode(F.expr("regexp_extract_all(edits, '(?s)I*(?:[DKR]|$)', 0)")).alias("k", "edit"))
    split = split.filter("edit <> ''").select("conv", "chunk", "k", "edit", (F.col("at") + F.col("k")).alias("nth"))
    ranked = live.select("conv", "pos", "role", "text", F.floor(F.col("pos") / CHUNK).alias("chunk"))
    lows = ranked.groupBy("conv", "chunk").agg(F.array_sort(F.collect_list("pos")).alias("places"))
    where = lows.select("conv", "chunk", F.posexplode("places").alias("k", "pos"))
    both = _joined(_joined(split, where, "conv", "chunk", "k"), ranked.drop("chunk"), "conv", "pos")
    lines = both.repartition("conv").sortWithinPartitions("conv", "nth").mapInArrow(
        _lines_long, T.StructType([field, *T.StructType.fromDDL("place long, edit string, role string, text string").fields])
    )
    digested = materialize(lines, "lines")
    digests = digested.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(
        _digest, T.StructType([field, T.StructField("repaired_sha256", T.StringType())])
    )
    audits = there.select("conv")
    for part in (stats, edits, digests):
        audits = _joined(audits, part, "conv", how="left")
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    audits = audits.fillna(zeros | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return _Long(audits.select(*names), digested)


def _joined(left: DataFrame, right: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """A join in which null equals null; the keys are the left side's."""
    other = right.select(*[F.col(k).alias(f"right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys]
    return left.join(other, same, how).drop(*[f"right_{k}" for k in keys])


def _search_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each conversation, dealt to its chunks; those after the last turn go to the last chunk."""
    for batch in batches:
        for conv, parts in zip(batch.column("conv"), batch.column("parts").to_pylist()):
            letters = "".join(p["part"] for p in parts)
            cost, edits = cheapest_edits(letters)
            illegal, at, spot, rows = count_illegal(letters), 0, 0, []
            for k, part in enumerate(parts):
                start, left = spot, len(part["part"])
                while left:
                    left -= edits[spot] != INSERT
                    spot += 1
                if k == len(parts) - 1:
                    spot = len(edits)
                rows.append((part["chunk"], edits[start:spot], illegal, cost, at))
                at += len(part["part"])
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            keys = pa.array([conv.as_py()] * len(rows), batch.schema.field("conv").type)
            yield pa.RecordBatch.from_arrays([keys, *columns], names=["conv", "chunk", "edits", "illegal", "cost", "at"])


def _lines_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of repaired conversations from rows sorted by conversation and place; only the state is held."""
    conv, begun, state, place = None, False, NONE, 0
    initials = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
    for batch in batches:
        out = []
        for key, edits, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text"))):
            if not begun or key != conv:
                conv, begun, state, place = key, True, NONE, 0
            for edit in edits:
                if edit == DELETE:
                    continue
                number = initials[role[0]] if edit == KEEP else _NEXT[state]
                line = ("", NAMES[number]) if edit == INSERT else (text, role if edit == KEEP else NAMES[number])
                out.append((key, place, edit, line[1], line[0]))
                state, place = _BEFORE[number], place + 1
        if out:
            kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "place", "edit", "role", "text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which arrive in order."""
    conv, digest, kind = None, None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if digest is None or key != conv:
                if digest is not None:
                    yield row()
                conv, digest = key, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
    if digest is not None:
        yield row()
