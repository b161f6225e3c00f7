from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from panelwise.llm import conversation

MOVES = {"": "u", "s": "u", "u": "a", "a": "u"}
KEEPS = {"": "su", "s": "u", "u": "a", "a": "u"}


def dearest_first(turns):
    """Cheapest edits of turns (initial, fault) by a table over all turns, states and strings."""
    best = {"": (0, "")}

    def inserted(table):
        table = dict(table)
        for _ in range(4):
            for state, (cost, text) in list(table.items()):
                new = (cost + 2, text + "I")
                table[MOVES[state]] = min(new, table.get(MOVES[state], new))
        return table

    for initial, fault in turns:
        step = {}
        for state, (cost, text) in inserted(best).items():
            extra = fault == "truncated"
            options = [(state, cost + 3, "D")]
            if fault not in ("blank", "duplicate"):
                options.append((MOVES[state], cost + 2 + extra, "R"))
                if initial in KEEPS[state]:
                    options.append((initial, cost + extra, "K"))
            for after, price, edit in options:
                new = (price, text + edit)
                step[after] = min(new, step.get(after, new))
        best = step
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def brute(rows, dropped=True):
    """Results of the query from (conv, turn, role, text) rows, in plain Python."""
    groups = {}
    for conv, turn, role, text in rows:
        mine = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        roll = zlib.crc32(key.encode()) % 20 if dropped else -1
        role, text = (" ", "")[not dropped] if role is None else role, (" ", "")[not dropped] if text is None else text
        if roll == 1:
            text = ""
        if roll == 2:
            text = re.sub("[.!?]", "", text)
        if roll == 4:
            role = "user"
        mine.extend([(turn, role, text)] * {0: 0, 3: 2}.get(roll, 1))
    out = []
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in mine:
            shown = re.sub("[\x20\x09-\x0d]", "", text)
            if not shown:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif shown[-1] not in ".!?":
                fault = "truncated"
            else:
                fault = ""
            seen.add((role, text))
            turns.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        cost, audit = dearest_first(turns)
        lines, state, at = [], "", 0
        for edit in audit:
            if edit == "I":
                state = MOVES[state]
                lines.append({"u": "user:", "a": "assistant:"}[state])
                continue
            if edit != "D":
                _, role, text = mine[at]
                if edit == "R":
                    role = {"u": "user", "a": "assistant"}[MOVES[state]]
                state = role[0]
                lines.append(f"{role}:{text}")
            at += 1
        known = [t for t, *_ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        counts = [sum(f == k for _, f in turns) for k in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=str)


FAULTS = {"": conversation.FINE, "truncated": conversation.TRUNCATED, "duplicate": conversation.DUPLICATE, "blank": conversation.BLANK}


def letters_of(turns):
    return "".join(conversation.letter("suax".index(i), FAULTS[f]) for i, f in turns)


def random_turns(rng, n):
    roles, faults = rng.choice(["suax", "ua", "a", "u", "s", "uuua", "sx"]), rng.choice([[""], ["", "truncated"], list(FAULTS)])
    return [(rng.choice(roles), rng.choice(faults)) for _ in range(n)]


@pytest.mark.parametrize("segment", [48, 3, 1])
def test_search_equals_the_table(segment, monkeypatch):
    monkeypatch.setattr(conversation, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(600):
        turns = random_turns(rng, rng.randint(0, 14))
        assert conversation.cheapest_edits(letters_of(turns)) == dearest_first(turns), turns


def test_long_search_equals_the_table():
    rng = random.Random(5)
    for size in (150, 400):
        for _ in range(4):
            turns = random_turns(rng, size)
            assert conversation.cheapest_edits(letters_of(turns)) == dearest_first(turns)


WORDS = ["Hello there.", "Yes!", "no end", "", "  \n", "What?  \n", "Ünï. ", "a.b"]


def conversations(rng):
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice([*WORDS, None, f"t{turn}."])))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, 2, "assistant", "Ho."), (500, None, None, None)]
    rows += [(600, 1, "user", "x " * 50_000 + "."), (600, 2, "assistant", "Same."), (600, 2, "assistant", "Same.")]
    rows += [(700, t % 40, "user" if t % 3 else "assistant", WORDS[t % 8]) for t in range(300)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv string, code string, pos int, gone string, copy int, dropped int, roll int"


@pytest.fixture(scope="module")
def rows(spark):
    given = conversations(random.Random(8))
    return given, spark.createDataFrame([(*r, "c", "d", 1, "g", 2, 3, 4) for r in given], SCHEMA)


def test_query_operator_on_odd_rows(spark, rows, many_partitions):
    given, table = rows
    got = conversation.repair(conversation.damage(table), dropped="dropped")
    assert sorted(map(tuple, got.collect()), key=str) == brute(given)
    assert got.columns[0] == "conv_id"
    nothing = conversation.damage(table.limit(0))
    assert conversation.repair(nothing, dropped="dropped").count() == 0
    assert set(nothing.columns) == set(table.columns)


def test_long_conversations_as_tables(rows, many_partitions, monkeypatch):
    given, table = rows
    monkeypatch.setattr(conversation, "CHUNK", 16)
    for limit in (0, 5, 100):
        monkeypatch.setattr(conversation, "LONG_ROWS", limit)
        got = conversation.repair(conversation.damage(table), dropped="dropped")
        assert sorted(map(tuple, got.collect()), key=str) == brute(given), limit


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    table = spark.createDataFrame([(1, turn, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    got = conversation.repair(conversation.damage(table), dropped="dropped").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_repaired_turns_are_whole(rows, limit, monkeypatch):
    _, table = rows
    monkeypatch.setattr(conversation, "LONG_ROWS", limit)
    audits = {r[0]: r for r in conversation.repair(table).collect()}
    turns = {}
    for r in sorted(conversation.repaired_turns(table).collect(), key=lambda r: r.place):
        turns.setdefault(r[0], []).append(r)
    for conv, row in audits.items():
        mine = turns.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in mine))
        assert [r.edit for r in mine] == [e for e in row.audit if e != "D"]
        text = "\n".join(f"{r.role}:{r.text}" for r in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == row.repaired_sha256


def test_query_equals_brute_force(spark):
    from panelwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = QUERIES["op12_conversation_repair"](spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in table.collect()])
