"""Conversation repair against plain dynamic programming over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from millrace.llm import conversations
from millrace.llm.plans import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, gaps string, audit string, absent boolean"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_report(rows):
    """Every state after every row with cheapest cost and least audit, insertions by relaxing until nothing changes."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    def inserted(states):
        for _ in range(4):
            for q, (cost, audit, made) in list(states.items()):
                role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[q]
                new = (cost + 3, audit + "I", made + [f"{role}:"])
                states[role[0]] = min(states.get(role[0], new), new)
        return states

    states = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for q, (cost, audit, made) in states.items():
            expected = {"": "user", "s": "user", "u": "assistant", "a": "user"}[q]
            ways = [(q, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                ways.append((expected[0], 3 + more, "R", [f"{expected}:{text}"]))
                if role[:1] == expected[0] or (q == "" and role[:1] == "s"):
                    ways.append((role[0], more, "K", [f"{role}:{text}"]))
            for to, c, letter, line in ways:
                new = (cost + c, audit + letter, made + line)
                after[to] = min(after.get(to, new), new)
        states = inserted(after)
    cost, audit, made = min(states[q] for q in ("", "a") if q in states)
    turns = {t for _, t, _, _ in rows if t is not None}
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(made).encode()).hexdigest(),
    )


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def random_rows(rng, conv, n):
    rows = []
    for turn in range(n):
        role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "User", "ufo"])
        text = rng.choice(["Yes.", "no", "What?", "", " \n", None, "Done!  ", "x", f"word {turn}.", f"word {turn}"])
        rows.append((conv, rng.choice([turn, turn, turn + 3, None, 5]), role, text))
    return rows


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damage = by_conversation(plain_damage(rows))
    want = {conv: plain_report(damage.get(conv, [])) for conv in by_conversation(rows)}
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"].run(spark, SF).collect()}
    assert got == want


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(1)
    rows = [r for conv in range(150) for r in random_rows(rng, conv, rng.randint(0, 14))]
    rows += random_rows(rng, None, 30) + random_rows(rng, 900, 700) + rows[:40]
    rows += [(901, 1, "user", "same.")] * 300 + [(902, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(600)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("whole_rows,part_rows,fan", [(2000, 256, 15), (5, 4, 2), (0, 8, 15), (20, 64, 1)])
def test_reports_whole_and_in_parts(spark, mixed, monkeypatch, whole_rows, part_rows, fan):
    monkeypatch.setattr(conversations, "PART_ROWS", part_rows)
    monkeypatch.setattr(conversations, "FAN_BITS", fan)
    frame = spark.createDataFrame([(*r, "x", "y", None) for r in mixed], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_conversations(frame, whole_rows=whole_rows).collect()}
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in mixed]
    want = {conv: plain_report(rows) for conv, rows in by_conversation(filled).items()}
    assert got == want
    turns = conversations.repaired_turns(frame, whole_rows=whole_rows).collect()
    lines = by_conversation(sorted((tuple(r) for r in turns), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2])))
    for conv in want:
        made = [f"{r[4]}:{r[5]}" for r in lines.get(conv, [])]
        assert hashlib.sha256("\n".join(made).encode()).hexdigest() == want[conv][-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[4][0] for r in lines.get(conv, [])))


def test_damage_and_awkward_tables(spark):
    rng = random.Random(2)
    rows = [r for conv in [*range(60), None] for r in random_rows(rng, conv, rng.randint(1, 6))]
    frame = spark.createDataFrame([(*r, "x", "y", None) for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_conversations(conversations.damaged(frame), absent_col="absent").collect()}
    damage = by_conversation(plain_damage(rows))
    assert got == {conv: plain_report(damage.get(conv, [])) for conv in by_conversation(rows)}
    gone = spark.createDataFrame([(1, 1, "user", "a.", "x", "y", True), (None, 1, "user", "a.", "x", "y", True)], SCHEMA)
    empty_hash = hashlib.sha256(b"").hexdigest()
    got = conversations.repair_conversations(gone, absent_col="absent").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((c, 0, 0, 0, 0, 0, 0, "", empty_hash)) for c in (1, None))
    assert conversations.repair_conversations(frame.where("false")).count() == 0
    assert conversations.repaired_turns(frame.where("false")).count() == 0
    assert conversations.repair_conversations(conversations.damaged(frame.where("false")), absent_col="absent").count() == 0


def test_search_on_random_signatures():
    rng = random.Random(4)
    texts = {"d": "", "up": "no", "low": "yes."}
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for _ in range(3000):
        signature = "".join(rng.choice("suaxSUAXduaua") for _ in range(rng.randint(0, 9)))
        rows = [
            (1, i, roles.get(c.lower(), "tool"), texts["d"] if c == "d" else f"{i} {texts['up' if c.isupper() else 'low']}")
            for i, c in enumerate(signature)
        ]
        assert conversations.cheapest_edits(signature) == plain_report(rows)[5:7]
