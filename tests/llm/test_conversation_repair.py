import hashlib
import random
from functools import lru_cache
from itertools import product
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from helio.llm import conversation_repair
from helio.llm.conversation_repair import EndingAutomaton

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
SPACE = " "


def damaged(conv, turn, role, text):
    conv, key_turn, role, text = (SPACE if x is None else x for x in (conv, turn, role, text))
    kind = crc32(f"{conv}:{key_turn}".encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = "".join(c for c in text if c not in ".!?")
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def cheapest(rows, faults):
    """Least (cost, audit) over all edits, each with the role initials it gives; insertions are tried twice at each place."""

    @lru_cache(maxsize=None)
    def best(at, roles, inserted):
        # of the roles given so far only the last and whether there are others matter
        found = []
        if at == len(rows):
            if roles == "" or roles[-1] == "a":
                found.append((0, "", ()))
        else:
            role, text = rows[at]
            fault = faults[at]
            found.append(add(3, "D", best(at + 1, roles, 0)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if fits(roles, role[:1]):
                    found.append(add(more, "K", best(at + 1, role[:1], 0), (role, text)))
                for new in ("user", "assistant"):
                    if fits(roles, new[0]):
                        found.append(add(2 + more, "R", best(at + 1, new[0], 0), (new, text)))
        if inserted < 2:
            for new in ("user", "assistant"):
                if fits(roles, new[0]):
                    found.append(add(2, "I", best(at, new[0], inserted + 1), (new, "")))
        found = [f for f in found if f]
        return min(found) if found else None

    def fits(roles, new):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[roles].find(new) >= 0 if new else False

    def add(cost, edit, rest, row=None):
        return (cost + rest[0], edit + rest[1], ((row,) if row else ()) + rest[2]) if rest else None

    return best(0, "", 0)


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).extend(damaged(*row))
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = cheapest([r[1:] for r in own], faults)
        assert legal("".join(r[:1] for r, _ in kept))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    pick = random.Random(11)
    texts = ["Yes.", "no", "Why? ", "\n", "", None, "é.!\t", "end! \x85", "a. b", "  "]
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", None, "User", "unknown"]
    rows = []
    for c in range(250):
        turn = pick.choice([0, 0, 5, -3])
        for _ in range(pick.randint(1, 9)):
            turn += pick.choice([1, 1, 1, 0, 2, 7])
            rows.append((c, None if pick.random() < 0.05 else turn, pick.choice(roles), pick.choice([*texts, f"text {pick.random()}."])))
    rows += [(None, t, r, "x.") for t, r in ((0, "user"), (None, "assistant"), (1, "user"))]
    rows += [(900, t, "su"[t % 2] + "x", f"{t}.") for t in range(300)] + rows[:20]
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations()


def test_equals_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    frame = frame.withColumns({c: F.lit("own") for c in ("copy", "n", "digest", "audit", "head", "seen", "fault", "cost", "gaps")})
    got = conversation_repair.repair(conversation_repair.damage(frame))
    found = sorted(((int(r[0]) if r[0] else None, *r[1:]) for r in got.collect()), key=str)
    assert found == brute(rows)


def test_repaired_rows_keep_their_order(spark, rows):
    damaged_rows = conversation_repair.damage(spark.createDataFrame(rows, SCHEMA))
    found = conversation_repair.audits(damaged_rows)
    fixed = conversation_repair.repaired_rows(damaged_rows, found).orderBy("conv_id", "place").collect()
    text = {}
    for r in fixed:
        text.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    want = {r[0]: r[-1] for r in brute(rows)}
    for c, lines in text.items():
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[int(c) if c else None]


def test_shared_endings_cost_what_single_ones_do():
    shared = EndingAutomaton()
    for signature in sorted(("".join(p) for n in range(5) for p in product("suaxoUA", repeat=n)), key=lambda s: s[::-1]):
        assert shared.read(signature) == EndingAutomaton().read(signature)


def test_node_is_made_once_for_a_common_ending(monkeypatch):
    made = []
    plain = EndingAutomaton._extend
    monkeypatch.setattr(EndingAutomaton, "_extend", lambda self, letter: (made.append(letter), plain(self, letter)))
    own = EndingAutomaton()
    for signature in ("uaua", "suaua", "Uaua"):
        own.read(signature)
    assert made == ["a", "u", "a", "u", "s", "U"]


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if crc32(f"7:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(7, turn, "user", "x.")], SCHEMA)
    (row,) = conversation_repair.repair(conversation_repair.damage(frame)).collect()
    assert tuple(row) == ("7", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation(spark):
    frame = spark.createDataFrame([(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(20_000)], SCHEMA)
    (row,) = conversation_repair.audits(conversation_repair.damage(frame)).collect()
    assert len(row["audit"]) > 19_000


def test_no_rows(spark):
    assert conversation_repair.repair(conversation_repair.damage(spark.createDataFrame([], SCHEMA))).count() == 0
