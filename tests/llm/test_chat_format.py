import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helio.llm import chat_format
from helio.llm.chat_format import CONTROLS, Turn, Windows, escape, escape_role, parsed, unescape, unescape_role
from helio.llm.packing import vocabulary

SCHEMA = "conv_id long, turn long, role string, text string"


def rows():
    pick = random.Random(3)
    parts = [*CONTROLS, "\\", "<", "[", "\n", "text ", "é🙂", "<|turn|", "|>", "%0A", "user"]
    out = []
    for c in range(60):
        turns = pick.randint(1, 25)
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else pick.choice(["user", "assistant", "assistant", "system", None, "a\nb", "<|end|>%"])
            text = pick.choice([None, "", "".join(pick.choice(parts) for _ in range(pick.randint(0, 30))), "word " * pick.randint(0, 90)])
            out.append((c, None if pick.random() < 0.03 else t * pick.choice([1, 1, 1, 1000]), role, text))
    out += [(None, 1, "assistant", "x"), (None, None, "system", "y"), (500, 0, "system", "alone")]
    out += [(501, 3 * i, "system" if i == 0 else "ua"[i % 2] + "ser" * (1 - i % 2), "w " * 30) for i in range(2000)]
    out += [(502, 0, "user", "word " * 5000), (502, 1, "assistant", "word " * 9000), (502, 2, "assistant", "end")]
    return [*out, *out[:30]]


def brute(data):
    groups = {}
    for c, t, role, text in data:
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, own in groups.items():
        own.sort()
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        out[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def made(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(7).withColumns({c: F.lit("own") for c in ("segment", "place", "of", "first", "window")})
    return chat_format.windows(frame, vocabulary(), budget=300, history=80).cache()


def test_reads_back_what_went_in(made):
    found = {int(r["conv_id"]) if r["conv_id"] else None: tuple(r)[1:5] for r in chat_format.digests(made).collect()}
    assert found == brute(rows())


def test_windows_keep_the_budget_the_system_turn_and_the_history(made):
    by_segment = {}
    for w in made.collect():
        by_segment.setdefault((w["conv_id"], w["segment"]), {})[w["window"]] = w
    lead = {c: t[0] for (c, _), ws in sorted(by_segment.items(), key=lambda x: (x[0][0] or "", x[0][1]), reverse=True) for t in [parsed(ws[0]["text"])]}
    several = 0
    for (c, _), ws in by_segment.items():
        assert sorted(ws) == list(range(len(ws)))
        told = []
        for k in range(len(ws)):
            w = ws[k]
            turns = parsed(w["text"])
            assert len(turns) == w["n_turns"] > w["n_repeated"] and (w["n_tokens"] > 300) == w["over_budget"]
            assert w["n_tokens"] == sum(chat_format.n_tokens(vocabulary(), r, t) for r, t in turns)
            new = turns[w["n_repeated"] :]
            # over the budget only where one new turn does not fit
            assert not w["over_budget"] or len(new) == 1 or (len(new) == 2 and w["n_repeated"] == 0)
            if k and lead[c][0] == "system":
                assert turns[0] == lead[c]
            history = turns[1 if k and lead[c][0] == "system" else 0 : w["n_repeated"]]
            if k:
                several += 1
                assert history == told[len(told) - len(history) :]
                assert sum(chat_format.n_tokens(vocabulary(), r, t) for r, t in history) <= 80
            assert [unescape(w["text"][a:b]) for a, b in zip(w["loss_from"], w["loss_to"], strict=True)] == [t for r, t in new if r == "assistant"]
            told += new
    assert several > 100


def test_long_conversation_is_spread_with_its_system_turn(made):
    own = made.where("conv_id = '501'").collect()
    assert len({w["segment"] for w in own}) == 2
    assert all(parsed(w["text"])[0][0] == "system" for w in own)
    assert sum(w["n_turns"] - w["n_repeated"] for w in own) == 2000


def test_windows_do_not_depend_on_batches():
    turns = [Turn("assistant" if i % 2 else "user", str(i), 3 + i * 7 % 40) for i in range(200)]
    whole, parts = Windows(100, 30), Windows(100, 30)
    for t in turns:
        whole.add(t)
    want = [*whole.cut(True)]
    got = []
    for t in turns:
        parts.add(t)
        got += parts.cut(False)
        assert len(parts.turns) < 60
    assert [*got, *parts.cut(True)] == want


def test_escapes_are_reversible():
    pick = random.Random(5)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "|turn|>", "|end|>", "%", "\n", "%0A", "%25", "x", "]"]
    for _ in range(5000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 8)))
        said = escape(text)
        assert unescape(said) == text and not any(c in said for c in CONTROLS)
        role = escape_role(text)
        assert unescape_role(role) == text and "\n" not in role and not any(c in role for c in CONTROLS)


def test_no_rows(spark):
    none = chat_format.windows(spark.createDataFrame([], SCHEMA), vocabulary())
    assert none.count() == 0 and chat_format.digests(none).count() == 0
