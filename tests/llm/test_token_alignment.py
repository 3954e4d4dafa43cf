import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from helio.llm import token_alignment
from helio.llm.bpe import byte_letters

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "the", " ", "  ", "\n", "\t", "é", "日本", "🙂", "▁", "<s>", "</s>", "<|endoftext|>", "<unk>", "<0x41>", " ", "　", "\x1c", "\0", "ab1", "'s", "ﬁ", "Å", " of", "\r\n"]


def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute(rows):
    """Whole texts encoded by the libraries, groups cut at the offsets where both end, one document after the other."""
    first, second = Tokenizer.from_file(FIRST), SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_letters())}
    names = {i: n for n, i in first.get_vocab().items()}
    docs, count, top = [], Counter(), defaultdict(int)
    for doc_id, text in rows:
        a, b, groups = [], [], []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            a_bytes = [bytes(back[c] for c in names[i]) for i in a]
            pieces = [second.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ends, b_ends = ends(a_bytes), ends(b_bytes)
                lo = 0
                for cut in sorted({*a_ends} & {*b_ends}):
                    groups.append(([i for i, e in zip(a, a_ends, strict=True) if lo < e <= cut], [i for i, e in zip(b, b_ends, strict=True) if lo < e <= cut]))
                    lo = cut
            else:
                a = b = []
        docs.append((doc_id, a, b, groups))
        count.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, a, b, groups in docs:
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        said = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        best = sum(count[p] == top[p[0]] for p in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases(docs):
    pick = random.Random(7)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 10_000]
    rows += [(1000 + i, "".join(pick.choice(ODD) for _ in range(pick.randint(0, 14)))) for i in range(400)]
    return [*rows, (9000, "x" * 3000), (9001, " " * 2500), (9002, "ab" * 1200 + " c"), (9003, " lead"), (9004, "trail "), (9005, "日本" * 400)]


@pytest.mark.parametrize("size", [500, 1 << 23])
def test_equals_brute_force(spark, cases, monkeypatch, size):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", size)
    frame = spark.createDataFrame(cases, "doc_id long, text string").repartition(3)
    # names that the operator uses itself
    frame = frame.withColumns({c: F.lit("own") for c in ("pair", "block", "count", "best", "n_a", "of", "place", "i", "t")})
    got = token_alignment.align(frame, FIRST, SECOND)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(cases)


def test_groups_and_counts(spark):
    frame = spark.createDataFrame([(1, "a b a", "k"), (2, None, "k"), (3, "a", "k")], "doc_id long, text string, token_groups string")
    got = {r["doc_id"]: r["token_groups"] for r in token_alignment.groups(frame, FIRST, SECOND).collect()}
    assert got[2] == "" and got[1] == ";".join([got[3], got[1].split(";")[1], got[3]])
    counts = token_alignment.pair_counts(token_alignment.blocks(frame, FIRST, SECOND))
    assert {(f"{r['a']}|{r['b']}", r["count"], r["best"]) for r in counts.collect()} == {(got[3], 2, True), (got[1].split(";")[1], 1, True)}


def test_large_group_is_expanded_in_steps(monkeypatch):
    own = token_alignment.Aligner(FIRST, SECOND)
    own.number("日本語テキスト🙂" * 30)
    own.learn()
    whole = own.arrays()
    monkeypatch.setattr(token_alignment, "STEP_LINKS", 3)
    other = token_alignment.Aligner(FIRST, SECOND)
    other.number("日本語テキスト🙂" * 30)
    other.learn()
    assert all((a == b).all() for a, b in zip(whole, other.arrays(), strict=True))
    assert int(whole[3].sum()) == int(whole[0][0, 3])


def test_intervals_that_overlap_in_any_order():
    starts, stops = token_alignment.np.array([4, 0, 2, 0, 6]), token_alignment.np.array([6, 2, 6, 4, 7])
    order, group = token_alignment.coalesce(starts, stops, token_alignment.np.array([0, 0, 0, 1, 1]))
    assert starts[order].tolist() == [0, 0, 2, 4, 6] and group.tolist() == [0, 0, 0, 0, 1]


def test_no_documents(none):
    assert token_alignment.align(none, FIRST, SECOND).count() == 0
