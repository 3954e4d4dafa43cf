import random
import resource

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helio.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "<|ENDOFTEXT|>", "<|StartOfText|> hi", "a <|STARTOFTEXT|> b", "<|endoftext|>", "<|startoftext|>x", "᫃۬", "Ᲊ", "֋ǝ", "೜ڠ", "İ", "Σ",
    "ΑΣ", "ﬁ", "é", "ẛ̣", "'S", "'ll", "don't", "1234", "a\x00b\x7f", "\x1c\x1d", " ", "　", "​", " ", "\n", "the", "日本", "🙂", "<|", "|>",
]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


def differing(library, texts):
    found = bpe.Codec(PATH).encode(texts)
    return [
        t
        for t, (ids, said), e in zip(texts, found, library.encode_batch(texts, add_special_tokens=False), strict=True)
        if np.frombuffer(ids, "<u4").tolist() != e.ids or said != library.decode(e.ids, skip_special_tokens=False)
    ]


def test_equals_the_library_on_odd_texts(library):
    pick = random.Random(1)

    def letter():
        point = pick.choice([pick.randrange(0x20, 0x250), pick.randrange(0x250, 0x3000), pick.randrange(0x3000, 0x11000), pick.randrange(0x110000)])
        return chr(point) if not 0xD800 <= point < 0xE000 else "x"

    texts = ODD + ["".join(pick.choice(ODD) for _ in range(pick.randint(0, 8))) for _ in range(4000)]
    texts += ["".join(letter() if pick.random() < 0.7 else pick.choice(" aB'1.") for _ in range(pick.randint(0, 10))) for _ in range(6000)]
    assert differing(library, texts) == []


def test_other_spellings_of_special_tokens_are_text():
    (ids, _), (token, _) = bpe.Codec(PATH).encode(["<|ENDOFTEXT|>", "<|endoftext|>"])
    assert np.frombuffer(ids, "<u4").tolist() == [27, 347, 40786, 4160, 91, 285]
    assert np.frombuffer(token, "<u4").tolist() == [49407]


def test_one_long_word_beside_rare_ones_needs_little_memory(library):
    pick = random.Random(2)
    words = ["".join(pick.choice("qxzjkvwab") for _ in range(9)) for _ in range(10_000)]
    text = " ".join([*words, "".join(pick.choice("abcdefghij") for _ in range(100_000))])
    own = bpe.Codec(PATH)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (ids, _) = next(own.encode([text]))
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 * 1024
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_rows_merge_as_grids_do(monkeypatch):
    pick = random.Random(3)
    own = bpe.Codec(PATH)
    rows = [own._symbols("".join(pick.choice("thesingaro") for _ in range(pick.randint(1, 60))), True) for _ in range(400)]
    assert own.merged(rows) == [own._merged_long(r) for r in rows]
    monkeypatch.setattr(bpe, "GRID_CELLS", 50)
    assert own.merged(rows) == [own._merged_long(r) for r in rows]


def test_caches_that_overflow(library, monkeypatch):
    for name in ("CACHE_CHUNKS", "CACHE_WORDS", "CACHE_PAIRS"):
        monkeypatch.setattr(bpe, name, 20)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 200)
    pick = random.Random(4)
    words = ["".join(pick.choice("abcde") for _ in range(pick.randint(1, 5))) for _ in range(150)]
    assert differing(library, [" ".join(pick.choice([*words, *ODD]) for _ in range(20)) for _ in range(200)]) == []
