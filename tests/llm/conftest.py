import random

import pytest

WORDS = [a + b for a in ("ba", "ko", "li", "mu", "ne", "ru", "sa", "to", "vi", "zo") for b in ("", "n", "ra", "st", "lek", "mio")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


def rows():
    """Documents with copies, near copies, nulls, empty, blank and very long texts, and repeated rows."""
    texts = [prose(80, i) for i in range(30)]
    texts += [texts[3], texts[3], texts[4] + " end", "start " + texts[5], texts[6].upper()]
    texts += [None, "", " \n\t ", "one", "one two three", "one\ntwo", prose(6000, 99), "x" * 30_000, "é" * 300 + "\n" + "é" * 300]
    shared = "this line is in many of them\n"
    texts += [shared + prose(40, i) for i in (71, 72, 73)] + [shared.upper() + prose(40, 74)]
    passage = prose(70, 500)
    texts += [prose(50, i) + " " + passage + " " + prose(30, i + 7) for i in (81, 82, 83)]
    out = [(3 * i + 1, t, "ab"[i % 2], "s", 0) for i, t in enumerate(texts)]
    return [*out, out[2], (None, texts[8], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
