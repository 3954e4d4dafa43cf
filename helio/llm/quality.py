"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain. Expectation-maximisation over the counts
of all vote patterns estimates how each labeller votes on good and on bad text; the posterior
labels of a bounded sample train a hashed linear scorer, which judges every text.

Defined cases: a text without a word (null, empty, blank) scores 0 and is rejected; equal texts
score alike; labels given with the corpus are never read; without a learnable sample the
labellers' posterior is the score.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import Words, blocks, byte_values, put_back, set_aside, table, utf8

BAD, GOOD, ABSTAIN = 0, 1, 2
#: Distinct texts that train the linear scorer, at most.
SAMPLE_TEXTS = 2500
MIN_WORDS = 8
#: A bad vote on good text is at most this times as likely as on bad text; the same for good votes.
CHANCE = {BAD: 0.05, GOOD: 0.9}
ROUNDS, STEPS, RATE, SHRINK = 60, 300, 0.05, 1e-4

#: Classes of bytes; letters outside ASCII count as lower case.
KINDS = ["abc", "ABC", "0123456789", " \t\r\v\f", "\n", ".,", "!?;:'\"-()", "|", "#*", "$%&@^~", "<>{}[]=+/\\_`"]
_KIND = np.full(256, len(KINDS), dtype=np.int64)
for _i, _chars in enumerate(KINDS):
    _KIND[[ord(c) for c in _chars]] = _i
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[128:] = 0
N_KINDS = len(KINDS) + 1
N_TRIPLES = N_KINDS**3
REPEAT_BUCKETS = 12
BUCKETS = 1024

_VALUES = byte_values(11)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

#: Figures of which a high value is bad: bad from there; a lower one says nothing.
HIGH_IS_BAD = {
    "symbols": 0.04,
    "separators": 0.10,
    "repeats": 0.20,
    "capitals": 0.30,
    "digits": 0.30,
    "markup": 0.05,
    "top_word": 0.30,
}
#: Figures of which a low value is bad: bad up to, good from.
LOW_IS_BAD = {"stops": (0.015, 0.05), "letters": (0.55, 0.75)}
LABELLERS = [*HIGH_IS_BAD, *LOW_IS_BAD]
VOTED = T.StructType([T.StructField("pattern", T.LongType()), T.StructField("n_words", T.LongType())])
SAMPLED = T.StructType([T.StructField("x", T.ArrayType(T.FloatType())), T.StructField("pattern", T.LongType())])
SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("posterior", T.DoubleType()),
        T.StructField("n_bad_votes", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)


class Figures:
    """What labellers and the scorer look at, for each text of a block."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, _BLANK, _VALUES)
        n, owner = len(texts), np.repeat(np.arange(len(texts)), np.diff(w.offsets))
        kinds = _KIND[w.flat]
        counts = np.bincount(owner * N_KINDS + kinds, minlength=n * N_KINDS).reshape(n, N_KINDS)
        counts[:, 4] -= 1  # the newline after each text
        triple = (kinds[:-2] * N_KINDS + kinds[1:-1]) * N_KINDS + kinds[2:]
        inside = owner[:-2] == owner[2:]
        self.triples, self.triple_text = triple[inside], owner[:-2][inside]
        self.n_words = np.diff(w.first)
        text = np.repeat(np.arange(n), self.n_words)
        same = np.zeros(len(text))
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (text[1:] == text[:-1])
        words = np.maximum(self.n_words, 1)
        size = np.maximum(counts.sum(axis=1), 1)
        letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
        top = np.zeros(n)
        for i in range(n):
            part = w.hashes[w.first[i] : w.first[i + 1]]
            if len(part):
                part = np.sort(part)
                cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                top[i] = np.diff(np.append(cuts, len(part))).max()
        self.n = n
        self.value = {
            "symbols": (counts[:, 8] + counts[:, 9]) / size,
            "separators": counts[:, 7] / words,
            "repeats": np.bincount(text, weights=same, minlength=n) / words,
            "capitals": counts[:, 1] / letters,
            "digits": counts[:, 2] / size,
            "markup": counts[:, 10] / size,
            "top_word": top / words,
            "stops": (counts[:, 5] + counts[:, 6]) / words,
            "letters": (counts[:, 0] + counts[:, 1]) / np.maximum(size - counts[:, 3] - counts[:, 4], 1),
        }

    def votes(self) -> np.ndarray:
        """n x labellers; short texts get no verdict."""
        out = np.full((self.n, len(LABELLERS)), ABSTAIN)
        for j, (name, bad) in enumerate(HIGH_IS_BAD.items()):
            out[:, j] = np.where(self.value[name] >= bad, BAD, ABSTAIN)
        for j, (name, (bad, good)) in enumerate(LOW_IS_BAD.items(), len(HIGH_IS_BAD)):
            v = self.value[name]
            out[:, j] = np.where(v <= bad, BAD, np.where(v >= good, GOOD, ABSTAIN))
        out[self.n_words < MIN_WORDS] = ABSTAIN
        return out

    def features(self) -> np.ndarray:
        """n x buckets: shares of byte-class triples by hash, and a mark for the share of repeats."""
        width = BUCKETS - REPEAT_BUCKETS
        cells = self.triple_text * width + (self.triples * 40503) % width
        x = np.bincount(cells, minlength=self.n * width).reshape(self.n, width).astype(np.float32)
        x = np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))
        marks = np.zeros((self.n, REPEAT_BUCKETS), dtype=np.float32)
        marks[np.arange(self.n), np.minimum(self.value["repeats"] * 20, REPEAT_BUCKETS - 1).astype(int)] = 1
        return np.hstack([x * 4, marks])


def pack(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1], dtype=np.int64))


def unpack(patterns: np.ndarray) -> np.ndarray:
    return (np.asarray(patterns)[:, None] // 3 ** np.arange(len(LABELLERS), dtype=np.int64)) % 3


@dataclass
class Labelling:
    """The share of good text, and for each class and labeller how often it votes what."""

    good: float
    table: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        each = np.log(self.table)[:, np.arange(votes.shape[1]), votes]
        each = np.where(votes == ABSTAIN, 0.0, each).sum(axis=2)
        z = each[GOOD] - each[BAD] + np.log(self.good) - np.log1p(-self.good)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def accuracies(self) -> dict[str, float]:
        """How often a labeller that votes is right."""
        p = np.array([1 - self.good, self.good])
        right = p[BAD] * self.table[BAD, :, BAD] + p[GOOD] * self.table[GOOD, :, GOOD]
        voted = (p[:, None] * (self.table[:, :, BAD] + self.table[:, :, GOOD])).sum(axis=0)
        return dict(zip(LABELLERS, (right / voted).tolist(), strict=True))


def estimate(votes: np.ndarray, counts: np.ndarray) -> Labelling:
    """Expectation-maximisation over distinct vote patterns with their counts."""
    q = np.where((votes == BAD).any(axis=1), 0.1, 0.95)
    model = Labelling(0.9, np.full((2, votes.shape[1], 3), 1 / 3))
    for _ in range(ROUNDS):
        weight = np.stack([(1 - q) * counts, q * counts])
        table = np.stack([[weight @ (votes[:, j] == v) for v in range(3)] for j in range(votes.shape[1])])
        table = table.transpose(2, 0, 1) + 0.5
        table = table / table.sum(axis=2, keepdims=True)
        # what keeps the classes from changing places: labellers beat chance, most text is good
        table[GOOD, :, BAD] = np.minimum(table[GOOD, :, BAD], CHANCE[BAD] * table[BAD, :, BAD])
        table[BAD, :, GOOD] = np.minimum(table[BAD, :, GOOD], CHANCE[GOOD] * table[GOOD, :, GOOD])
        model = Labelling(float(np.clip(weight[1].sum() / max(counts.sum(), 1), 0.8, 0.99)), table)
        q = model.posterior(votes)
    return model


def fit_linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels with equal weight of both classes; the bias is last."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    share = y / max(y.sum(), 1e-9) + (1 - y) / max((1 - y).sum(), 1e-9)
    mean = y / max(y.sum(), 1e-9) / share
    w, m, v = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ ((p - mean) * share) + SHRINK * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


@dataclass
class Model:
    labelling: Labelling
    linear: np.ndarray | None = field(default=None)


def _voted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        data = utf8(texts)
        parts = [pd.DataFrame({"pattern": [], "n_words": []}, dtype="int64")]
        for lo, hi in blocks(data):
            f = Figures(data[lo:hi])
            parts.append(pd.DataFrame({"pattern": pack(f.votes()), "n_words": f.n_words}))
        yield pd.concat(parts, ignore_index=True)


def _sampled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        data, x, patterns = utf8(texts), [], []
        for lo, hi in blocks(data):
            f = Figures(data[lo:hi])
            x += list(f.features().astype(np.float32))
            patterns += pack(f.votes()).tolist()
        yield pd.DataFrame({"x": pd.Series(x, dtype=object), "pattern": np.array(patterns, dtype=np.int64)})


vote = F.pandas_udf(_voted, VOTED)
#: Features and votes in one function: two would hold two Python workers for each task.
sampled = F.pandas_udf(_sampled, SAMPLED)


def learn(docs: DataFrame, text: str = "text") -> Model:
    """Vote patterns of all texts are counted by Spark: 3 ** labellers rows at most reach the driver."""
    texts = docs.select(F.col(text).alias("text")).where("text is not null")
    counted = (
        texts.select(vote("text").alias("v"), F.xxhash64("text").alias("h"))
        .groupBy("v.pattern")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("d"))
        .toPandas()
        .sort_values("pattern")
    )
    if not len(counted):
        return Model(Labelling(0.9, np.full((2, len(LABELLERS), 3), 1 / 3)))
    votes, n = unpack(counted["pattern"].to_numpy()), counted["n"].to_numpy(dtype=float)
    labelling = estimate(votes, n)
    bound = min(1.0, 0.8 * SAMPLE_TEXTS / max(1.0, float(counted["d"].sum())))
    sample = (
        texts.withColumn("h", F.xxhash64("text"))
        .where(F.col("h").bitwiseAND(F.lit((1 << 32) - 1)) < int(bound * (1 << 32)))
        .groupBy("h")
        .agg(F.min("text").alias("text"))
        .select("h", sampled("text").alias("s"))
        .select("h", "s.*")
        .toPandas()
        .sort_values("h")
        .head(SAMPLE_TEXTS)
    )
    if len(sample) < 2:
        return Model(labelling)
    x = np.vstack(sample["x"].to_numpy()).astype(np.float32, copy=False)
    y = labelling.posterior(unpack(sample["pattern"].to_numpy()))
    if y.max() < 0.5 or y.min() > 0.5:
        return Model(labelling)
    return Model(labelling, fit_linear(x, y))


def scorer(model: Model):
    """A pandas function from texts to the probability that they are good, and what labellers say."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            data = utf8(texts)
            parts = [pd.DataFrame({k: [] for k in SCORED.names})]
            for lo, hi in blocks(data):
                f = Figures(data[lo:hi])
                votes = f.votes()
                weak = model.labelling.posterior(votes)
                if model.linear is None:
                    p = weak
                else:
                    z = f.features() @ model.linear[:-1] + model.linear[-1]
                    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                p = np.where(f.n_words > 0, p, 0.0)
                parts.append(
                    pd.DataFrame(
                        {"score": p, "posterior": weak, "n_bad_votes": (votes == BAD).sum(axis=1), "n_words": f.n_words}
                    )
                )
            out = pd.concat(parts[1:] or parts, ignore_index=True)
            yield out.astype({"n_bad_votes": "int64", "n_words": "int64", "score": "float64", "posterior": "float64"})

    return F.pandas_udf(score, SCORED)


def judge(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the struct ``quality``, in place of a column of that name."""
    return docs.withColumn("quality", scorer(model)(F.col(text)))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged."""
    return put_back(judge(set_aside(docs), learn(docs)).where(F.col("quality.score") >= threshold), docs)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, learn(docs)).select(
        "doc_id", "quality.*", (F.col("quality.score") >= 0.5).alias("kept")
    )
