"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its hashed words, a
document's the noisy-or of its sentences, so that document labels alone train the sentence scorer,
which then locates the sentences at fault.

Defined cases: a null, empty or wordless text has no sentence and scores 0; equal texts score
alike; learning rows with a null label or text are left out; without a learning row of each kind
every text scores 0.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import Words, blocks, byte_values, fold, table, utf8

#: Labelled texts to learn from, at most, by label; longer texts are not learnt from.
SAMPLE = {1: 2000, 0: 5000}
SAMPLE_CHARS = 20_000
BITS = 18
#: A word has a weight if so many of the learning texts hold it and toxic ones clearly more often:
#: the likelihood ratio statistic of both shares against one is at least MIN_GAIN.
MIN_TEXTS, MIN_GAIN = 3, 12.0
STEPS, RATE, SHRINK = 200, 0.1, 1e-3
FIRST_BIAS = -4.0

_VALUES = byte_values(7)
_SEPARATORS = np.ones(256, dtype=bool)
_SEPARATORS[65:91] = _SEPARATORS[97:123] = _SEPARATORS[128:] = False
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)
RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("n_sentences", T.LongType()),
        T.StructField("offending", FOUND),
    ]
)


@dataclass
class Model:
    weights: np.ndarray
    bias: float


class Bags:
    """Words of a block of texts as feature numbers, with the sentences that they lie in."""

    def __init__(self, texts: list[bytes]):
        self.words = w = Words(texts, _SEPARATORS, _VALUES)
        self.features = (w.hashes >> np.uint64(64 - BITS)).astype(np.int32)
        ends = np.flatnonzero(_ENDS[w.flat])
        number = np.searchsorted(ends, w.starts)
        new = np.ones(len(number), dtype=bool)
        new[1:] = number[1:] != number[:-1]
        #: For each sentence with a word: its first word, then its end in bytes and its text.
        self.first = np.flatnonzero(new)
        self.ends = ends[number[self.first]] if len(self.first) else self.first
        self.text = np.searchsorted(w.offsets, w.starts[self.first], side="right") - 1
        self.sentence = np.cumsum(new) - 1


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _telling(pairs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """For each feature whether it tells toxic texts; ``pairs``: each text's features, once each."""
    feature, text = pairs & ((1 << BITS) - 1), pairs >> BITS
    held = np.stack([np.bincount(feature[labels[text] == y], minlength=1 << BITS) for y in (1, 0)]).astype(float)
    total = np.array([[labels.sum()], [(1 - labels).sum()]])
    both = held.sum(axis=0) / total.sum()

    def fit(share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-12, 1 - 1e-12)
        return (held * np.log(share) + (total - held) * np.log(1 - share)).sum(axis=0)

    gain = 2 * (fit(held / total) - fit(np.broadcast_to(both, held.shape)))
    more = held[0] / total[0] > held[1] / total[1]
    return (held.sum(axis=0) >= MIN_TEXTS) & more & (gain >= MIN_GAIN)


def train(texts: list[str], labels: np.ndarray) -> Model | None:
    """Fit the sentence scorer to document labels by full-batch gradient ascent (Adam)."""
    labels = np.asarray(labels, dtype=float)
    if not len(labels) or labels.min() == labels.max():
        return None
    features, sentence, text = [], [], []
    n_sentences, data = 0, utf8(texts)
    for lo, hi in blocks(data):
        bags = Bags(data[lo:hi])
        features.append(bags.features)
        sentence.append(bags.sentence + n_sentences)
        text.append(bags.text + lo)
        n_sentences += len(bags.text)
    f, s, t = np.concatenate(features), np.concatenate(sentence), np.concatenate(text)
    if not len(f):
        return None
    keep = _telling(np.unique(t[s].astype(np.int64) << BITS | f), labels)[f]
    if not keep.any():
        return None
    names, f = np.unique(f[keep], return_inverse=True)
    s = s[keep]
    w, bias = np.zeros(len(names)), FIRST_BIAS
    state = [np.zeros(len(names) + 1), np.zeros(len(names) + 1)]
    share = np.full(len(labels), 1 / len(labels))
    for step in range(1, STEPS + 1):
        p = _sigmoid(np.bincount(s, weights=w[f], minlength=n_sentences) + bias)
        none = np.exp(np.bincount(t, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(labels)))
        pull = np.where(labels > 0, none / np.maximum(1 - none, 1e-9), -1.0) * share
        slope = pull[t] * p
        grad = np.append(np.bincount(f, weights=slope[s], minlength=len(names)), slope.sum())
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-6)
        w = w + move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - SHRINK, 0)
        bias += move[-1]
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[names] = w
    return Model(weights, float(bias))


def learn(
    rows: DataFrame, text: str = "text", label: str = "label", labels: DataFrame | None = None, doc_id: str = "doc_id"
) -> Model | None:
    """Fit to a bounded sample of labelled texts: of each label those with the smallest hashes.

    Labels are a column of ``rows``, or of the table ``labels`` by ``doc_id``. They meet hashes only;
    texts are fetched for the sample alone, whose list has at most SAMPLE hashes of each label.
    """
    usable = rows.where(F.length(text) <= SAMPLE_CHARS).withColumn("h", F.xxhash64(text))
    if labels is None:
        hashed = usable.select(F.col(label).alias("label"), "h")
    else:
        marks = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
        hashed = usable.select(F.col(doc_id).alias("id"), "h").join(marks, "id").select("label", "h")
    hashed = hashed.where(F.col("label").isin(0, 1)).distinct()
    ratio = {r["label"]: SAMPLE[r["label"]] / r["n"] for r in hashed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(ratio) < 2:
        return None
    # hashes are uniform, so those below a bound are a sample of about the size that is wanted
    bound = {k: int(min(1.0, 0.9 * v) * (1 << 32)) for k, v in ratio.items()}
    low = F.col("h").bitwiseAND(F.lit((1 << 32) - 1))
    some = hashed.where(F.when(F.col("label") == 1, low < bound[1]).otherwise(low < bound[0])).toPandas()
    some = some.sort_values(["label", "h"])
    chosen = pd.concat([some[some["label"] == k].head(n) for k, n in sorted(SAMPLE.items())])
    wanted = rows.sparkSession.createDataFrame(chosen[["h"]].drop_duplicates(), "h long")
    texts = usable.select("h", F.col(text).alias("text"))
    found = texts.join(F.broadcast(wanted), "h").groupBy("h").agg(F.min("text").alias("text")).toPandas()
    sample = chosen.merge(found, on="h").sort_values(["label", "h"])
    return train(sample["text"].tolist(), sample["label"].to_numpy())


def _positions(flat: np.ndarray) -> np.ndarray:
    """For each byte the number of code points that start before it."""
    starts = (flat & 0xC0) != 0x80
    return np.cumsum(starts) - starts


def scorer(model: Model | None, threshold: float = 0.5):
    """A pandas function from texts to score, number of sentences and offending sentences."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            data = utf8(texts)
            scores, counts = np.zeros(len(data)), np.zeros(len(data), dtype=np.int64)
            found: list[list[dict]] = [[] for _ in data]
            for lo, hi in blocks(data) if model else ():
                bags = Bags(data[lo:hi])
                if not len(bags.first):
                    continue
                z = np.add.reduceat(model.weights[bags.features].astype(float), bags.first)
                p = _sigmoid(z + model.bias)
                none = np.bincount(bags.text, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=hi - lo)
                scores[lo:hi] = -np.expm1(none)
                counts[lo:hi] = np.bincount(bags.text, minlength=hi - lo)
                guilty = np.flatnonzero(p >= threshold)
                if len(guilty):
                    at = _positions(bags.words.flat)
                    for g in guilty:
                        i, start = bags.text[g], bags.words.starts[bags.first[g]]
                        base = at[bags.words.offsets[i]]
                        found[lo + i].append(
                            {"start": int(at[start] - base), "end": int(at[bags.ends[g]] - base), "score": float(p[g])}
                        )
            yield pd.DataFrame({"score": scores, "n_sentences": counts, "offending": found})

    return F.pandas_udf(score, RESULT)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = learn(docs.where(~F.col("held_out")), labels=labels)
    scored = docs.withColumn("toxicity", scorer(model)("text"))
    return scored.select(
        "doc_id",
        "held_out",
        "toxicity.score",
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        "toxicity.n_sentences",
        "toxicity.offending",
    )
