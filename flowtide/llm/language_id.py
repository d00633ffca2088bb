"""Language ID: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, all but letters becomes blank, and n-grams of one to three characters are
hashed to ``DIMENSIONS`` features. Inverse document frequencies are counted over all rows to learn
from. The weights are fitted with follow-the-regularised-leader under an elastic net, on up to
``SAMPLE`` rows of each language, the first by a hash of id and text. Every epoch trains in several tasks and
averages their states. A fifth of the sample is kept apart: on it one temperature is fitted that
makes the probabilities honest.

Prediction reads whole texts of any length, some megabytes of characters at a time. Null texts and
texts without a letter are ``und`` with score 0. Rows without a language are not learned from; if
there is none to learn from, every text is ``und``. Of equal probabilities the language first by name wins.
Repeated rows and ids count and are predicted each. Extra columns are carried along; one named like
an output is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm import common
from flowtide.llm.tokens import mix

DIMENSIONS, ORDERS, PIECE = 1 << 16, (1, 2, 3), 1 << 20
SAMPLE, EPOCHS, TASKS, SLICES = 1000, 3, 4, 16
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: bytes  # float32 of each feature
    weights: bytes  # float32, a row of each feature and one for the bias, a column of each language
    temperature: float


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each comes; both empty without a letter."""
    total = np.zeros(0, np.int64)
    text = (text or "").lower()
    letters, any_letter = _letters(), False
    for at in range(0, len(text), PIECE):
        # A piece also sees what the longest n-gram that begins in it needs.
        more = min(PIECE, len(text) - at)
        codes = np.frombuffer(text[at : at + PIECE + ORDERS[-1] - 1].encode("utf-32-le", "surrogatepass"), "<u4")
        known = letters[codes]
        any_letter = any_letter or bool(known[:more].any())
        codes = np.where(known, codes, 32).astype(np.uint64)
        found = []
        for n in ORDERS:
            m = min(more, len(codes) - n + 1)
            if m > 0:
                key = np.full(m, n, np.uint64)
                for i in range(n):
                    key = (key << np.uint64(21)) | codes[i : i + m]
                found.append(mix(key) >> np.uint64(48))
        piece = np.bincount(np.concatenate(found).astype(np.int64), minlength=DIMENSIONS)
        total = piece if not len(total) else total + piece
    if not any_letter:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    features = np.flatnonzero(total)
    return features, total[features]


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and TF-IDF values of length one; both empty without a letter."""
    features, n = counts(text)
    values = n * idf[features]
    return features, values / max(float(np.sqrt((values * values).sum())), 1e-12)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                features, _ = counts(text.as_py())
                seen[features] += 1
                docs += 1
        parts = np.split(seen, SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([docs] * SLICES, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["slice", "docs", "seen"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, np.int64) for b in group["seen"]], axis=0)
        return pd.DataFrame({"slice": group["slice"][:1], "docs": [group["docs"].sum()], "seen": [total.tobytes()]})

    schema = "slice int, docs long, seen binary"
    rows = texts.mapInArrow(run, schema).groupBy("slice").applyInPandas(add, schema).collect()  # a row of each slice
    rows.sort(key=lambda r: r.slice)
    if not rows:
        return np.zeros(DIMENSIONS, np.int64), 0
    return np.concatenate([np.frombuffer(r.seen, np.int64) for r in rows]), rows[0].docs


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that the state (z, n) stands for."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over (features, values, class), the bias being the last feature; changes z and n."""
    for features, values, label in rows:
        at, x = np.append(features, DIMENSIONS), np.append(values, 1.0)[:, None]
        w = leader(z[at], n[at])
        p = softmax((x * w).sum(axis=0))
        p[label] -= 1.0
        g = x * p
        step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - step * w
        n[at] += g * g


def _smallest(places: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` smallest different places of each language, with their rank.

    Places are hashes, so a bound taken from the number of different ones leaves about twice the sample to be ranked,
    however many rows a language has. Should it leave too few, all are ranked.
    """
    counted = common.stored_side(places.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")), "language-sizes")
    share = F.least(F.lit(1.0), 2.0 * (sample + 50) / F.greatest(F.col("n"), F.lit(1)))
    near = places.join(counted, "lang").filter(F.col("place").cast("double") <= -(2.0**63) + 2.0**64 * share)
    near = common.store(near.select("lang", "place").distinct(), "language-places")
    found = near.groupBy("lang").agg(F.count(F.lit(1)).alias("left")).join(counted, "lang")
    if not found.filter((F.col("left") < sample) & (F.col("n") > 2.0 * (sample + 50))).isEmpty():
        near = places.distinct()
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place")))
    return ranked.filter(F.col("rank") <= sample)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Learn from text and language of all rows with a language; ``key`` only picks the sample.

    Rows that are equal in key, text and language count as one in the sample.
    """
    place = F.xxhash64(F.lit(42), F.col(key), F.col(text))
    rows = rows.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), place.alias("place"))
    seen, docs = _document_frequencies(rows.select("text"))
    if not docs:
        return None
    idf = (np.log((1 + docs) / (1 + seen)) + 1).astype(np.float32)
    chosen = common.stored_side(_smallest(rows.select("lang", "place"), sample), "language-sample")
    taught = rows.join(chosen, ["lang", "place"]).groupBy("lang", "place", "rank").agg(F.first("text").alias("text"))
    taught = common.store(taught, "language-texts")
    languages = tuple(r.lang for r in taught.select("lang").distinct().orderBy("lang").collect())
    classes, k = {name: i for i, name in enumerate(languages)}, len(languages)
    dealt = taught.withColumn("part", F.when(F.col("rank") % 5 == 0, -1).otherwise(F.pmod(F.col("rank"), F.lit(TASKS)).cast("int")))

    def vectors(group: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, int]]:
        found = [(*vector(t, idf), classes[name]) for t, name in zip(group["text"], group["lang"], strict=True)]
        return [x for x in found if len(x[0])]

    def trainer(state: Broadcast, epoch: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def train(group: pd.DataFrame) -> pd.DataFrame:
            z, n = (x.copy() for x in state.value)
            group = group.sort_values(["rank", "lang"]).reset_index(drop=True)
            learn(vectors(group.iloc[np.random.default_rng(epoch).permutation(len(group))]), z, n)
            return pd.DataFrame({"z": [z.tobytes()], "n": [n.tobytes()]})

        return train

    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))
    for epoch in range(EPOCHS):
        state = taught.sparkSession.sparkContext.broadcast((z, n))
        states = dealt.filter("part >= 0").groupBy("part").applyInPandas(trainer(state, epoch), "z binary, n binary").collect()
        if states:  # a row of each of TASKS
            z, n = (np.mean([np.frombuffer(r[i]).reshape(-1, k) for r in states], axis=0) for i in (0, 1))
        state.unpersist()
    weights = leader(z, n).astype(np.float32)

    def logits(group: pd.DataFrame) -> pd.DataFrame:
        found = [(label, weights[DIMENSIONS] + values @ weights[features]) for features, values, label in vectors(group)]
        return pd.DataFrame({"label": [x for x, _ in found], "logits": [y.astype(float).tolist() for _, y in found]})

    held = dealt.filter("part < 0").groupBy("rank").applyInPandas(logits, "label int, logits array<double>").collect()  # a fifth of the sample
    return Model(languages, idf.tobytes(), weights.tobytes(), _temperature(held))


def _temperature(held: list) -> float:
    """The divisor of the logits under which the held labels are likeliest."""
    if not held:
        return 1.0
    labels, x = np.array([r.label for r in held]), np.array([r.logits for r in held])

    def loss(log_t: float) -> float:
        p = softmax(x / math.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, ratio = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


@cache
def _arrays(model: Model) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(model.idf, np.float32), np.frombuffer(model.weights, np.float32).reshape(DIMENSIONS + 1, -1)


def predict_text(text: str | None, model: Model | None) -> tuple[str, float]:
    if model is None:
        return UNKNOWN, 0.0
    idf, weights = _arrays(model)
    features, values = vector(text, idf)
    if not len(features):
        return UNKNOWN, 0.0
    p = softmax((weights[DIMENSIONS] + values @ weights[features]).astype(np.float64) / model.temperature)
    best = int(np.argmax(p))
    return model.languages[best], float(p[best])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns but the text, with ``lang_pred`` and ``score``."""
    others = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    rows = docs.select(F.col(text).alias("text"), *others)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict_text(t.as_py(), sent.value) for t in batch.column(0)]
            names, scores = pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], names, scores], schema.names)

    return rows.mapInArrow(run, schema)
