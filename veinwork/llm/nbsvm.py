"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of the n-grams that it holds: words, pairs of adjacent words,
byte triples, and whether any two, three or five adjacent words are one word repeated, all
hashed into BUCKETS places. Each indicator is scaled by its class log-count
ratio, and a linear hinge-loss model over the scaled indicators is fitted by dual coordinate
descent. A logistic curve fitted on rows left out of that fit turns margins into scores.

Fitting reads a bounded sample of labelled rows (FIT_ROWS, the first in a digest order of the
key), so the model's size and the driver's work do not grow with the corpus; scoring reads every
whole text in one pass without a shuffle.

Null and empty texts have no features and get the score of the bias. Labels that are null or
not 0 or 1 are not learned from. With no usable label of one class, every score is the share of
label 1 (0.5 without any label). Scores depend on the text alone, so repeated rows and ties of
keys change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import WordHashes, arrow_map, digest_order, hash_words, mixed

BUCKETS = 1 << 18
REPEATED = ((0, 2), (1, 3), (2, 5))  # places of the indicators of so many equal words in a row
# Labelled rows that the model is fitted on, and the share of them kept for the score curve.
FIT_ROWS = 8_000
CURVE_SHARE = 0.2
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 12
# Bytes and words of a text whose n-grams are hashed at once; neighbouring stretches overlap by as much
# as an n-gram may reach.
STRETCH = 4_000_000
REACH = 4


def features(text: str | None, known: WordHashes, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's n-grams. `seen` is an all-false array of BUCKETS flags."""
    data = (text or "").encode()
    split = data.split()
    for start in range(0, len(split), STRETCH):
        words = hash_words(split[start : start + STRETCH + REACH], known)
        with np.errstate(over="ignore"):
            pairs = mixed(words[:-1] * np.uint64(3) + words[1:])
        seen[(words >> np.uint64(46)).astype(np.int64)] = True
        seen[(pairs >> np.uint64(46)).astype(np.int64)] = True
        same = words[1:] == words[:-1]
        for place, length in REPEATED:
            run = np.convolve(same, np.ones(length - 1, dtype=np.int8)) if len(same) else same
            seen[place] |= bool((run == length - 1).any())
    for start in range(0, len(data), STRETCH):
        raw = np.frombuffer(data, np.uint8, min(STRETCH + 2, len(data) - start), start).astype(np.uint32)
        triples = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
        seen[(triples * np.uint32(2654435761)) >> np.uint32(14)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


@dataclass
class Model:
    """Weights and log-count ratios by bucket, the bias, and the curve from margins to scores."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(np.square(self.ratio[found]).sum())) or 1.0
        return float(self.weight[found].sum()) / length + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Smoothed in proportion to the classes' totals, so that an unseen n-gram tells nothing."""
    counts = np.zeros((2, BUCKETS))
    for found, label in zip(rows, labels, strict=True):
        counts[int(label), found] += 1
    totals = counts.sum(axis=1, keepdims=True)
    shares = counts / np.maximum(totals, 1) + SMOOTHING / max(totals.mean(), 1)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model, by dual coordinate descent.

    Row i is the indicator vector scaled by `ratio` and set to unit length, with a constant
    added for the bias; each step solves for one row's multiplier, kept in 0..cost. The cost of
    a class is raised by its rarity.
    """
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    cost = COST * 0.5 / np.where(labels == 1, share[1], share[0])
    length = np.array([np.sqrt(np.square(ratio[x]).sum()) or 1.0 for x in rows])
    alpha = np.zeros(len(rows))
    weight = np.zeros(len(ratio))  # in units of the scaled indicators
    bias = 0.0
    order = np.arange(len(rows))
    random = np.random.default_rng(2025)
    for _ in range(EPOCHS):
        random.shuffle(order)
        for i in order:
            at = rows[i]
            value = ratio[at] / length[i]
            gradient = sign[i] * (weight[at] @ value + bias) - 1
            old = alpha[i]
            alpha[i] = min(max(old - gradient / (value @ value + 1), 0.0), cost[i])
            if alpha[i] != old:
                weight[at] += (alpha[i] - old) * sign[i] * value
                bias += (alpha[i] - old) * sign[i]
    return weight * ratio, bias


def logistic_curve(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into the chance of label 1 (Newton, with smoothed targets)."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(shift)


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    flat = np.zeros(BUCKETS, np.float32)
    if len(set(labels.tolist())) < 2:
        share = min(max(float(labels.mean()), 1e-6), 1 - 1e-6) if len(labels) else 0.5
        return Model(flat, flat, 0.0, 1.0, float(np.log(share / (1 - share))))
    apart = np.arange(len(rows)) % round(1 / CURVE_SHARE) == 0
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart[:] = False  # too few rows to leave some out: the curve is fitted on all
    fit = [rows[i] for i in np.flatnonzero(~apart)]
    ratio = log_count_ratios(fit, labels[~apart])
    weight, bias = descend(fit, labels[~apart], ratio)
    model = Model(weight.astype(np.float32), ratio.astype(np.float32), bias)
    held = np.flatnonzero(apart) if apart.any() else np.arange(len(rows))
    margins = np.array([model.margin(rows[i]) for i in held])
    model.slope, model.shift = logistic_curve(margins, labels[held])
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = FIT_ROWS) -> Model:
    """A model of `labels[label]` fitted on at most `rows` of the labelled texts.

    Of several labels of one key, or several texts, each pair counts as a row. The sampled keys
    are bounded by `rows` and broadcast, so texts are not shuffled.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    chosen = (
        usable.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
        .orderBy(digest_order("__key"), "__key", "__label").limit(rows)
    )
    sampled = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key")

    known, seen = WordHashes(), np.zeros(BUCKETS, dtype=bool)

    def block(columns: dict) -> dict:
        found = [features(t, known, seen).tobytes() for t in columns["__text"].to_pylist()]
        return {"__key": columns["__key"].cast(pa.string()), "__label": columns["__label"],
                "__found": found}

    # Cut before the driver, since a key may have any number of rows.
    found = arrow_map(sampled, block, "__key string, __label int, __found binary")
    gathered = found.orderBy("__key", "__label", "__found").limit(rows).toPandas()
    return train([np.frombuffer(x, dtype=np.int32) for x in gathered["__found"]],
                 gathered["__label"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: the key, the columns of `keep`, and `score` (0 to 1, higher: label 1 likelier), which
    takes the place of a kept column of that name."""
    keep = tuple(n for n in keep if n not in (key, "score"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # about 2 MB, whatever the corpus
    known, seen = WordHashes(), np.zeros(BUCKETS, dtype=bool)

    def block(columns: dict) -> dict:
        fitted = Model(**shared.value)
        scores = [fitted.score(features(t, known, seen)) for t in columns["__text"].to_pylist()]
        return {**{name: columns[name] for name in kept}, "__score": scores}

    kept = [f"__{i}" for i in range(len(keep) + 1)]
    names = [key, *keep]
    rows = docs.select(*[F.col(n).alias(k) for n, k in zip(names, kept, strict=True)], F.col(text).alias("__text"))
    kinds = [f"{k} {docs.schema[n].dataType.simpleString()}" for n, k in zip(names, kept, strict=True)]
    out = arrow_map(rows, block, ", ".join([*kinds, "__score double"]))
    return out.toDF(*names, "score") if key != "score" else out.toDF("key", *keep, "score")
