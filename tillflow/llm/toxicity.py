"""Toxicity from character n-grams with naive Bayes log-count ratios.

Every distinct n-gram of three to five characters of a text is a feature, found by its hash. In the
labelled texts the share of toxic and of other texts that have a feature gives its log-count ratio;
the features that tell the two apart best are kept, each is scaled by its ratio, and a logistic
regression learns their weights. Text enters lower-cased with white space run together.

Training takes at most `per_class` labelled texts of each class, chosen by a hash of their ids, from
the folds that are not held out; their weights restore the shares of all labelled texts. Scoring is
one pass over all texts without a shuffle; the model has a fixed size.

Cases: a null text counts as empty; an empty text gets the score of a text without features; rows
that repeat get equal scores; labels that are null, or of unknown documents, teach nothing; without
labels of both classes every text gets their share, or 0; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batches import slices
from tillflow.llm.fitting import class_weights, held_out, minimise, sample, sigmoid

ORDERS = (3, 4, 5)
TABLE_BITS = 18
FEATURES = 2048
PER_CLASS = 4000
TRAINING_TASKS = 12
RIDGE = 1e-3
PREDICT_FROM = 0.3
_U32 = np.uint32
_STEP, _SPREAD = _U32(0x01000193), _U32(0x9E3779B1)


@dataclass
class Model:
    """weights: per kept feature, its ratio times its learnt weight."""

    feature_of: np.ndarray  # feature number of each hash, -1 where none
    weights: np.ndarray
    bias: float


def _characters(texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end, and where each text starts, with the end."""
    clean = [" " + " ".join((t or "").lower().split()) + " " for t in texts]
    points = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), dtype=_U32)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in clean])]).astype(np.int64)


def _grams(points: np.ndarray):
    """Per order, the hash of the n-gram at each place."""
    code = points * _SPREAD
    for n in ORDERS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        h = code[:size].copy()
        for k in range(1, n):
            h *= _STEP
            h ^= code[k : k + size]
        h *= _SPREAD
        h ^= h >> _U32(15)
        h *= _SPREAD
        yield n, h >> _U32(32 - TABLE_BITS)


def present(texts, feature_of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs in order; the hash itself is the feature if none are given."""
    points, starts = _characters(texts)
    width = (1 << TABLE_BITS) if feature_of is None else int(feature_of.max(initial=0)) + 1
    found = []
    for n, h in _grams(points):
        at = np.arange(len(h)) if feature_of is None else np.flatnonzero(feature_of[h] >= 0)
        of = np.searchsorted(starts, at, side="right") - 1
        whole = at + n <= starts[of + 1]
        feature = h[at[whole]] if feature_of is None else feature_of[h[at[whole]]]
        found.append(np.unique(of[whole] * width + feature))
    keys = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    return keys // width, keys % width


def _counts(batches):
    """Per task: in how many toxic and other texts each hash is present."""
    counts = np.zeros((2, 1 << TABLE_BITS), dtype=np.int64)
    for batch in batches:
        grade = batch.column("grade").to_numpy()
        for a, b in slices(batch.column("text")):
            of, hashes = present(batch.column("text").slice(a, b - a).to_pylist())
            for label in (0, 1):
                counts[label] += np.bincount(
                    hashes[grade[a:b][of] == label], minlength=counts.shape[1]
                )
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (seen, counts[0, seen], counts[1, seen])], ["hash", "other", "toxic"]
    )


def _ratios(counts, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the kept features and their log-count ratios."""
    hashes, other, toxic = counts
    share_toxic = (toxic + 1) / (texts[1] + 2)
    share_other = (other + 1) / (texts[0] + 2)
    ratio = np.log(share_toxic / share_other)
    # How far the shares lie apart, in standard errors.
    share = (toxic + other + 1) / (texts.sum() + 2)
    apart = np.abs(share_toxic - share_other) / np.sqrt(share * (1 - share) + 1e-12)
    best = np.lexsort((hashes, -apart))[:FEATURES]
    return hashes[best].astype(np.int64), ratio[best]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """labels: doc_id and `toxic`, 0 or 1."""
    nothing = np.full(1 << TABLE_BITS, -1, dtype=np.int16)
    chosen, sizes = sample(labels.select("doc_id", F.col("toxic").alias("grade")), 2, per_class)
    share = sizes[1] / max(1, sum(sizes))
    if not all(sizes):
        return Model(nothing, np.zeros(0), -500.0 if share == 0 else 500.0)
    # At most 2 * per_class rows of two numbers are broadcast, and as many texts dealt out.
    texts = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("text", "grade")
        .repartition(TRAINING_TASKS)
    )
    counts = (
        texts.mapInArrow(_counts, "hash long, other long, toxic long")
        .groupBy("hash")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .toPandas()
    )
    per_label = dict(texts.groupBy("grade").count().collect())
    totals = np.array([per_label.get(0, 0), per_label.get(1, 0)])
    if not totals.all():
        return Model(nothing, np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    hashes, ratio = _ratios([counts[c].to_numpy() for c in ("hash", "other", "toxic")], totals)
    feature_of = nothing.copy()
    feature_of[hashes] = np.arange(len(hashes), dtype=np.int16)

    def rows(batches):
        for batch in batches:
            grade = batch.column("grade")
            for a, b in slices(batch.column("text")):
                of, feature = present(batch.column("text").slice(a, b - a).to_pylist(), feature_of)
                cuts = np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([grade.slice(a, b - a), lists], ["grade", "x"])

    sparse = texts.mapInArrow(rows, "grade int, x array<int>").toPandas()
    grade = sparse["grade"].to_numpy()
    feature = np.concatenate(sparse["x"].to_list()).astype(np.int64)
    of = np.repeat(np.arange(len(grade)), sparse["x"].str.len())
    weight = class_weights(grade, sizes)
    scale = ratio[feature]

    def loss(theta: np.ndarray):
        margin = theta[-1] + np.bincount(of, theta[feature] * scale, minlength=len(grade))
        sign = np.where(grade == 1, 1.0, -1.0)
        p = sigmoid(-sign * margin)
        value = -(weight * np.log(np.maximum(1 - p, 1e-300))).sum()
        error = -sign * p * weight
        slope = np.bincount(feature, error[of] * scale, minlength=len(ratio))
        ridge = np.append(theta[:-1], 0.0) * RIDGE
        return value + (ridge @ theta) / 2, np.append(slope, error.sum()) + ridge

    theta = minimise(loss, np.zeros(len(ratio) + 1))
    return Model(feature_of, ratio * theta[:-1], float(theta[-1]))


def score_texts(texts, model: Model) -> np.ndarray:
    """Probability that each text is toxic."""
    of, feature = present(texts, model.feature_of)
    weights = model.weights[feature] if len(model.weights) else np.zeros(0)
    return sigmoid(model.bias + np.bincount(of, weights, minlength=len(texts)))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document with its score, whether it is held out, and the verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                scores = score_texts(text.slice(a, b - a).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(scores)], ["doc_id", "score"]
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))
