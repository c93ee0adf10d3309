"""Quality as a grade: cumulative-link regression on hashed text.

Ratings are ordered grades 0, 1, 2 and so on. One set of weights turns the hashed features of a text
into a single number, and ordered thresholds cut that number into grades: the probability of grade k
or better is the logistic of the number less threshold k. That gives each text an expected grade for
ranking, and a tail probability for selection.

Features are the words of a text, the shapes of its words (runs of letters, capitals, digits and
single signs), whether a word repeats the one before, and the order of size of the text; each group
enters as square roots of shares, so that long texts weigh no more than short ones.

Training takes at most `per_grade` rated texts of each grade, chosen by a hash of their ids, from the
folds that are not held out. Scoring is one pass without a shuffle; the model has a fixed size.

Cases: a null text counts as empty; a text without words has the one feature of its size; rows that
repeat get equal results; ratings that are null, or of unknown documents, teach nothing; with fewer
than two grades rated every text gets the rated grade, or the best one if nothing is rated; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.batches import mix, slices, word_hashes
from tillflow.llm.fitting import class_weights, held_out, minimise, sample, sigmoid
from tillflow.llm.storage import every_column

GRADES = 3
TABLE_BITS = 16
PER_GRADE = 3000
TRAINING_TASKS = 12
RIDGE = 1e-5
KEEP_GRADE, KEEP_FROM = 1, 0.5
_U64 = np.uint64
# Keep the groups apart in the table.
_WORD, _SHAPE, _SAME, _SIZE = (_U64(k * 0x9E3779B97F4A7C15 % (1 << 64)) for k in range(1, 5))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the lowest


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature, value) of all rows, in order of the rows."""
    words, counts = word_hashes(text)
    shapes, _ = word_hashes(text, shape=True)
    rows = np.repeat(np.arange(len(counts)), counts)
    same = np.zeros(len(words), dtype=np.uint64)
    if len(words):
        same[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    sizes = np.log2(counts + 1).astype(np.uint64)
    groups = [(words, _WORD, rows), (shapes, _SHAPE, rows), (same, _SAME, rows)]
    groups.append((sizes, _SIZE, np.arange(len(counts))))
    of, feature, value = [], [], []
    for codes, salt, row in groups:
        hashed = (mix(codes ^ salt) >> _U64(64 - TABLE_BITS)).astype(np.int64)
        keys, times = np.unique((row << TABLE_BITS) | hashed, return_counts=True)
        at = keys >> TABLE_BITS
        of.append(at)
        feature.append(keys & ((1 << TABLE_BITS) - 1))
        total = np.maximum(counts, 1)[at] if salt != _SIZE else 1
        value.append(np.sqrt(times / total))
    of, feature, value = (np.concatenate(x) for x in (of, feature, value))
    order = np.argsort(of, kind="stable")
    return of[order], feature[order], value[order]


def _tails(number: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Probability of each grade or better, grade 0 first, and a last column of zeros."""
    inner = sigmoid(number[:, None] - thresholds[None, :])
    return np.hstack([np.ones((len(number), 1)), inner, np.zeros((len(number), 1))])


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from a first one and the logarithms of the gaps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(np.clip(free[1:], -30, 30))]))


def fit(of, feature, value, grade: np.ndarray, weight: np.ndarray, grades: int) -> Model:
    """Weights and thresholds that make the grades likeliest, with a ridge on the weights."""
    width, n = 1 << TABLE_BITS, len(grade)
    rows = np.arange(n)

    def loss(theta: np.ndarray):
        w, free = theta[:width], theta[width:]
        cuts = _thresholds(free)
        tails = _tails(np.bincount(of, w[feature] * value, minlength=n), cuts)
        p = np.maximum(tails[rows, grade] - tails[rows, grade + 1], 1e-12)
        steep = tails * (1 - tails)
        up, down = steep[rows, grade], steep[rows, grade + 1]
        error = -weight * (up - down) / p
        slope = np.zeros_like(theta)
        slope[:width] = np.bincount(feature, error[of] * value, minlength=width)
        # A threshold enters as the lower end of its grade and as the upper end of the one below.
        by_cut = np.zeros(grades - 1)
        np.add.at(by_cut, grade[grade > 0] - 1, (weight * up / p)[grade > 0])
        top = grade < grades - 1
        np.add.at(by_cut, grade[top], (-weight * down / p)[top])
        later = np.cumsum(by_cut[::-1])[::-1]
        slope[width] = later[0]
        slope[width + 1 :] = later[1:] * np.exp(np.clip(free[1:], -30, 30))
        slope[:width] += RIDGE * w
        return -(weight * np.log(p)).sum() + RIDGE * (w @ w) / 2, slope

    start = np.zeros(width + grades - 1)
    theta = minimise(loss, start)
    return Model(theta[:width], _thresholds(theta[width:]))


def train(
    docs: DataFrame, ratings: DataFrame, grades: int = GRADES, per_grade: int = PER_GRADE
) -> Model:
    """ratings: doc_id and `grade`, whole numbers from 0 to grades - 1."""
    weights = np.zeros(1 << TABLE_BITS)
    chosen, sizes = sample(ratings, grades, per_grade)
    rated = [g for g in range(grades) if sizes[g]]
    if len(rated) < 2:
        only = rated[0] if rated else grades - 1
        return Model(weights, np.where(np.arange(1, grades) <= only, -500.0, 500.0))
    # At most grades * per_grade rows of two numbers are broadcast, and as many texts dealt out.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade")

    def rows(batches):
        for batch in batches:
            for a, b in slices(batch.column("text")):
                of, feature, value = features(batch.column("text").slice(a, b - a))
                cuts = pa.array(np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("grade").slice(a, b - a),
                        pa.ListArray.from_arrays(cuts, pa.array(feature.astype(np.int32))),
                        pa.ListArray.from_arrays(cuts, pa.array(value.astype(np.float32))),
                    ],
                    ["grade", "x", "v"],
                )

    sparse = (
        texts.repartition(TRAINING_TASKS)
        .mapInArrow(rows, "grade int, x array<int>, v array<float>")
        .toPandas()
    )
    grade = sparse["grade"].to_numpy()
    if len(np.unique(grade)) < 2:
        only = int(grade[0]) if len(grade) else grades - 1
        return Model(weights, np.where(np.arange(1, grades) <= only, -500.0, 500.0))
    of = np.repeat(np.arange(len(grade)), sparse["x"].str.len())
    feature = np.concatenate(sparse["x"].to_list()).astype(np.int64)
    value = np.concatenate(sparse["v"].to_list()).astype(np.float64)
    return fit(of, feature, value, grade, class_weights(grade, sizes), grades)


def grade_texts(text: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the expected grade and the probability of KEEP_GRADE or better."""
    of, feature, value = features(text)
    number = np.bincount(of, model.weights[feature] * value, minlength=len(text))
    tails = _tails(number, model.thresholds)
    return tails[:, 1:-1].sum(axis=1), tails[:, KEEP_GRADE]


def score(docs: DataFrame, model: Model, *carried: Column) -> DataFrame:
    """The carried columns in `row`, expected_grade and tail_probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(F.struct(*carried).alias("row"), "text")

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                expected, tail = grade_texts(text.slice(a, b - a), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(expected), pa.array(tail)],
                    ["row", "expected_grade", "tail_probability"],
                )

    numbers = [T.StructField(n, T.DoubleType()) for n in ("expected_grade", "tail_probability")]
    return base.mapInArrow(run, T.StructType([base.schema["row"], *numbers]))


def kept() -> Column:
    return F.col("tail_probability") >= KEEP_FROM


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from labels: 0 poor, 1 fair but toxic, 2 good; null where either label is missing."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
    return labels.select(
        "doc_id", grade.when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade")
    )


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: expected grade, tail probability and whether it is selected."""
    model = train(docs, ratings_of(labels))
    return score(docs, model, F.col("doc_id")).select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "expected_grade",
        "tail_probability",
        kept().alias("kept"),
    )


def selected_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The selected documents with all their columns; only labels of documents here count.

    A null text is an empty one; rows that repeat are judged alike. Further columns may have any
    names and hold anything. Without a label for any document here all are kept.
    """
    ratings = ratings_of(labels).join(docs.select("doc_id"), "doc_id", "left_semi")
    model = train(docs, ratings)
    scored = score(docs, model, *every_column(docs))
    return scored.where(kept()).select("row.*")
