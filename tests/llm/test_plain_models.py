"""Rules and classifiers against versions that go text by text, without tables of hashes or patterns."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex

from tillflow.llm import quality_classifier, quality_rules, toxicity
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = regex.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


# Quality rules -------------------------------------------------------------------


def plain_votes(text):
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    windows = [tuple(words[k : k + 5]) for k in range(n - 4)]
    seen = {w: windows.count(w) for w in set(windows)}
    repeats = len({k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)})
    symbols = sum(c in "#*$%&|<>" for c in text)
    capitals = len(regex.findall(r"\p{Lu}", text))
    common = len(set(words) & set(quality_rules.FUNCTION_WORDS))

    def vote(good, bad):
        return -1 if bad else 1 if good else 0

    return (n < 10 or 100 * repeats > 20 * n), (
        vote(symbols <= n / 50, symbols > n / 5),
        vote(2 * n <= chars <= 12 * n, not 2 * n <= chars <= 16 * n),
        vote(len(lines) > 1 and not dup, dup > len(lines) / 4),
        vote(n >= 20 and not repeats, repeats > n / 10),
        vote(n >= 40, n < 15),
        vote(capitals <= chars / 5, capitals > chars / 2),
        vote(common >= 2, not common and n >= 15),
    )


def plain_posteriors(votes, prior, accuracy):
    chances = []
    for row in votes:
        good, bad = prior, 1 - prior
        for vote, (on_good, on_bad) in zip(row, accuracy, strict=True):
            if vote:
                good *= on_good if vote > 0 else 1 - on_good
                bad *= 1 - on_bad if vote > 0 else on_bad
        chances.append(good / (good + bad))
    return np.array(chances)


def plain_model(votes):
    """Expectation-maximisation over texts, each by itself."""
    prior, accuracy = 0.8, [(0.95, 0.4)] * votes.shape[1]
    for _ in range(40):
        p = plain_posteriors(votes, prior, accuracy)
        prior = min(max(p.mean(), 0.01), 0.99)
        accuracy = []
        for rule in votes.T:
            spoke = rule != 0
            on_good = (p[rule > 0].sum() + 10 * 0.95) / (p[spoke].sum() + 10)
            on_bad = ((1 - p)[rule < 0].sum() + 10 * 0.4) / ((1 - p)[spoke].sum() + 10)
            accuracy.append((min(max(on_good, 0.7), 0.995), min(max(on_bad, 0.35), 0.995)))
    return prior, accuracy


def test_verdicts_of_the_rules(spark, texts):
    judged = {i: plain_votes(t) for i, t in texts.items()}
    votes = np.array([v for _, v in judged.values()])
    chances = plain_posteriors(votes, *plain_model(votes))
    rows = QUERIES["op8_quality_rules"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    by_id = {row.doc_id: row for row in rows}
    for (doc_id, (failed, own)), chance in zip(judged.items(), chances, strict=True):
        row = by_id[doc_id]
        assert tuple(row[name] for name in quality_rules.RULES) == own
        assert row.base_failed == failed
        assert row.quality == pytest.approx(chance, abs=1e-9)
        assert row.kept == (not failed and chance >= 0.5)
    assert {row.kept for row in rows} == {True, False}


# Toxicity ------------------------------------------------------------------------


def plain_hashes(text):
    """The table places of all different n-grams, each hashed by itself."""
    clean = " " + " ".join(text.lower().split()) + " "
    found = set()
    for size in (3, 4, 5):
        for gram in {clean[k : k + size] for k in range(len(clean) - size + 1)}:
            points = np.frombuffer(gram.encode("utf-32-le"), dtype=np.uint32)
            found.add(int(next(h for n, h in toxicity._grams(points) if n == size)[0]))
    return found


def learnt_from(spark, texts, folds=4, out=2):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    known = [r for r in labels if r.doc_id in texts]
    return [r for r in known if zlib.crc32(str(r.doc_id).encode()) % folds != out]


def test_ngrams_are_scaled_by_their_ratios_and_weighed_best(spark, texts):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rated = {r.doc_id: r.toxic for r in learnt_from(spark, texts) if r.toxic is not None}
    hashes = {i: plain_hashes(texts[i]) for i in texts}
    assert all(
        set(toxicity.present([texts[i]])[1].tolist()) == hashes[i] for i in list(texts)[:40]
    )
    n = [sum(1 for t in rated.values() if t == k) for k in (0, 1)]
    ratio, apart = {}, {}
    counts = {}
    for i, toxic in rated.items():
        for h in hashes[i]:
            counts.setdefault(h, [0, 0])[toxic] += 1
    for h, (other, bad) in counts.items():
        p, q = (bad + 1) / (n[1] + 2), (other + 1) / (n[0] + 2)
        ratio[h], both = math.log(p / q), (bad + other + 1) / (sum(n) + 2)
        apart[h] = abs(p - q) / math.sqrt(both * (1 - both) + 1e-12)
    kept = np.flatnonzero(model.feature_of >= 0).tolist()
    assert len(kept) == min(toxicity.FEATURES, len(counts))
    left = [apart[h] for h in counts if h not in set(kept)]
    assert min(apart[h] for h in kept) >= max(left, default=0.0) - 1e-9
    learnt = {h: model.weights[model.feature_of[h]] / ratio[h] if ratio[h] else 0.0 for h in kept}

    def loss(weights, bias):
        total = toxicity.RIDGE / 2 * sum(w * w for w in weights.values())
        for i, toxic in rated.items():
            margin = bias + sum(weights[h] * ratio[h] for h in hashes[i] if h in weights)
            total += math.log1p(math.exp(-margin if toxic else margin)) / len(rated)
        return total

    best, draw = loss(learnt, model.bias), random.Random(3)
    for step in (1e-3, 1e-2, 0.1):
        for _ in range(5):
            moved = {h: w + draw.gauss(0, step) for h, w in learnt.items()}
            assert loss(moved, model.bias + draw.gauss(0, step)) >= best - 1e-6
    for row in QUERIES["op3_toxicity"](spark, FOLDER).collect():
        margin = model.bias + sum(
            model.weights[model.feature_of[h]] for h in hashes[row.doc_id] if h in learnt
        )
        assert row.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)
        assert row.predicted == int(row.score >= 0.3)


# Quality classifier ----------------------------------------------------------------


def grade_chances(number, thresholds):
    tails = [1.0, *[1 / (1 + math.exp(-(number - t))) for t in thresholds], 0.0]
    return [a - b for a, b in zip(tails, tails[1:])]


def test_grades_are_weighed_best(spark, texts):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.train(docs, quality_classifier.ratings_of(labels))
    assert list(model.thresholds) == sorted(model.thresholds)
    of, feature, value = quality_classifier.features(pa.array(list(texts.values())))
    rows = {i: [] for i in range(len(texts))}
    for i, f, v in zip(of.tolist(), feature.tolist(), value.tolist(), strict=True):
        rows[i].append((f, np.float32(v)))
    rows = dict(zip(texts, rows.values(), strict=True))
    grades = {}
    for r in learnt_from(spark, texts):
        grade = 0 if r.quality == 0 else 1 if r.toxic == 1 else None
        if grade is None and r.quality == 1 and r.toxic == 0:
            grade = 2
        if grade is not None:
            grades[r.doc_id] = grade

    def loss(weights, thresholds):
        total = quality_classifier.RIDGE / 2 * float(weights @ weights)
        for i, grade in grades.items():
            number = sum(weights[f] * v for f, v in rows[i])
            total -= math.log(max(grade_chances(number, thresholds)[grade], 1e-12)) / len(grades)
        return total

    best, draw = loss(model.weights, model.thresholds), np.random.default_rng(4)
    used = np.unique(feature)
    for step in (1e-3, 1e-2, 0.1):
        for _ in range(5):
            moved = model.weights.copy()
            moved[used] += draw.normal(0, step, len(used))
            cuts = np.sort(model.thresholds + draw.normal(0, step, len(model.thresholds)))
            assert loss(moved, cuts) >= best - 1e-6
    for row in QUERIES["op4_quality_classifier"](spark, FOLDER).collect():
        number = sum(model.weights[f] * v for f, v in rows[row.doc_id])
        chances = grade_chances(number, model.thresholds)
        assert row.expected_grade == pytest.approx(chances[1] + 2 * chances[2], abs=1e-5)
        assert row.tail_probability == pytest.approx(1 - chances[0], abs=1e-5)
