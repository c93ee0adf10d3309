"""The recurrent network against a plain one, its slopes against differences, and its predictions."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tillflow.llm import language_id as ids
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def small():
    rng = np.random.default_rng(1)
    weights = ids.new_weights(3, states=4, kind=np.float64)
    weights["bias"] += rng.standard_normal(weights["bias"].shape)
    codes = rng.integers(97, 110, size=(7, 5)).astype(np.int16)
    codes[4:, 2] = ids.PAD
    return weights, codes


def plain_chances(codes, weights):
    """Of one window, gate by gate."""
    def gate(x):
        return 1 / (1 + math.exp(-x))

    steps, size = len(codes), len(weights["there_state"])
    states = {}
    for way, order in (("there", range(steps)), ("back", reversed(range(steps)))):
        h, said = [0.0] * size, {}
        for t in order:
            x = weights[f"{way}_byte"][codes[t]]
            u = [sum(h[i] * weights[f"{way}_state"][i][j] for i in range(size)) for j in range(3 * size)]
            keep = [gate(x[j] + u[j]) for j in range(size)]
            let = [gate(x[size + j] + u[size + j]) for j in range(size)]
            new = [math.tanh(x[2 * size + j] + let[j] * u[2 * size + j]) for j in range(size)]
            h = [keep[j] * h[j] + (1 - keep[j]) * new[j] for j in range(size)]
            said[t] = h
        states[way] = said
    found = []
    for t in range(steps):
        both = np.array(states["there"][t] + states["back"][t])
        e = np.exp(both @ weights["out"] + weights["bias"][0])
        found.append(e / e.sum())
    return np.array(found)


def test_chances_equal_a_plain_network(small):
    weights, codes = small
    found = ids.chances(codes, weights)
    for n in range(codes.shape[1]):
        assert np.allclose(found[:, n], plain_chances(codes[:, n], weights), atol=1e-9)


def test_slopes_equal_differences(small):
    weights, codes = small
    answers, weight = np.array([0, 1, 2, 1, 0]), np.array([1.0, 2.0, 1.0, 0.5, 1.0])
    _, slopes = ids.loss_and_slopes(codes, answers, weight, weights)
    rng = np.random.default_rng(2)
    for name, slope in slopes.items():
        assert slope.shape == weights[name].shape
        for _ in range(12):
            row = rng.choice(np.unique(codes)) if name.endswith("byte") else rng.integers(len(slope))
            at = (row, rng.integers(slope.shape[1]))
            both = []
            for step in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in weights.items()}
                moved[name][at] += step
                both.append(ids.loss_and_slopes(codes, answers, weight, moved)[0])
            assert math.isclose((both[0] - both[1]) / 2e-5, slope[at], rel_tol=1e-4, abs_tol=1e-8)


def test_windows_cover_whole_texts():
    texts = ["", None, "a", "é" * 100, "x" * ids.WINDOW, "y" * (3 * ids.WINDOW + 1)]
    codes, counts = ids.windows_of(pa.array(texts))
    data = [(t or "").encode() for t in texts]
    assert counts.tolist() == [-(-len(d) // ids.WINDOW) for d in data]
    flat = codes[codes != ids.PAD].astype(np.uint8).tobytes()
    assert flat == b"".join(data)


def test_pooled_chances_are_means_over_all_positions():
    network = ids.Network(["a", "b"], ids.new_weights(2, kind=np.float64))
    texts = ["hello", "", "z" * 200]
    found = ids.text_chances(pa.array(texts), network)
    codes, counts = ids.windows_of(pa.array(texts))
    plain = [plain_chances(row, network.weights)[row != ids.PAD] for row in codes]
    assert np.allclose(found[0], plain[0].mean(axis=0)) and not found[1].any()
    assert np.allclose(found[2], np.concatenate(plain[1:]).mean(axis=0))


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = QUERIES["op13_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)


def test_odd_languages(spark):
    """One language alone, none at all, and texts without a letter."""
    rows = [(k, f"some text {k}", None if k % 2 else "xx", 0) for k in range(20)]
    rows += [(30, "12 34", "xx", 0), (31, None, "xx", 0), (None, "text", None, 0), (33, "", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    found = {r.doc_id: (r.lang_pred, r.score) for r in ids.language_id(docs).collect()}
    assert all(found[k] == ("xx", 1.0) for k in [*range(20), None])
    assert all(found[k] == ("und", 0.0) for k in (30, 31, 33))
    none = ids.language_id(docs.where("lang IS NULL")).collect()
    assert len(none) == 12 and {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
