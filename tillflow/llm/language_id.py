"""Language of a text, by a bidirectional gated recurrent network over its bytes.

A text is read in windows of `WINDOW` bytes. In each window one recurrent network runs forwards and one
backwards; from both states behind and before a byte every position gets a chance of each language. The
chances of all positions of all windows of a text are averaged: the text's language is the likeliest, its
score that average.

The network is trained here in numpy, by backpropagation through time over whole windows and steps that
adapt to each weight's slope. It learns from a bounded sample: about `DOCS_PER_LANG` documents of each
language, drawn by a hash of their ids, and of their windows at most `WINDOWS_PER_LANG`, drawn by a hash
as well. All texts are predicted whole, some megabytes at a time, windows side by side.

Languages are expected to be few: the driver knows them by name with their number of documents.

Cases: a text that is null or has no letter is `und` with score 0; documents without language are not
learnt from, nor are those without an id, but both are predicted; rows that repeat are predicted alike; if
nothing can be learnt all are `und`; a single language is every text's, with score 1; an empty table gives no
rows; further columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batches import slices, text_bytes
from tillflow.llm.fitting import held_out
from tillflow.llm.storage import written

FOLDS, HELD_OUT = 5, 0
WINDOW, STATES = 64, 12
DOCS_PER_LANG, WINDOWS_PER_LANG = 500, 3000
BATCH, ROUNDS, RATE, MOST_SLOPE = 256, 200, 0.02, 1.0
SIDE_BY_SIDE = 1024  # windows predicted at a time
PAD = 256  # stands behind the end of a text
UNKNOWN = "und"
SEED = 20240229


# The network -----------------------------------------------------------------


@dataclass
class Network:
    """Weights by name; each direction has what bytes and states add to its two gates and its new state."""

    langs: list[str]
    weights: dict[str, np.ndarray]


def new_weights(langs: int, states: int = STATES, kind=np.float32) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    shapes = {"out": (2 * states, langs), "bias": (1, langs)}
    for way in ("there", "back"):
        shapes |= {f"{way}_byte": (PAD + 1, 3 * states), f"{way}_state": (states, 3 * states)}
    scale = 1 / np.sqrt(states)
    return {
        name: (rng.standard_normal(shape) * (0 if name == "bias" else scale)).astype(kind)
        for name, shape in shapes.items()
    }


def _gate(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _order(way: str, steps: int) -> range:
    return range(steps) if way == "there" else range(steps - 1, -1, -1)


def _states(codes: np.ndarray, weights: dict, way: str):
    """(step, state, what it came from) for each step of a direction.

    codes: steps x windows. A state is kept, gate by gate, or replaced by a new one, to which the old
    state adds as far as the other gate lets it.
    """
    by_byte, by_state = weights[f"{way}_byte"], weights[f"{way}_state"]
    size = len(by_state)
    state = np.zeros((codes.shape[1], size), dtype=by_state.dtype)
    for step in _order(way, len(codes)):
        from_byte, from_state = by_byte[codes[step]], state @ by_state
        gates = _gate(from_byte[:, : 2 * size] + from_state[:, : 2 * size])
        keep, let = gates[:, :size], gates[:, size:]
        old = from_state[:, 2 * size :]
        new = let * old
        new += from_byte[:, 2 * size :]
        np.tanh(new, out=new)
        before = state
        state = before - new
        state *= keep
        state += new
        yield step, state, (before, keep, let, old, new)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def chances(codes: np.ndarray, weights: dict) -> np.ndarray:
    """Steps x windows x languages: the chances at every position."""
    size = len(weights["there_state"])
    numbers = np.empty((*codes.shape, weights["bias"].shape[1]), dtype=weights["bias"].dtype)
    numbers[:] = weights["bias"]
    for way, part in (("there", slice(0, size)), ("back", slice(size, None))):
        out = weights["out"][part]
        for step, state, _ in _states(codes, weights, way):
            numbers[step] += state @ out
    return _softmax(numbers)


def loss_and_slopes(codes: np.ndarray, answers: np.ndarray, weight: np.ndarray, weights: dict):
    """Weighted mean of -log chance of the answers over all positions, and its slope by each weight.

    answers and weight: by window; positions behind the end of a text don't count.
    """
    steps, windows = codes.shape
    size = len(weights["there_state"])
    told = {way: list(_states(codes, weights, way)) for way in ("there", "back")}
    both = np.empty((steps, windows, 2 * size), dtype=weights["out"].dtype)
    for way, part in (("there", slice(0, size)), ("back", slice(size, None))):
        for step, state, _ in told[way]:
            both[step, :, part] = state
    p = _softmax(both @ weights["out"] + weights["bias"])
    counts = (codes != PAD) * weight
    counts = (counts / max(counts.sum(), 1e-12)).astype(p.dtype)
    rows = np.arange(windows)
    loss = -(counts * np.log(np.maximum(p[:, rows, answers], 1e-30))).sum()
    error = p * counts[..., None]
    error[:, rows, answers] -= counts
    flat = error.reshape(-1, error.shape[-1])
    slopes = {"out": both.reshape(-1, 2 * size).T @ flat, "bias": flat.sum(axis=0, keepdims=True)}
    into = error @ weights["out"].T
    order = np.argsort(codes, axis=None, kind="stable")
    seen, firsts = np.unique(codes.ravel()[order], return_index=True)
    for way, part in (("there", slice(0, size)), ("back", slice(size, None))):
        by_state = weights[f"{way}_state"]
        back = np.zeros((windows, size), dtype=by_state.dtype)
        state_slope = np.zeros_like(by_state)
        byte_steps = np.empty((steps, windows, 3 * size), dtype=by_state.dtype)
        for step, _, (before, keep, let, old, new) in reversed(told[way]):
            back += into[step, :, part]
            d_new = back * (1 - keep) * (1 - new * new)
            d_keep = back * (before - new) * keep * (1 - keep)
            d_let = d_new * old * let * (1 - let)
            byte_steps[step] = np.concatenate([d_keep, d_let, d_new], axis=1)
            by_old = np.concatenate([d_keep, d_let, d_new * let], axis=1)
            state_slope += before.T @ by_old
            back = back * keep + by_old @ by_state.T
        byte_slope = np.zeros_like(weights[f"{way}_byte"])
        ordered = byte_steps.reshape(-1, 3 * size)[order]
        byte_slope[seen] = np.add.reduceat(ordered, firsts, axis=0)
        slopes |= {f"{way}_state": state_slope, f"{way}_byte": byte_slope}
    return float(loss), slopes


def fit(codes: np.ndarray, answers: np.ndarray, langs: int, rounds: int = ROUNDS) -> dict:
    """Weights learnt from windows (steps x windows) and the number of each one's language."""
    rng = np.random.default_rng(SEED)
    weights = new_weights(langs)
    mean = {name: np.zeros_like(w) for name, w in weights.items()}
    square = {name: np.zeros_like(w) for name, w in weights.items()}
    sizes = np.bincount(answers, minlength=langs)
    weight = (1 / np.maximum(sizes, 1))[answers]
    chance = weight / weight.sum()
    for turn in range(1, rounds + 1):
        # Every language is met as often as the others.
        at = rng.choice(len(answers), size=min(BATCH, len(answers)), p=chance)
        _, slopes = loss_and_slopes(codes[:, at], answers[at], np.ones(len(at)), weights)
        length = np.sqrt(sum(float((s * s).sum()) for s in slopes.values()))
        shrink = min(1.0, MOST_SLOPE / max(length, 1e-12))
        rate = RATE * min(1.0, 2 * (1 - turn / (rounds + 1)))
        for name, slope in slopes.items():
            slope = slope * shrink
            mean[name] += 0.1 * (slope - mean[name])
            square[name] += 0.01 * (slope * slope - square[name])
            direction = mean[name] / (1 - 0.9**turn)
            spread = np.sqrt(square[name] / (1 - 0.99**turn)) + 1e-8
            weights[name] = (weights[name] - rate * direction / spread).astype(np.float32)
    return weights


# Texts -----------------------------------------------------------------------


def windows_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all rows, a row per window, and how many windows each row has."""
    raw, offsets = text_bytes(text)
    counts = -(-np.diff(offsets) // WINDOW)
    rows = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (offsets[:-1][rows] + number * WINDOW)[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][rows][:, None]
    padded = np.append(raw, np.uint8(0))
    codes = np.where(inside, padded[np.minimum(at, len(raw))].astype(np.int16), np.int16(PAD))
    return codes, counts


def text_chances(text: pa.Array, network: Network) -> np.ndarray:
    """Rows x languages: the mean of the chances at all positions; zeros for an empty text."""
    codes, counts = windows_of(text)
    sums = np.zeros((len(codes), len(network.langs)))
    for a in range(0, len(codes), SIDE_BY_SIDE):
        part = np.ascontiguousarray(codes[a : a + SIDE_BY_SIDE].T)
        p = chances(part, network.weights)
        p[part == PAD] = 0
        sums[a : a + SIDE_BY_SIDE] = p.sum(axis=0)
    totals = np.zeros((len(counts), len(network.langs)))
    filled = np.flatnonzero(counts)
    if len(filled):
        totals[filled] = np.add.reduceat(sums, (np.cumsum(counts) - counts)[filled], axis=0)
    return totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-12)


def _unit(*columns) -> Column:
    """A number from 0 to 1 by hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def _sampled_windows(usable: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """lang, hash and bytes of the windows of the documents drawn."""
    rates = [F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, DOCS_PER_LANG / n))]
    # As an expression: a join by language would shuffle all texts by a few hot keys.
    drawn = usable.where(_unit("doc_id") < F.try_element_at(F.create_map(*rates), F.col("lang")))

    def cut(batches):
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                codes, counts = windows_of(text.slice(a, b - a))
                of = pa.array(np.repeat(np.arange(a, b), counts))
                number = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
                data = [row[row != PAD].astype(np.uint8).tobytes() for row in codes]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(of),
                        batch.column("key").take(of),
                        pa.array(number),
                        pa.array(data, pa.binary()),
                    ],
                    ["lang", "key", "number", "bytes"],
                )

    keyed = drawn.select("lang", F.xxhash64("doc_id").alias("key"), "text")
    found = keyed.mapInArrow(cut, "lang string, key long, number long, bytes binary")
    return written(found.withColumn("hash", F.xxhash64("key", "number")), "language-windows")


def train(docs: DataFrame) -> Network:
    """The network, from documents with a language outside the held-out fold."""
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & F.col("text").rlike("\\p{L}")
        & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    )
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if len(langs) < 2:
        return Network(langs, {})
    windows = _sampled_windows(usable, sizes)
    taken, answers = [], []
    for number, lang in enumerate(langs):
        # At most so many windows of some bytes come to the driver.
        some = windows.where(F.col("lang") == lang).orderBy("hash", "key", "number")
        found = [bytes(r["bytes"]) for r in some.limit(WINDOWS_PER_LANG).select("bytes").collect()]
        taken += found
        answers += [number] * len(found)
    codes, _ = windows_of(pa.array(taken, pa.binary()))
    return Network(langs, fit(np.ascontiguousarray(codes.T), np.array(answers), len(langs)))


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, the likeliest language and its mean chance."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kind = docs.schema["doc_id"].dataType.simpleString()
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", lettered.alias("lettered"))

    def run(batches):
        network = shared.value
        langs = np.array([*network.langs, UNKNOWN], dtype=object)
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                known = batch.column("lettered").slice(a, b - a).to_numpy(zero_copy_only=False)
                if len(network.langs) > 1:
                    p = text_chances(text.slice(a, b - a), network)
                else:
                    p = np.ones((b - a, len(network.langs)))
                    known = known & (len(network.langs) == 1)
                best = p.argmax(axis=1) if p.shape[1] else np.zeros(b - a, dtype=np.int64)
                score = p.max(axis=1, initial=0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(langs[np.where(known, best, len(network.langs))], pa.string()),
                        pa.array(np.where(known, np.minimum(score, 1.0), 0.0)),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, its likeliest language and the score."""
    return predict(docs, train(docs)).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
    )
