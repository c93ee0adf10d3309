"""Likelihood of texts under a hidden Markov language model.

Words of the training documents are counted once. The most frequent ones, and the end of a text, are
symbols of a Markov chain with a few latent states; all other words share symbols by their last two
bytes, and the chance of the very word within its symbol follows its count, with one added for each
word and one for the unknown. In
each round of Baum-Welch every partition runs the scaled forward and backward recursions over its
documents and emits expected counts of states and symbols; sums over partitions give the next model.
A text is scored by the scaled forward recursion over all its words: exact, without pruning.

Counts of the `known_words` most frequent words, at most, travel to the tasks; the counts of all rarer
ones are joined, so every count is used, however many words there are. The same counts give the
baseline without states.

Cases: a null text counts as empty and has the one token of its end; rows that repeat are scored
alike, and counted as often as they occur; a row without doc_id is learnt from; an empty table gives
no rows, and without training documents all chances are those of the unknown; other columns are not
looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batches import slices
from tillflow.llm.fitting import held_out
from tillflow.llm.storage import written

FOLDS, HELD_OUT = 7, 2
STATES, ROUNDS = 8, 6
STAY = 0.98  # chance to stay in a state, to start with
ENDINGS = 64  # symbols for words that have none of their own
SYMBOLS = 8192  # words that are symbols of their own, at most
KNOWN_WORDS = 200_000  # words whose counts every task holds, at most
FLUSH = 400_000  # distinct words a task counts before it emits them
SLICE = 6 << 20
SEED = 20240229
END = b"\n"  # no word: words have no white space
_LOG10 = 1 / np.log(10)


# Counting -----------------------------------------------------------------------------


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text with A to Z in lower case; bytes split at just the six white-space signs."""
    return (text or b"").lower().split()


def _emit(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
        ["word", "n"],
    )


def _count(batches):
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            counts.update(words_of(text.as_py()))
            counts[END] += 1
            if len(counts) > FLUSH:
                yield _emit(counts)
                counts = Counter()
    if counts:
        yield _emit(counts)


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n, over all documents given; the end of a text counts as a word."""
    counted = docs.select("text").mapInArrow(_count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """words: the most frequent ones, their symbols first; counts: how often each occurs."""

    words: list[bytes]
    counts: np.ndarray
    symbols: int  # so many of the words have a symbol of their own
    tokens: int  # N
    distinct: int  # V
    others: np.ndarray  # by ending: tokens and distinct words without a symbol of their own

    def symbol_counts(self) -> np.ndarray:
        """Counts of all symbols, those of the endings last."""
        return np.append(self.counts[: self.symbols], self.others[0]).astype(np.float64)

    def shares(self) -> np.ndarray:
        """log10 of what chances within the symbol of each ending are divided by."""
        return np.log10(self.others.sum(axis=0) + 1.0)


def ending(word: bytes) -> int:
    return crc32(word[-2:]) % ENDINGS


def _least_count(sizes: list[tuple[int, int]], most: int) -> int:
    """The least count whose words, with all more frequent ones, are at most `most`."""
    least, taken = 1 << 62, 0
    for n, words in sorted(sizes, reverse=True):
        taken += words
        if taken > most:
            break
        least = n
    return least


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From all counts; the driver gets how many words have each count, and the frequent words."""
    sizes = [(r["n"], r["count"]) for r in counts.groupBy("n").count().collect()]
    known = counts.where(F.col("n") >= _least_count(sizes, KNOWN_WORDS)).toPandas()
    known["word"] = [bytes(w) for w in known["word"]]
    known = known.sort_values(["n", "word"], ascending=[False, True])
    least = _least_count(sizes, SYMBOLS - 1)
    symbols = int((known["n"] >= least).sum())
    words, amounts = known["word"].to_list(), known["n"].to_numpy(dtype=np.int64)
    if END in words and words.index(END) >= symbols:
        at = words.index(END)
        words.insert(symbols, words.pop(at))
        amounts = np.insert(np.delete(amounts, at), symbols, amounts[at])
        symbols += 1
    tokens, distinct = sum(n * c for n, c in sizes), sum(c for _, c in sizes)
    last = F.expr("substring(word, greatest(length(word) - 1, 1), 2)")
    others = np.zeros((2, ENDINGS), dtype=np.int64)
    rest = counts.where((F.col("n") < least) & (F.col("word") != F.lit(END)))
    by_ending = rest.groupBy((F.crc32(last) % ENDINGS).alias("at"))
    for at, n, kinds in by_ending.agg(F.sum("n"), F.count("*")).collect():
        others[:, at] = n, kinds
    return Vocabulary(words, amounts, symbols, tokens, distinct, others)


# Documents as symbols -------------------------------------------------------------------


def _symbolised(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Per row: its symbols, two bytes each, sums of log10(count + 1), and its rarer words."""
    shared = docs.sparkSession.sparkContext.broadcast((words, {w: k for k, w in enumerate(words.words)}))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words, place = shared.value
        logs = np.log10(np.append(words.counts, 0) + 1.0)
        unknown, shares = len(words.words), words.shares()
        # Of the frequent words without a symbol, that of their ending.
        symbol = np.arange(unknown + 1)
        symbol[words.symbols : unknown] = [
            words.symbols + ending(w) for w in words.words[words.symbols :]
        ]
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            for a, b in slices(text):
                columns: list[list] = [[] for _ in range(6)]
                for item in text.slice(a, b - a):
                    tokens = words_of(item.as_py())
                    tokens.append(END)
                    found = map(place.get, tokens, repeat(unknown))
                    at = np.fromiter(found, np.int64, len(tokens))
                    rare = np.flatnonzero(at == unknown).tolist()
                    code = symbol[at]
                    code[rare] = [words.symbols + ending(tokens[k]) for k in rare]
                    rest = code >= words.symbols
                    values = (
                        len(at),
                        len(at) - len(rare),
                        float(logs[at].sum()),
                        # Unknown to this task only: their counts are added by the join.
                        float(logs[at[rest]].sum() - shares[code[rest] - words.symbols].sum()),
                        code.astype("<u2").tobytes(),
                        [tokens[k] for k in rare],
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                own = [batch.column(c).slice(a, b - a) for c in ("row", "doc_id", "held_out")]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *arrays], names)

    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
    types.append(pa.list_(pa.binary()))
    names = "row doc_id held_out n_tokens n_known logs rest_logs symbols rare".split()
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text"
    ).mapInArrow(
        run,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double,"
        " rest_logs double, symbols binary, rare array<binary>",
    )


# The model -------------------------------------------------------------------------------


@dataclass
class Model:
    start: np.ndarray  # chance of each state at the first token
    step: np.ndarray  # from state, to state
    emit: np.ndarray  # symbol, state


def first_model(counts: np.ndarray, states: int = STATES) -> Model:
    """Symbols as often as they occur, a little more or less in each state."""
    rng = np.random.default_rng(SEED)
    emit = (counts[:, None] + 1) * rng.uniform(0.5, 1.5, size=(len(counts), states))
    step = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(step, STAY if states > 1 else 1.0)
    return Model(
        np.full(states, 1 / states),
        step,
        emit / emit.sum(axis=0, keepdims=True),
    )


class Sequences:
    """Symbols of several documents, token by token: first all first tokens, then all second ones.

    The longest documents come first, so those that still run at a step are a prefix.
    """

    def __init__(self, data: list[bytes]):
        tokens = [np.frombuffer(d, dtype="<u2").astype(np.int64) for d in data]
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        longest = int(lengths.max(initial=0))
        # How many documents have a token at each step.
        self.running = np.searchsorted(-lengths, -np.arange(longest), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.running)])
        rank = np.repeat(np.arange(len(tokens)), lengths)
        depth = np.arange(len(rank)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = np.zeros(len(rank), dtype=np.int64)
        if len(rank):
            flat = np.concatenate([tokens[k] for k in self.order])
            self.symbols[self.at[depth] + rank] = flat


def forward(model: Model, seqs: Sequences) -> tuple[np.ndarray, np.ndarray]:
    """Scaled state chances of every token, and the scales."""
    alpha = model.emit[seqs.symbols]
    scale = np.empty(len(seqs.symbols))
    ones = np.ones(len(model.start))
    at = seqs.at.tolist()
    ahead = model.start
    for start, stop in zip(at[:-1], at[1:], strict=True):
        now = alpha[start:stop]
        now *= ahead if ahead.ndim == 1 else ahead[: stop - start] @ model.step
        total = now @ ones
        now /= total[:, None]
        scale[start:stop] = total
        ahead = now
    return alpha, scale


def log10_likelihoods(model: Model, seqs: Sequences) -> np.ndarray:
    """Per document, in the order given, log10 of the chance of its symbols."""
    _, scale = forward(model, seqs)
    rank = np.concatenate([np.arange(n) for n in seqs.running]) if len(seqs.running) else []
    sums = np.bincount(np.asarray(rank, dtype=np.int64), np.log(scale), minlength=len(seqs.order))
    result = np.empty(len(seqs.order))
    result[seqs.order] = sums * _LOG10
    return result


def expected_counts(model: Model, seqs: Sequences):
    """How often each state starts, follows each state and emits each symbol, in expectation."""
    states = len(model.start)
    gamma, scale = forward(model, seqs)
    ahead = model.emit[seqs.symbols]
    ahead /= scale[:, None]
    follow = np.zeros((states, states))
    at, back = seqs.at.tolist(), model.step.T.copy()
    # From the last step but one: state chances of each token become those that know what follows,
    # and emissions over scales are multiplied by the backward chance.
    for k in range(len(at) - 3, -1, -1):
        coming = ahead[at[k + 1] : at[k + 2]]
        now = slice(at[k], at[k] + len(coming))
        beta = coming @ back
        follow += gamma[now].T @ coming
        gamma[now] *= beta
        ahead[now] *= beta
    emit = np.stack(
        [np.bincount(seqs.symbols, gamma[:, s], minlength=len(model.emit)) for s in range(states)],
        axis=1,
    )
    first = gamma[: at[1]].sum(axis=0) if len(at) > 1 else np.zeros(states)
    return first, follow * model.step, emit, float(np.log(scale).sum())


def _parts(batch: pa.RecordBatch):
    """The rows of a batch by length, as slices with some millions of symbols: places and symbols.

    The long ones of a batch are together, so their many steps are gone through once.
    """
    symbols = batch.column("symbols")
    order = np.argsort(pc.binary_length(symbols).to_numpy(), kind="stable")
    data = [d.as_py() for d in symbols.take(pa.array(order))]
    ends = np.cumsum([len(d) for d in data])
    start = 0
    while start < len(data):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE // 3, side="right")))
        yield order[start:stop], data[start:stop]
        start = stop


def train(training: DataFrame, words: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows of `training`, which hold `symbols`."""
    model = first_model(words.symbol_counts(), states)
    if not words.tokens:
        return model
    size = len(model.emit)
    columns = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = training.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            total = np.zeros((size + states + 1, states))
            for batch in batches:
                for _, data in _parts(batch):
                    first, follow, emit, _ = expected_counts(shared.value, Sequences(data))
                    total[:size] += emit
                    total[size : size + states] += follow
                    total[-1] += first
            seen = np.flatnonzero(total.any(axis=1))
            arrays = [pa.array(total[seen, k]) for k in range(states)]
            yield pa.RecordBatch.from_arrays([pa.array(seen), *arrays], ["at", *columns])

        fields = ", ".join(f"{c} double" for c in columns)
        sums = (
            training.select("symbols")
            .mapInArrow(run, f"at long, {fields}")
            .groupBy("at")
            .agg(*[F.sum(c).alias(c) for c in columns])
            .toPandas()
        )
        total = np.zeros((size + states + 1, states))
        total[sums["at"].to_numpy(dtype=np.int64)] = sums[columns].to_numpy()
        # A small constant keeps every symbol and move possible.
        emit = total[:size] + 0.01 + 1e-6 * words.symbol_counts()[:, None]
        step, start = total[size : size + states] + 0.1, total[-1] + 0.1
        model = Model(
            start / start.sum(),
            step / step.sum(axis=1, keepdims=True),
            emit / emit.sum(axis=0, keepdims=True),
        )
    return model


# Scores ------------------------------------------------------------------------------------


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: what is known of its tokens, and two log10 probabilities of its text."""
    marked = docs.select(
        "doc_id", "text", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out")
    )
    counts = written(word_counts(marked.where("NOT held_out")), "word-counts")
    words = vocabulary(counts)
    rows = written(_symbolised(marked, words), "symbols")
    model = train(rows.where("NOT held_out"), words)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for rows, data in _parts(batch):
                chances = log10_likelihoods(shared.value, Sequences(data))
                own = batch.take(pa.array(rows)).columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(chances)],
                    [*batch.schema.names[:-1], "chance"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "rest_logs"]
    scored = rows.select(*own, "symbols").mapInArrow(
        run,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double,"
        " rest_logs double, chance double",
    )
    rare = (
        rows.select("row", F.explode("rare").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("rare_known"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_logs"),
        )
    )
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    base = float(np.log10(words.tokens + words.distinct + 1))
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * base).alias("base_score"),
        (F.col("chance") + F.col("rest_logs") + rare_logs).alias("score"),
    )
