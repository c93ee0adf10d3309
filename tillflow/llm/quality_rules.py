"""Quality rules that vote or abstain, weighed by weak supervision.

Each rule says good (1), bad (-1) or nothing (0) about a text. How far a rule can be trusted is not
written down but estimated: expectation-maximisation over the patterns of votes finds the accuracies
of every rule and the share of good texts that explain the votes best, and each text gets the
probability that it is good. All work on texts is in DataFrame functions; the driver sees one row
per pattern of votes, at most 3 to the number of rules.

Cases: a null text counts as empty; a text without words fails the base rules; rows that repeat are
judged alike; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.storage import every_column, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Common words of the four languages of the texts.
FUNCTION_WORDS = (
    "the of and to in is that it for was with as be by on this are from or an at have not but"
    " der die und den von das mit des ist im für dem nicht eine ein zu auf sich"
    " de la le les et un une du dans est que qui pour pas par sur en au"
    " el los las y del se por con su para una lo al como"
).split()

ROUNDS = 40
START_PRIOR, LEAST_PRIOR = 0.8, 0.01
# On good texts and on bad ones. The least ones keep a vote for bad from speaking for good.
START_ACCURACY, LEAST_ACCURACY, MOST_ACCURACY = (0.95, 0.4), (0.7, 0.35), 0.995
BELIEF = 10.0
KEEP_FROM = 0.5


def _windows(words: str) -> Column:
    """A hash of each window of five words; none in shorter texts."""
    parts = ", ".join(f"get({words}, i + {k})" for k in range(WINDOW))
    return F.expr(
        f"CASE WHEN size({words}) >= {WINDOW} THEN"
        f" transform(sequence(0, size({words}) - {WINDOW}), i -> xxhash64({parts}))"
        " ELSE cast(array() AS array<bigint>) END"
    )


def text_counts(docs: DataFrame, *carried: Column) -> DataFrame:
    """The carried columns and counts on the words, symbols, lines and windows of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.struct(*carried).alias("row"), text.alias("text"))
    split = base.select(
        "row",
        "text",
        F.expr("filter(split(text, '[ \\\\x09-\\\\x0D]+'), w -> w != '')").alias("words"),
        F.expr("filter(split(text, '\\n'), l -> l rlike '[^ \\\\x09-\\\\x0D]')").alias("lines"),
    )
    hashed = split.select(
        "row",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.expr("length(array_join(words, ''))").cast("long").alias("word_chars"),
        F.expr(f"regexp_count(text, '[{SYMBOLS}]')").cast("long").alias("n_symbols"),
        F.expr("regexp_count(text, '\\\\p{Lu}')").cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.size(F.array_intersect("words", F.lit(FUNCTION_WORDS))).cast("long").alias("n_common"),
        _windows("words").alias("windows"),
    ).drop("words")
    # Most texts have no window twice; only in the others windows are sorted.
    ordered = hashed.withColumn(
        "windows",
        F.expr(
            "CASE WHEN size(array_distinct(windows)) < size(windows)"
            " THEN array_sort(transform(windows, (h, i) -> struct(h AS h, i AS i)))"
            " ELSE cast(array() AS array<struct<h: bigint, i: int>>) END"
        ),
    )
    places = ordered.withColumn(
        "windows",
        F.expr(
            "array_sort(transform(filter(windows, (x, k) ->"
            " x.h <=> get(windows, k - 1).h OR x.h <=> get(windows, k + 1).h), x -> x.i))"
        ),
    )
    # Each place covers its words up to the next place.
    covered = f"least({WINDOW}, coalesce(get(windows, k + 1) - p, {WINDOW}))"
    return places.withColumn(
        "n_repeat_words",
        F.expr(f"aggregate(transform(windows, (p, k) -> {covered}), 0L, (a, x) -> a + x)"),
    ).drop("windows")


def base_failed() -> Column:
    """Too short, or more than a fifth of the words in windows that occur again."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """What each rule says, from the counts of a text."""
    n, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    repeats, common = F.col("n_repeat_words"), F.col("n_common")
    capitals, dup, lines = F.col("n_capitals"), F.col("n_dup_lines"), F.col("n_lines")
    return {
        "few_symbols": _vote(50 * symbols <= n, 5 * symbols > n),
        "word_length": _vote((chars >= 2 * n) & (chars <= 12 * n), (chars < 2 * n) | (chars > 16 * n)),
        "distinct_lines": _vote((lines > 1) & (dup == 0), 4 * dup > lines),
        "distinct_windows": _vote((n >= 20) & (repeats == 0), 10 * repeats > n),
        "length": _vote(n >= 40, n < 15),
        "lower_case": _vote(5 * capitals <= chars, 2 * capitals > chars),
        "function_words": _vote(common >= 2, (common == 0) & (n >= 15)),
    }


RULES = (
    "few_symbols",
    "word_length",
    "distinct_lines",
    "distinct_windows",
    "length",
    "lower_case",
    "function_words",
)


def with_votes(docs: DataFrame, *carried: Column) -> DataFrame:
    """The carried columns in `row`, the counts and a column of each rule's vote."""
    counts = text_counts(docs, *carried)
    return counts.select("*", *[vote.cast("int").alias(name) for name, vote in votes().items()])


def _weights(accuracy) -> tuple[float, float]:
    """What a vote for good and a vote for bad add to the log odds of being good."""
    good, bad = accuracy
    return math.log(good / (1 - bad)), math.log((1 - good) / bad)


def _posterior(pattern, prior: float, weights) -> float:
    odds = math.log(prior / (1 - prior))
    for vote, (for_good, for_bad) in zip(pattern, weights, strict=True):
        odds += for_good if vote > 0 else for_bad if vote < 0 else 0.0
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int = len(RULES)):
    """The share of good texts and each rule's accuracies, by expectation-maximisation.

    patterns: votes in the order of the rules, and how many texts have them. A rule has two
    accuracies, how often it is right when it speaks on a good text and when it speaks on a bad one:
    most rules catch one kind of bad text and call all others good. A rule that never votes keeps
    the accuracies that all start from.
    """
    prior, accuracy = START_PRIOR, [START_ACCURACY] * rules
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS if total else 0):
        weights = [_weights(a) for a in accuracy]
        good = 0.0
        # Right and spoken, on good texts and on bad ones.
        tally = [[0.0] * 4 for _ in range(rules)]
        for pattern, n in sorted(patterns):
            p = _posterior(pattern, prior, weights)
            good += n * p
            for seen, vote in zip(tally, pattern, strict=True):
                if vote:
                    seen[0] += n * p * (vote > 0)
                    seen[1] += n * p
                    seen[2] += n * (1 - p) * (vote < 0)
                    seen[3] += n * (1 - p)
        prior = min(max(good / total, LEAST_PRIOR), 1 - LEAST_PRIOR)
        # A few texts' worth of the starting belief keep a rule that seldom speaks in bounds.
        accuracy = [
            tuple(
                min(max((right + BELIEF * start) / (spoken + BELIEF), low), MOST_ACCURACY)
                for right, spoken, start, low in (
                    (seen[0], seen[1], START_ACCURACY[0], LEAST_ACCURACY[0]),
                    (seen[2], seen[3], START_ACCURACY[1], LEAST_ACCURACY[1]),
                )
            )
            for seen in tally
        ]
    return prior, accuracy


def fit(voted: DataFrame):
    """`estimate` from the votes of all rows."""
    rows = voted.groupBy(*RULES).count().collect()
    return estimate([(tuple(r[name] for name in RULES), r["count"]) for r in rows])


def quality(prior: float, accuracy) -> Column:
    """Probability that a text with these votes is good."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, rule in zip(RULES, accuracy, strict=True):
        for_good, for_bad = _weights(rule)
        vote = F.col(name)
        odds = odds + F.when(vote > 0, for_good).when(vote < 0, for_bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judged(voted: DataFrame, model) -> DataFrame:
    """With base_failed, quality and kept."""
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("quality", quality(*model))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, votes, probability of being good, and verdict."""
    voted = written(with_votes(docs, F.col("doc_id")), "quality-votes")
    return judged(voted, fit(voted)).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
        *RULES,
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns, whatever their names.

    Null and empty texts have no words and go; rows that repeat share one verdict.

    Votes are written beside the rows before any row is dropped: a filter on the verdict would
    otherwise be moved below the counts and work them out anew for every word.
    """
    voted = written(with_votes(docs, *every_column(docs)), "quality-votes", "zstd")
    return judged(voted, fit(voted)).where("kept").select("row.*")
