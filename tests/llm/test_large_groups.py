"""Near copies of one text whose mutual similarity spreads widely."""

from collections import Counter

import numpy as np

from tillflow.llm import minhash_dedup


def _group(rng, rows):
    """Texts of 120 words with 0 to 39 words changed, some of them in the same way."""
    base = [f"w{k}" for k in range(120)]
    for k in range(rows):
        words = list(base)
        for at in rng.choice(120, size=rng.integers(40) if k % 3 else rng.integers(6), replace=False):
            words[at] = f"z{at}x{rng.integers(10 if k % 5 == 0 else 10**6)}"
        yield k, " ".join(words)


def _least_reached(rows):
    shingles = []
    for _, text in rows:
        words = text.split()
        shingles.append(Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4)))
    kinds = {s: k for k, s in enumerate(set().union(*shingles))}
    has = np.zeros((len(rows), len(kinds)), dtype=np.float32)
    for k, counts in enumerate(shingles):
        has[k, [kinds[s] for s in counts]] = 1
    both, total = has @ has.T, has.sum(axis=1)
    linked = both >= 0.8 * (total[:, None] + total - both) - 1e-4
    group, before = np.arange(len(rows)), None
    while before is None or (group != before).any():
        before, group = group, np.array([group[near].min() for near in linked])
    return group.tolist()


def test_a_large_group_is_settled_without_all_pairs(spark, monkeypatch):
    pairs = []
    verified = minhash_dedup._verified

    def counted(compared, *more):
        pairs.append(compared.count())
        return verified(compared, *more)

    monkeypatch.setattr(minhash_dedup, "_verified", counted)
    monkeypatch.setattr(minhash_dedup, "FEW", 10, raising=False)
    rows = list(_group(np.random.default_rng(3), 700))
    expected = _least_reached(rows)
    assert len(set(expected)) > 200 and expected.count(min(expected)) > 100
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_documents(df).collect()}
    assert [found[k] for k, _ in rows] == expected
    assert sum(pairs) < 20 * len(rows)
