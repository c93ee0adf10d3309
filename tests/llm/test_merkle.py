"""The manifest against plain trees."""

import hashlib
import zlib

import pytest

from tillflow.llm import merkle
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha(*row[k : k + 2]) for k in range(0, len(row), 2)])
    return levels


def plain_leaf(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    values = [row["doc_id"], row["source"], row["lang"], n, row["text"]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_manifest(rows):
    """Per row (doc_id, leaf): subroot, root, proof digest, folded root."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [r for r in rows if r["lang"] == lang]
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[lang] = own, plain_levels([plain_leaf(r) for r in own])
    top = plain_levels([trees[lang][1][-1][0] for lang in langs])
    results = []
    for at, lang in enumerate(langs):
        own, levels = trees[lang]
        for k, row in enumerate(own):
            path = [(level, k >> n) for n, level in enumerate(levels[:-1])]
            path += [(level, at >> n) for n, level in enumerate(top[:-1])]
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node, proof = plain_leaf(row, int(hit)), ""
            for level, i in path:
                run = level[i // 2 * 2 : i // 2 * 2 + 2]
                proof += "".join(x for j, x in enumerate(run) if j != i % 2)
                run[i % 2] = node
                node = sha(*run)
            fixed = (levels[-1][0], top[-1][0], sha(proof), node, node == top[-1][0])
            results.append((row["doc_id"], levels[0][k], *fixed))
    return results


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 64, 100])
def test_log_is_in_postorder_and_places_are_computed(n):
    leaves = [sha(str(k)) for k in range(n)]
    levels = plain_levels(leaves)
    log = merkle.append_all(leaves, len(levels) - 1)
    assert len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    places = {}
    for level, row in enumerate(levels):
        for index, digest in enumerate(row):
            places[level, index] = merkle.position(level, index, n)
            assert log[places[level, index]] == digest
    assert sorted(places.values()) == list(range(len(log)))
    for (level, index), place in places.items():
        assert level == 0 or places[level - 1, 2 * index] < place
    steps = merkle.sibling_steps(log, n, len(levels) - 1, [])
    assert all(merkle.fold(leaves[k], steps[k]) == levels[-1][0] for k in range(n))


def result(df):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


@pytest.mark.parametrize("step", [2, 5])
def test_manifest_equals_plain_trees(spark, step):
    """Small blocks take several tiers, in some trees more than in others."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = sorted(plain_manifest([r.asDict() for r in docs.collect()]), key=str)
    assert result(merkle.merkle_manifest(docs, step)) == plain
    if step == 5:
        assert result(QUERIES["op11_merkle_manifest"](spark, FOLDER)) == plain


def test_whole_log(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = merkle.manifest(docs, step=3)
    nodes = merkle.log_nodes(made).collect()
    langs = {r.tree: r.lang for r in made.trees.collect()}
    rows = [r.asDict() for r in docs.collect()]
    for tree, lang in langs.items():
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["doc_id"])
        levels = plain_levels([plain_leaf(r) for r in own])
        found = {(r.level, r["index"]): r.digest for r in nodes if r.tree == tree}
        assert found == {(n, k): d for n, row in enumerate(levels) for k, d in enumerate(row)}
        places = sorted(r.position for r in nodes if r.tree == tree)
        assert places == list(range(len(found)))


def test_nulls_ties_and_small_trees(spark):
    rows = [
        (1, "a", None, 3, "x"), (1, "a", None, 3, "x"), (None, "a", None, 3, "x"), (2, None, "", None, None),
        (7, "é", "zz", -5, "漢字"), (3, "", "zz", 0, ""), (3, "", "zz", 1, ""), (14, "s", "é", (1 << 63) - 1, "t"),
    ] + [(k, "s", "en", k, f"text {k}") for k in range(37)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema)
    plain = plain_manifest([dict(zip(docs.columns, r, strict=True)) for r in rows])
    assert result(merkle.merkle_manifest(docs)) == sorted(plain, key=str)
    assert any(r[-1] for r in plain) and not all(r[-1] for r in plain)
    one = docs.where("doc_id = 14 AND lang = 'é'").withColumn("index", docs["doc_id"])
    (only,) = merkle.merkle_manifest(one).collect()
    assert only.root == only.subroot == only.leaf and only.proof_sha256 == sha()
    assert merkle.merkle_manifest(docs.limit(0)).count() == 0
