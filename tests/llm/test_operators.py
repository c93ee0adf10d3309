"""Operators on documents and vectors against plain versions, and on awkward tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tillflow.llm import bpe, hmm_scoring, packing, quality_rules, sharding, substring_dedup
from tillflow.llm import embedding_dedup, fitting, minhash_dedup, quality_classifier
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Nulls, empty and long texts, ties, repeated rows, and columns that clash with inner names."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    long_text = " ".join(f"word{k % 977}" for k in range(20000))
    rows = [(1, ""), (2, None), (None, "a text without an id"), (3, long_text), (4, long_text)]
    rows += [(5, "same " * 12), (5, "same " * 12), (6, "x" * 30000), (7, " \n\t "), (8, "é漢 <|endoftext|>")]
    rows = [(i, t, None, None, None, i, "row") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, row string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 0, 0), (3, 1, 1), (3, 1, 0), (None, 1, 1), (4, None, None), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    nan = float("nan")
    vectors = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [], 1)]
    vectors += [(6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None)]
    vectors += [(1, [1.0, 0.0], 1), (10, [1.0, 0.1, 0.0], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    turns = [(1, 0, "user", "Who?", 1), (1, 0, "user", "Who?", 1), (2, None, None, None, None)]
    turns += [(None, 1, "", "", 2), (3, 0, "assistant", long_text, 3), (4, 9, "system", "\t", 4)]
    spark.createDataFrame(
        turns, "conv_id long, turn long, role string, text string, number long"
    ).write.parquet(f"{folder}/conversations.parquet")
    empty = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    return folder, empty


@pytest.mark.parametrize("name", QUERIES)
def test_awkward_rows_and_empty_tables(spark, awkward, name):
    folder, empty = awkward
    rows = QUERIES[name](spark, folder).count()
    expected = {"op1_embedding_dedup": 11, "op10_packing": rows, "op12_conversation_repair": 5}
    assert rows == expected.get(name, 10)
    assert QUERIES[name](spark, empty).count() == 0


def test_pipeline_on_awkward_tables(spark, awkward):
    """The rules reject all of them; nothing fails on the way."""
    assert [corpus_pipeline.run(spark, f).collect() for f in awkward] == [[], []]


def test_pipeline_keeps_clean_documents(spark, texts):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows}
    clean = [k for k, q in labels.items() if q == 1 and len(texts[k].split()) >= 20]
    assert len(kept & set(clean)) > 0.75 * len(clean)  # copies of others and junk go
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_awkward_vectors(spark, awkward):
    vectors = spark.read.parquet(f"{awkward[0]}/embeddings.parquet")
    rows = embedding_dedup.near_vectors(vectors).collect()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert found.pop(1) == (2, 1, True) and found.pop(2) == (2, 1, False)
    assert all(value == (0, key, True) for key, value in found.items())


def test_rule_counts(spark, texts):
    rows = QUERIES["op8_quality_rules"](spark, FOLDER).collect()
    for row in rows:
        words = WORD.findall(texts[row.doc_id])
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        counts = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
        lines = [x for x in texts[row.doc_id].split("\n") if WORD.search(x)]
        symbols = sum(c in "#*$%&|<>" for c in texts[row.doc_id])
        expected = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert found == expected
        assert row.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (row.kept and row.base_failed)
    assert len(rows) == len(texts)


def test_estimated_accuracies_tell_a_good_rule_from_a_random_one():
    patterns = [((1, 1, 1), 80), ((1, 1, -1), 40), ((-1, -1, 1), 6), ((-1, -1, -1), 6), ((1, -1, 0), 2)]
    prior, accuracy = quality_rules.estimate(patterns, 3)
    assert 0.8 < prior < 0.97 and accuracy[0][1] > accuracy[2][1]


def test_shards_are_a_permutation():
    for n in (1, 2, 5, 1000, 4097):
        places = sharding.permute(np.arange(n), n)
        assert sorted(places) == list(range(n))
        assert (sharding.restore(places, n) == np.arange(n)).all()
    assert sharding.row_at(3, 2, 1000) == int(np.flatnonzero(sharding.permute(np.arange(1000), 1000) == 51)[0])


def test_shards(spark, texts):
    rows = QUERIES["op7_sharding"](spark, FOLDER).collect()
    slots = {}
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(data) + 8, zlib.crc32(data))
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_encoding_and_decoding(spark, texts):
    codec = bpe.tokenizer(WORDS)
    for row in QUERIES["op6_bpe"](spark, FOLDER).collect():
        ids = codec.encode(texts[row.doc_id], add_special_tokens=False).ids
        text = codec.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), *digests)


def test_joins_of_long_unsplit_text():
    codec, rng = bpe.tokenizer(WORDS), np.random.default_rng(5)
    parts = ["a", "the", "'s", "'", "!", "é", "é", "1", "<|endoftext|>", "漢字", "ing", "aaaa", "'re", "İ"]
    tree = bpe.Encoder(WORDS, leaf=16, window=16)
    for k in range(150):
        text = "".join(rng.choice(parts, size=60))
        if k % 3 == 0:
            text = f"some words {text} and more  {text[:20]} of them"
        ids = codec.encode(text, add_special_tokens=False).ids
        assert [i for word in tree.encode([text])[0] for i in word.ids] == ids


class Counted:
    """A tokenizer that counts the characters it gets."""

    def __init__(self, codec):
        self.codec, self.signs = codec, 0

    def encode(self, text, **options):
        self.signs += len(text)
        return self.codec.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.signs += sum(map(len, texts))
        return self.codec.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("length", [8_000, 64_000, 1_000_000])
def test_halves_are_encoded_once(length):
    """Of a run without white space little more than the run itself is encoded, at any length."""
    codec, rng = bpe.tokenizer(WORDS), np.random.default_rng(6)
    parts = ["the", "ing", "a", "!", "tion", "x", "1", "é", "'s", "qu", "漢"]
    text = "".join(rng.choice(parts, size=length // 2))[:length]
    tree = bpe.Encoder(WORDS)
    tree.codec = Counted(codec)
    (words,) = tree.encode([text])
    assert [i for w in words for i in w.ids] == codec.encode(text, add_special_tokens=False).ids
    assert tree.codec.signs < 1.5 * len(text)


def test_packing(spark, texts):
    codec = Tokenizer.from_file(BYTES)
    ids = {k: codec.encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()}
    rows = QUERIES["op10_packing"](spark, FOLDER).collect()
    for row in rows:
        piece = np.array(ids[row.doc_id][row.start : row.start + row.length], dtype="<u4")
        assert zlib.crc32(piece.tobytes()) == row.ids_crc32 and row.doc_tokens == len(ids[row.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    ends = {}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(row.sequence_id, 0) == row.offset
        ends[row.sequence_id] = row.offset + row.length
    assert sorted(ends.values())[1:] == [1024] * (len(ends) - 1)


def test_curve_visits_every_cell_by_single_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    path = cells[np.argsort(packing.hilbert_key(cells, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_base_scores(spark, texts):
    tokens = {k: [w.lower() for w in t.encode().split()] + [b"\n"] for k, t in texts.items()}
    training = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for k in training for w in tokens[k])
    total = sum(counts.values())
    rows = QUERIES["op5_hmm_scoring"](spark, FOLDER).collect()
    for row in rows:
        c = np.array([counts[w] for w in tokens[row.doc_id]])
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(c), (c > 0).sum(), total)
        assert row.base_score == pytest.approx(np.log10((c + 1) / (total + len(counts) + 1)).sum())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_recursion_sums_over_all_paths():
    model = hmm_scoring.first_model(np.array([3.0, 1.0, 2.0]), states=2)
    symbols = [0, 2, 1, 0]
    paths = np.stack(np.meshgrid(*[[0, 1]] * 4), axis=-1).reshape(-1, 4)
    total = 0.0
    for path in paths:
        chance = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for k in range(1, 4):
            chance *= model.step[path[k - 1], path[k]] * model.emit[symbols[k], path[k]]
        total += chance
    seqs = hmm_scoring.Sequences([np.array(symbols, dtype="<u2").tobytes(), b"\0\0"])
    found = hmm_scoring.log10_likelihoods(model, seqs)
    assert found[0] == pytest.approx(np.log10(total))
    assert found[1] == pytest.approx(np.log10((model.start * model.emit[0]).sum()))


def _shingles(text):
    words = WORD.findall(text)
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def test_near_documents(spark):
    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in rng.integers(5000, size=120)]
    rows = []
    for k in range(60):
        words = list(base) if k % 4 else [f"v{x}" for x in rng.integers(5000, size=80)]
        for at in rng.integers(len(words), size=k % 9):
            words[at] = f"z{rng.integers(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(100, rows[5][1]), (101, rows[5][1])]
    shingles = {k: _shingles(t) for k, t in rows}
    group = {k: k for k, _ in rows}
    for _ in rows:  # least id of all that links reach
        for a in shingles:
            for b in shingles:
                if sum((shingles[a] & shingles[b]).values()) >= 0.8 * sum((shingles[a] | shingles[b]).values()):
                    group[a] = min(group[a], group[b])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in minhash_dedup.near_documents(df).collect()}
    assert {k: r.component_id for k, r in found.items()} == group
    assert all(r.kept == (k == group[k]) for k, r in found.items())


def test_compact_windows_hold_the_least_hash_of_every_stretch():
    rng = np.random.default_rng(3)
    codes, of = rng.integers(1 << 60, size=150, dtype=np.uint64), np.repeat([0, 2, 3], [70, 50, 30])
    value, row, left, right = substring_dedup.compact_windows(codes, of, 0, width=12)
    salted = {}
    for v, r, a, b in zip(value, row, left, right, strict=True):
        salted.setdefault(int(r), []).append((int(a), int(b), int(v)))
    for r, size in ((0, 70), (2, 50), (3, 30)):
        for start in range(size - 12 + 1):
            holding = [w for w in salted[r] if w[0] <= start and start + 11 <= w[1]]
            assert holding


def test_repeated_passages(spark):
    rng = np.random.default_rng(11)
    draw = lambda n: [f"w{x}" for x in rng.integers(10**6, size=n)]
    passage = draw(60)
    near = [*passage[:30], "changed", *passage[31:]]
    rows = [(k, " ".join(draw(40) + (passage if k % 3 else near) + draw(30))) for k in range(9)]
    rows += [(20, " ".join(draw(200))), (21, rows[0][1])]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0].repeated_words == found[20].repeated_words == 0
    assert all((found[k].spans[0].start, found[k].spans[0].end) == (40, 100) for k in range(1, 9))
    assert found[21].repeated_words == 130
    cut = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {r.doc_id: r.text.split() for r in cut.collect()}
    assert 21 not in left and len(left[1]) == 70 and len(left[0]) == 130


def test_vectors_against_all_pairs(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = vectors.collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r.label for r in rows])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    expected = {r.vec_id: int(n) - 1 for r, n in zip(rows, linked.sum(axis=1), strict=True)}
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(vectors).collect()}
    assert found == expected


def test_classifiers_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id].toxic for r in rows]) > 0.93
    rows = [r for r in QUERIES["op4_quality_classifier"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.kept == (labels[r.doc_id].quality == 1) for r in rows]) > 0.97


def test_words_split_as_declared():
    from tillflow.llm.batches import word_hashes

    words, counts = word_hashes(pa.array(["a b\x0bc", None, " \t", "b", "a b"]))
    assert counts.tolist() == [3, 0, 0, 1, 1] and words[1] == words[3]


def plainly_repeated(earlier, later, width=46, least=41):
    """What two lists of shingles give by comparing each stretch with each."""
    there = [Counter(earlier[j : j + width]) for j in range(len(earlier) - width + 1)]
    spans = []
    for i in range(len(later) - width + 1):
        here = Counter(later[i : i + width])
        similar = [x for x in there if sum((x & here).values()) >= least]
        marked = [p for p in range(i, i + width) if any(later[p] in x for x in similar)]
        if marked and spans and i - spans[-1][2] <= width:
            spans[-1][1:] = [marked[-1] + 5, i]
        elif marked:
            spans.append([marked[0], marked[-1] + 5, i])
    return [(start, end) for start, end, _ in spans]


def test_passages_are_verified_against_passages():
    codes = lambda x: np.array(x, dtype=np.uint64)
    rng = np.random.default_rng(13)
    later = rng.permutation(10**4)[:120]
    scattered = np.concatenate([[x, *rng.integers(10**4, 10**6, size=9)] for x in later])
    assert substring_dedup.repeated(codes(scattered), codes(later)) == []
    assert substring_dedup.repeated(codes(range(100)), codes([7] * 60)) == []
    found = 0
    for case in range(60):
        earlier, later = (rng.integers((3, 30, 10**6)[case % 3], size=130).tolist() for _ in "ab")
        part = earlier[20:100]
        for at in rng.integers(80, size=case % 9):
            part[at] = 10**6 + int(at)
        later[30:110] = part[case % 40 :] + part[: case % 40] if case % 2 else part[: -(case % 3) or None]
        expected = plainly_repeated(earlier, later)
        found += bool(expected)
        assert substring_dedup.repeated(codes(earlier), codes(later)) == expected
    assert found > 30


def _words_in_spans(rows):
    return {r.doc_id: {w for s in r.spans for w in range(s.start, s.end)} for r in rows}


def _plain_passages(rows):
    """Words of each document that a passage similar to one of an earlier document covers."""
    kept = {}
    for b, later in rows:
        kept[b] = set()
        for a, earlier in rows:
            if a < b:
                lists = [list(_word_shingles(t)) for t in (earlier, later)]
                if sum((Counter(lists[0]) & Counter(lists[1])).values()) >= 41:
                    for start, end in plainly_repeated(*lists):
                        kept[b].update(range(start, end))
    return kept


def _word_shingles(text):
    words = WORD.findall(text)
    return (tuple(words[k : k + 5]) for k in range(len(words) - 4))


def test_passages_of_chains_and_frequent_lines(spark):
    rng = np.random.default_rng(17)
    draw = lambda n: [f"w{x}" for x in rng.integers(10**6, size=n)]
    rows, k = [], 0
    for _ in range(12):  # each differs from the one before in a word more
        passage = draw(54)
        for step in range(4):
            rows.append((k + step, " ".join(draw(60) + passage + draw(60))))
            passage = list(passage)
            passage[15 + 8 * step] = f"x{k}"
        k += 4
    lines = [draw(9) for _ in range(5)]
    for _ in range(30):  # lines of a stock in any order among other words: no passages
        parts = [[*lines[x], *draw(14)] for x in rng.permutation(5)]
        rows.append((k, " ".join(sum(parts, draw(20)))))
        k += 1
    for _ in range(8):  # passages of frequent lines, in two documents each
        passage = [w for x in rng.permutation(5) for w in [*lines[x], *draw(3)]]
        for _ in range(2):
            rows.append((k, " ".join(draw(20) + passage + draw(50))))
            k += 1
    expected = _plain_passages(rows)
    found = _words_in_spans(
        substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    )
    lost = [b for b in expected if expected[b] - found[b]]
    assert sum(map(bool, expected.values())) > 30
    assert not lost and found == expected


@pytest.mark.parametrize("shared", [41, 42, 44])
def test_functions_agree_on_near_passages(shared):
    """Similarity 0.8 to 0.92; with two of four functions 2.7 % of those at 0.8 were missed."""
    rng, rows, width = np.random.default_rng(19), 4000, substring_dedup.WIDTH
    one = rng.integers(1 << 62, size=(rows, width), dtype=np.uint64)
    other = one.copy()
    other[:, shared:] = rng.integers(1 << 62, size=(rows, width - shared), dtype=np.uint64)
    of, agree = np.repeat(np.arange(rows), width), np.zeros(rows, dtype=int)
    for function in range(substring_dedup.FUNCTIONS):
        left, right = (
            substring_dedup.compact_windows(x.ravel(), of, function)[0] for x in (one, other)
        )
        agree += left == right
    missed = np.mean(agree < substring_dedup.NEEDED)
    assert missed <= 0.001


def test_one_of_each_goes_by_text(spark):
    draw = lambda seed: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(10**6, size=80))
    near = draw(1).replace(draw(1).split()[0], "changed")
    rows = [(1, draw(1)), (1, near), (2, draw(1)), (2, draw(2)), (2, draw(2)), (3, draw(3)), (4, draw(2))]
    rows += [(5, None), (6, " "), (None, draw(1))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, minhash_dedup.one_of_each(df).collect()), key=str)
    first = min((1, draw(1)), (1, near), key=lambda r: hashlib.md5(r[1].encode()).hexdigest())
    expected = [first, (2, draw(2)), (3, draw(3)), (5, None), (6, " "), (None, draw(1))]
    assert found == sorted(expected, key=str)


def test_labels_of_other_documents_do_not_count(spark, monkeypatch):
    """Of ten documents here and a thousand labelled elsewhere, sizes and sample are of the ten."""
    seen = []

    def sample(*args):
        seen.append(fitting.sample(*args))
        return seen[-1]

    monkeypatch.setattr(quality_classifier, "sample", sample)
    docs = spark.createDataFrame([(k, f"text {k % 2} number {k}") for k in range(10)], "doc_id long, text string")
    labels = [(k, k % 2 if k < 10 else 0, 0) for k in range(1000)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    quality_classifier.selected_documents(docs, labels).collect()
    here = [k % 2 for k in range(10) if zlib.crc32(str(k).encode()) % 4 != 2]
    taken, sizes = seen[0]
    assert sizes == [here.count(0), 0, here.count(1)] and taken.count() == len(here)
