"""The stages of the pipeline and the operators on odd columns and odd hashes."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm import substring_dedup
from tillflow.llm import packing
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ODD = ["_id", "_key", "row", "n chars", "a-b", "grade", "spans", "left", "group", "curve", "tie", "a`b"]


@pytest.fixture(scope="module")
def odd_columns(spark, tmp_path_factory):
    """The documents with further columns whose names are odd or used on the way."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = {name: F.lit(k) for k, name in enumerate(ODD)}
    docs.select("*", *[v.alias(k) for k, v in extra.items()]).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "conversations"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages_carry_odd_columns(spark, odd_columns):
    docs, plain = (
        spark.read.parquet(f"{f}/documents.parquet") for f in (odd_columns, FOLDER)
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, odd_columns)
        assert found.columns == docs.columns
        kept = {r.doc_id: tuple(r)[5:] for r in found.collect()}
        expected = {r.doc_id for r in stage(spark, plain, FOLDER).collect()}
        assert set(kept) == expected and expected
        assert set(kept.values()) == {tuple(range(len(ODD)))}
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, odd_columns).count() >= docs.count()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("op1_")])
def test_operators_on_odd_columns(spark, odd_columns, name):
    same = QUERIES[name](spark, FOLDER).columns
    assert QUERIES[name](spark, odd_columns).columns == same
    assert QUERIES[name](spark, odd_columns).count() > 0


def test_packing_of_texts_that_hash_near_the_end_of_the_range(spark):
    """The hash of this text and the number of a row in a late partition add up to no long."""
    docs = spark.range(28).select(
        F.col("id").alias("doc_id"), F.lit("text 61876875").alias("text")
    )
    docs = docs.repartitionByRange(28, "doc_id")
    assert docs.select(F.max(F.xxhash64("text") - (1 << 62))).first()[0] > (1 << 62) - (1 << 36)
    rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(r.doc_id for r in rows if r.start == 0) == list(range(28))


def test_equal_texts_repeat_the_first_whole(spark):
    long, other = (" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b"))
    rows = [(5, long), (3, long), (9, long), (9, long), (9, other), (4, "short text"), (6, "short text")]
    rows += [(2, other + " tail"), (7, None), (None, long)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = sorted((r.doc_id, [tuple(s) for s in r.spans], list(r.first_ids)) for r in found.collect())
    assert spans == [(5, [(0, 60)], [3]), (9, [(0, 60)], [2]), (9, [(0, 60)], [3])]
