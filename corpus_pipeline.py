"""From raw documents to packed training sequences, in stages.

Each stage works on all rows that the one before kept; all but the last return the columns of the
documents.
"""

import public_tokenizers

from tillflow.llm.minhash_dedup import one_of_each
from tillflow.llm.packing import pack_documents
from tillflow.llm.quality_classifier import selected_documents
from tillflow.llm.quality_rules import good_documents
from tillflow.llm.storage import table, written
from tillflow.llm.substring_dedup import without_repeats


def quality_rules(spark, docs, sf_dir):
    """Documents that the weighted vote of the rules calls good."""
    return good_documents(docs)


def quality_classifier(spark, docs, sf_dir):
    """Documents that are more likely than not of a grade worth keeping."""
    return selected_documents(docs, table(spark, sf_dir, "labels"))


def minhash_dedup(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the least doc_id."""
    return one_of_each(docs)


def substring_dedup(spark, docs, sf_dir):
    """Documents without the passages that earlier ones have."""
    return without_repeats(docs)


def packing(spark, docs, sf_dir):
    """Pieces of documents in sequences along the curve."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_dedup", minhash_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# Training and encoding are beyond SQL. Tests hold counts of the rules, near documents, repeated passages
# and packing against plain versions; the verdict of the rules and the classifier's choice have none.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, on the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
