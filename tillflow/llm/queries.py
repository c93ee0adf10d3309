"""Query names of the operators, on the given tables."""

from __future__ import annotations

import public_tokenizers

from tillflow.llm import oracle
from tillflow.llm.bpe import digest_documents
from tillflow.llm.conversations import repair_conversations
from tillflow.llm.embedding_dedup import near_vectors
from tillflow.llm.hmm_scoring import score_documents
from tillflow.llm.language_id import language_id
from tillflow.llm.merkle import merkle_manifest
from tillflow.llm.minhash_dedup import near_documents
from tillflow.llm.packing import pack_documents
from tillflow.llm.quality_classifier import quality_classifier
from tillflow.llm.quality_rules import quality_rules
from tillflow.llm.sharding import shard_rows
from tillflow.llm.storage import table
from tillflow.llm.substring_dedup import substring_dedup
from tillflow.llm.toxicity import toxicity


def _on_documents(operator, *more):
    return lambda spark, folder: operator(table(spark, folder, "documents"), *more)


def _on_labelled(operator):
    return lambda spark, folder: operator(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


QUERIES = {
    "op1_embedding_dedup": lambda spark, folder: near_vectors(table(spark, folder, "embeddings")),
    "op2_minhash_dedup": _on_documents(near_documents),
    "op3_toxicity": _on_labelled(toxicity),
    "op4_quality_classifier": _on_labelled(quality_classifier),
    "op5_hmm_scoring": _on_documents(score_documents),
    "op6_bpe": _on_documents(digest_documents, public_tokenizers.path("word_bpe_49k.json")),
    "op7_sharding": _on_documents(shard_rows),
    "op8_quality_rules": _on_documents(quality_rules),
    "op9_substring_dedup": _on_documents(substring_dedup),
    "op10_packing": _on_documents(pack_documents, public_tokenizers.path("byte_bpe_50k.json")),
    "op11_merkle_manifest": _on_documents(merkle_manifest),
    "op12_conversation_repair": lambda spark, folder: repair_conversations(
        table(spark, folder, "conversations")
    ),
    "op13_language_id": _on_documents(language_id),
}

ORACLE_SQL = oracle.SQL
