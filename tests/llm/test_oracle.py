"""The SQL of the operators on tables with nulls, ties, repeated and no rows."""

import random

import compare
import duckdb
import pyarrow as pa
import pyarrow.parquet
import pytest

from tillflow.llm import queries

DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())]
    + [("n_chars", pa.int64())]
)
VECTORS = pa.schema(
    [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]
)
ROWS = {
    "documents": [
        (7, "seven sheep", "en", "a", 11),
        (7, "seven sheep", "en", "a", 11),
        (7, "sept moutons", "fr", None, None),
        (14, None, None, "b", 3),
        (None, "no id", None, "b", 5),
        (None, "", "en", "", 0),
        (35, "naïve façade", "fr", "c", 12),
        *[(100 + k, f"text {k % 5}", ("en", "de", "fr")[k % 3], "d", k) for k in range(40)],
        (999, "a long one " * 2000, "de", "d", 22000),
    ],
    "embeddings": [
        (1, [1.0, 0.0], 0),
        (2, [1.0, 0.1], 0),
        (3, [0.9, 0.3], 0),
        (4, [1.0, 0.0], 1),
        (5, [1.0, 0.0], None),
        (6, None, 0),
        (7, [0.0, 0.0], 0),
        (8, [1.0, float("nan")], 0),
        (9, [1.0, None], 0),
        (10, [1.0, 0.0], 0),
        (11, [], 0),
    ],
}
TURNS = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
)
ROLES = ["user", "assistant", "system", "", None, "User", "tool"]
TEXTS = ["Yes.", "No!", "cut", " ", "", None, "Yes.", "Why? \t", "é漢?", "two\nlines."]
DRAW = random.Random(12)
ROWS["conversations"] = [
    (conv, DRAW.choice([turn, turn, None, 3]), DRAW.choice(ROLES), DRAW.choice(TEXTS))
    for conv in [None, *range(60)]
    for turn in range(DRAW.randint(1, 7))
] + [
    (70, -(1 << 63), "user", "A."),
    (70, (1 << 63) - 1, "assistant", "B."),
    *[(71, k, ("user", "assistant")[k % 3 % 2], f"Turn {k}.") for k in range(60)],
]
SCHEMAS = {"documents": DOCUMENTS, "embeddings": VECTORS, "conversations": TURNS}
TABLES = {"op1_embedding_dedup": "embeddings", "op7_sharding": "documents"} | {
    "op11_merkle_manifest": "documents",
    "op12_conversation_repair": "conversations",
}


def test_all_are_covered():
    assert set(queries.ORACLE_SQL) == set(TABLES)


@pytest.mark.parametrize("name", TABLES)
@pytest.mark.parametrize("rows", ["awkward", "one", "none"])
def test_query_equals_sql_on_awkward_rows(spark, tmp_path, name, rows):
    table = TABLES[name]
    chosen = {"awkward": ROWS[table], "one": ROWS[table][:1], "none": []}[rows]
    data = pa.Table.from_pylist(
        [dict(zip(SCHEMAS[table].names, row, strict=True)) for row in chosen], SCHEMAS[table]
    )
    pa.parquet.write_table(data, tmp_path / f"{table}.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW {table} AS FROM '{tmp_path}/{table}.parquet'")
    expected_names, expected = compare.duck_rows(duck, queries.ORACLE_SQL[name])
    names, found = compare.spark_rows(queries.QUERIES[name](spark, str(tmp_path)))
    assert names == expected_names
    assert found == expected
    assert len(found) == (len({row[0] for row in chosen}) if table == "conversations" else len(chosen))
