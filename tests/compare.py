"""Order-free comparison of a Spark result with DuckDB's, column by column name."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return connection


def _key(row):
    return tuple((value is not None, str(value)) for value in row)


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(row) for row in df.select(names).collect()]
    return names, sorted(rows, key=_key)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)
