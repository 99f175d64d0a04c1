"""Fixtures and brute-force pieces shared by the tests of mesonlab.llm."""

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def duck(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).df()


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def same(a: pd.DataFrame, b: pd.DataFrame):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda d: sorted(map(repr, d[cols].astype(object).itertuples(index=False, name=None)))
    assert key(a) == key(b)


def saved(spark, tmp_path, **tables):
    """Frames written as <name>.parquet; the folder's path."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


#: Nulls, empty and blank texts, a very long text, repeated rows, ties.
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six. " * 4000), (5, "Same text here, a few words more."),
        (6, "Same text here, a few words more."), (6, "Same text here, a few words more."), (7, "é ß 漢字 \U0001F600 word"), (8, "x" * 50_000), (None, "no id at all")]
