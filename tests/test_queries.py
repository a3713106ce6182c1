"""Every registered query against its SQL, on the smallest tables."""

import hashlib
import os

import duckdb
import pandas as pd
import pytest

from textmill.plans import queries as Q

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list:
    def one(v):
        if not hasattr(v, "__len__") and pd.isna(v):
            return ""
        return f"{float(v):.6f}" if not isinstance(v, (str, bool, bytes, bytearray)) and hasattr(v, "__float__") else str(v)

    return sorted(tuple(one(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", list(Q.queries()))
def test_query(spark, duck, name):
    got = Q.queries()[name](spark, DIR).toPandas()
    if name in Q.oracle_sql():
        want = duck.sql(Q.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_docx_validate_reads_whole_texts(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from textmill.functions import records

    seen = lambda x: F.struct(F.sha2(x, 256).alias("is_valid"))
    monkeypatch.setattr(records, "validate_docx", seen)
    text = "é" * 3000 + "end"
    spark.createDataFrame([(5, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = Q.queries()["docx_validate"](spark, str(tmp_path)).collect()[0]
    assert row.is_valid == hashlib.sha256(b"PK\x03\x04" + text.encode()).hexdigest()
