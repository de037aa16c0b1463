import glob
import os

import duckdb
import pytest

from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_both_engines_agree(spark, data, name):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, data)
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(map(tuple, cursor.fetchall()))
