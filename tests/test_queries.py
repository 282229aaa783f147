"""Every registered query with SQL against DuckDB on the smallest tables."""

import datetime
import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat()[:19] if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n in entry.oracle_sql() and n in __import__("sheafline.plans.catalog", fromlist=["x"]).QUERIES))
def test_against_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    r = c.sql(entry.oracle_sql()[name])
    cols, want_cols, want = sorted(df.columns), r.columns, r.fetchall()
    assert cols == sorted(want_cols)
    at = [want_cols.index(k) for k in cols]
    assert Counter(tuple(plain(x[k]) for k in cols) for x in df.collect()) == Counter(tuple(plain(x[i]) for i in at) for x in want)


def test_entry_and_rest_without_llm(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert "p1_found" in entry.queries()


def test_documents_without_a_title_are_named_by_a_header(spark):
    got = entry.queries()["ranked_hints"](spark, SF).where("hint_type = 'page_header_candidate'")
    assert got.count() > 0 and got.where("target_field <> 'product_name' or confidence <> 0.58").count() == 0
    assert got.count() == got.select("doc_id").distinct().count()
