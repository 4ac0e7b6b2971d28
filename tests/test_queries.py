import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from lingofold.plans.catalog import QUERIES  # noqa: E402
from tools.check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["s4_parallel_wide", "p3_decode_image_bytes", "p13_dominant_script", "v6_first_error",
         "d4_reassemble", "m2_detect_language", "m4_segment", "m6_tokenize_pad", "k5_margin_score",
         "k7_knn_classify", "a6_chrf", "a9_latency_report", "q1_translate", "language_and_sentences"]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(QUERIES) & set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 4
