"""Spark result equals the DuckDB oracle on the smallest fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from sifter.sources.tables import TABLES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
FAST = ["label_filter_group", "row_accounting", "duplicate_ids", "dups_distribution",
        "splits_balanced", "splits_hash", "train_sets", "clean_text", "word_counts",
        "vocab_cut", "bow_entropy", "lexicon_scores", "evaluate", "nb_multinomial_exact"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield c
    c.close()


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
