import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from ratingloom.plans import registry

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
WITHOUT_SQL = {
    "m4_mllib_als", "m10_truncated_svd_rank_10", "u3_two_tower", "e4_word2vec", "d6_scree", "d12_embedding_projection", "v6_als_grid_search",
}
SAMPLE = ["p3_dense_subset", "l1_holdout", "n6_item_knn_scores", "k1_top_n", "f1_apriori", "m1_als", "x1_negative_samples", "s1_long_ratings_csv"]


def test_every_query_has_sql_but_the_listed_ones():
    registry.load_all()
    queries, oracles = registry.QUERIES, registry.ORACLES
    assert set(queries) - set(oracles) == WITHOUT_SQL
    assert not set(oracles) - set(queries)
    assert set(queries) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not SF.exists(), reason="needs the driver tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = __spark_entry__.queries()[name](spark, str(SF))
    cursor = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(map(str, (tuple(row) for row in cursor.fetchall())))
    assert sorted(columns) == sorted(got.columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
