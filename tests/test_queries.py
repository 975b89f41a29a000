"""Every query over the driver's tables against its SQL."""

import pytest

from talkloom.plans import artifact_queries  # noqa: F401
from talkloom.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(same, name):
    same(QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["hamming_dedup", "hamming_distance"])
def test_hashes_of_odd_vectors(spark, sf_dir, tmp_path, name):
    """A vector without components has no hash, and a frame without a place comes after all others."""
    import duckdb

    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id", "IF(vec_id % 7 = 3, slice(embedding, 1, 0), embedding) AS embedding", "label")
    last = e.where("vec_id = 0").selectExpr("CAST(NULL AS long)", "transform(embedding, (x, i) -> IF(i < 3, -x, x))", "label")
    e.unionAll(last).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    from talkloom.plans.queries import transcript_chunks

    out = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, transcript_chunks(spark, sf_dir).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]
