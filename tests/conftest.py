import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from talkloom.session import local_session

    session = local_session(
        4,
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    """Rows as sorted text, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    none = lambda x: None if x is None or x != x else x
    return sorted(str([none(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="session")
def same(spark, duck, sf_dir):
    def check(query, sql):
        df = query(spark, sf_dir)
        got = duck.sql(sql)
        assert sorted(df.columns) == sorted(got.columns)
        assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(got.fetchall(), got.columns)

    return check
