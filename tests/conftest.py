import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir):
    """Asserts that a query's rows are those of its SQL."""
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    queries, sql = entry.queries(), entry.oracle_sql()

    def plain(v):
        return None if v is None or v != v else f"{v:.9g}" if isinstance(v, (int, float)) and abs(v) < 2**50 else str(v)

    def check(name):
        df = queries[name](spark, sf_dir)
        names = sorted(df.columns)
        got = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
        rel = con.sql(sql[name])
        columns = list(rel.columns)
        assert sorted(columns) == names
        order = [columns.index(c) for c in names]
        assert got == sorted(repr([plain(r[i]) for i in order]) for r in rel.fetchall())

    return check
