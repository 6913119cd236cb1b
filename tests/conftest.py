import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-")
    s = SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
    s = s.config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.checkpoint.dir", f"{folder}/checkpoint").getOrCreate()
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return con


@pytest.fixture(scope="session")
def same(spark, sf, duck):
    """Holds a query against its SQL, whatever the order of rows."""

    def cells(df):
        df = df[sorted(df.columns)].astype(object)
        df = df.where(df.notna(), None)
        return sorted(tuple("" if v is None else f"{float(v):.6f}" if isinstance(v, (int, float)) else str(v)[:10] if hasattr(v, "year") else str(v) for v in row) for row in df.itertuples(index=False))

    def check(query, sql):
        got, want = query(spark, sf).toPandas(), duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert cells(got) == cells(want)

    return check
