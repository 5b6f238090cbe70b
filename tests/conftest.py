import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    tmp = tmp_path_factory.mktemp("spark")
    settings = {
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.sql.session.timeZone": "UTC",
        "spark.sql.warehouse.dir": str(tmp / "warehouse"), "spark.checkpoint.dir": f"file://{tmp}/shared", "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder
    for k, v in settings.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS FROM '{f}'")
    return con


def same(df, con, sql):
    """Whether a frame and a query give the same rows, whatever the order of rows and columns."""
    expected = con.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)

    def rows(found, names):
        at = [names.index(c) for c in sorted(names)]
        return sorted((tuple(round(float(r[i]), 8) if isinstance(r[i], float) else r[i] for i in at) for r in found), key=repr)

    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(expected.fetchall(), expected.columns)
