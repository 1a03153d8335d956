from __future__ import annotations

import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recspark import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def transactions(spark):
    """A few purchases with one customer who bought far more than anybody else."""
    import datetime as dt

    bought = {1: range(60), 2: range(10), 3: range(20, 26), 4: [3], 5: range(50, 60)}
    first = dt.date(2020, 1, 1)
    rows = [
        (f"c{c}", a, first + dt.timedelta(days=(c * 7 + a) % 100), 1.0 + a % 5, 1 + a % 2)
        for c, articles in bought.items()
        for a in articles
    ]
    schema = "customer_id string, article_id bigint, t_dat date, price double, sales_channel_id int"
    return spark.createDataFrame(rows, schema)
