import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from linkloom.runtime import local_session

    session = local_session("4", partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import glob

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{src}'")
    return con
