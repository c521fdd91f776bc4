import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestack.session import session

    s = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    """Compares a query with its SQL on the smallest tables, in any order of rows."""

    def check(run, sql):
        df = run(spark, str(DATA / "sf0.001"))
        ref = duck.sql(sql)
        assert sorted(df.columns) == sorted(ref.columns)
        cols = sorted(df.columns)
        mine = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
        place = [ref.columns.index(c) for c in cols]
        theirs = sorted((tuple(plain(r[i]) for i in place) for r in ref.fetchall()), key=repr)
        assert mine == theirs

    return check
