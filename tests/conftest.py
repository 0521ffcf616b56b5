import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[4]").appName("tests")
    for k, v in {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(rows):
    """Rows as sorted tuples of text, columns by name, whole numbers alike."""

    def value(v):
        if v is None or str(v) in ("nan", "<NA>", "NaT", "None"):
            return "None"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    cols = sorted(rows.columns)
    return cols, sorted(tuple(value(v) for v in r) for r in rows[cols].astype(object).itertuples(index=False))
