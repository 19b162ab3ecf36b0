import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
# workers import the library and functions of the tests
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def same_rows(spark, sf):
    """Runs a query in Spark and its SQL in DuckDB and compares names and rows."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")

    def text(df, names):
        rows = df[names].astype(object).where(df[names].notna(), None)
        for c in names:
            rows[c] = [None if x is None else str(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in rows[c]]
        return sorted(map(tuple, rows.itertuples(index=False)), key=str)

    def check(query, sql):
        got, want = query(spark, sf).toPandas(), con.execute(sql).df()
        names = sorted(want.columns)
        assert sorted(got.columns) == names
        assert text(pd.DataFrame(got), names) == text(want, names)

    return check
