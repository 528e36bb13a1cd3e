"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


def compare(spark, sf_dir, query, sql):
    """Rows of a query and of its DuckDB SQL as sorted lists of strings, by column name."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")

    def cell(v):
        if hasattr(v, "tolist") and not isinstance(v, int | float):
            v = v.tolist()
        if isinstance(v, list):
            return str(v)
        if pd.isna(v):
            return "-"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    def rows(df):
        names = sorted(df.columns)
        return names, sorted(tuple(cell(v) for v in r) for r in df[names].astype(object).itertuples(index=False))

    return rows(query(spark, sf_dir).toPandas()), rows(con.execute(sql).fetchdf())
