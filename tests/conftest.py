import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from textloom.tables import ship

    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "3g").config("spark.checkpoint.dir", f"file://{home}/shared").config("spark.sql.warehouse.dir", f"{home}/warehouse").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(value):
    """Values that compare across engines."""
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6)
    return value


def same(spark_df, relation):
    names = sorted(spark_df.columns)
    assert names == sorted(relation.columns)
    key = lambda row: [(v is None, str(v)) for v in row]
    left = sorted((tuple(plain(r[c]) for c in names) for r in spark_df.collect()), key=key)
    order = [relation.columns.index(c) for c in names]
    right = sorted((tuple(plain(row[i]) for i in order) for row in relation.fetchall()), key=key)
    assert left == right
