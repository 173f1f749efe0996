"""One local session for all tests, and the small tables as DuckDB views."""

import duckdb
import pytest

from vitrine.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, **{"spark.checkpoint.dir": f"file://{shared}", "spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return [_plain(x) for x in value]
    return value


@pytest.fixture(scope="session")
def same():
    """Compares the rows of a Spark result and a DuckDB result, by column name and in any order."""

    def check(df, con, sql):
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(repr([_plain(r[names.index(c)]) for c in df.columns]) for r in result.fetchall())
        got = sorted(repr([_plain(x) for x in r]) for r in df.collect())
        assert got == want

    return check
