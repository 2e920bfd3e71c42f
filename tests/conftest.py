import pytest

from prepkit.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as sorted tuples."""
    key = [df.columns.index(c) for c in order] if order else range(len(df.columns))
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(r[i] is not None, r[i]) for i in key])


@pytest.fixture(scope="session")
def listed():
    return rows
