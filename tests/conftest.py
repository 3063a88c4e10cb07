from __future__ import annotations

import pytest

from reqloom import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "reqloom-tests",
        "local[4]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def requests(spark):
    from reqloom.plans import inputs

    return inputs.requests(spark, SMALL)


def rows_of(df) -> list[tuple]:
    """Rows as sorted tuples, floats rounded, for order-free comparison."""
    columns = sorted(df.columns)

    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=repr)
