import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # The shared folder is one for this run, and in local mode a local one will do.
    base = str(tmp_path_factory.mktemp("scratch"))
    session = build_session("local[8]", "tests", spark__sql__shuffle__partitions="4",
                            spark__ui__showConsoleProgress="false", spark__checkpoint__dir=base,
                            spark__sql__warehouse__dir=f"{base}/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples; None sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
