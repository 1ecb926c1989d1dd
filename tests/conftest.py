import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
                spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"))
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
