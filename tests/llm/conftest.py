import pytest

from .helpers import ODD


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(
        [(i, t, "en", "score", len(t or "")) for i, t in ODD],
        "doc_id long, text string, lang string, score string, n_chars long")


@pytest.fixture()
def none(odd):
    return odd.limit(0)
