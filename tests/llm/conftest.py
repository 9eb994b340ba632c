import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def docs(spark):
    """Build documents from (id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, source="s"):
        full = [(i, t, "en", source, "x", 1, 0.5, 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, id string, row int, score double, batch int")

    return make


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no benchmark tables here")
    return SF


