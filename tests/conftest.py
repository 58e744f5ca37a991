import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vecloom.session import get_session  # noqa: E402
from vecloom.testing import seeded_model  # noqa: E402

WORDS = "a the of what is how does engine car work light speed capital france book plot year first hello world".split()


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    session = get_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def minilm(tmp_path_factory):
    return seeded_model(str(tmp_path_factory.mktemp("minilm")), "embed", WORDS)


@pytest.fixture(scope="session")
def jina(tmp_path_factory):
    return seeded_model(str(tmp_path_factory.mktemp("jina")), "embed_jina", WORDS, layers=1)
