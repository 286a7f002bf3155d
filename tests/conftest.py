import pytest

from quillmere.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", 4, spark__sql__shuffle__partitions="4")
