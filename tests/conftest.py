import pytest

from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    found = session()
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
