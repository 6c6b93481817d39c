import pytest

from tutelage.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
