import pytest

from starloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()
