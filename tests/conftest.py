import pytest

from verdant.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app="verdant-tests")
    yield session
    session.stop()
