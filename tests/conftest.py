import pytest

from casona.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("casona-tests", cores="8", shuffle_partitions=8)
    yield session
    session.stop()
