import pytest

from afterglow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, **{"spark.driver.host": "127.0.0.1"})
    session.sparkContext.setLogLevel("ERROR")
    return session
