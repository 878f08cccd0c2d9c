import tempfile

import pytest


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import build_session
    scratch = tempfile.mkdtemp(prefix="tarmac-tests-")
    session = build_session("local[*]", app="tarmac-tests", shuffle_partitions=8,
                            extra={"spark.checkpoint.dir": scratch,
                                   "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from tarmac.session import scratch_path
    return lambda name: scratch_path(spark, name)
