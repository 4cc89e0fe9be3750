import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierstar.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        "tierstar-tests",
        spark__checkpoint__dir=str(folder),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__sql__shuffle__partitions="4",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    """The star of the tiny shop, computed once."""
    from helpers import shop
    from test_star import star_of

    return {name: df.cache() for name, df in star_of(spark, shop(spark)).items()}
