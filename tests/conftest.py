import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mailweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_broadcast(spark):
    """No side counts as small: every join takes its shuffled form."""
    spark.conf.set("spark.mailweave.broadcastBytes", "0")
    yield
    spark.conf.unset("spark.mailweave.broadcastBytes")


@pytest.fixture
def tiny_windows(spark):
    """No group counts as small: every full ranking takes its two-phase form."""
    spark.conf.set("spark.mailweave.windowRows", "0")
    yield
    spark.conf.unset("spark.mailweave.windowRows")
