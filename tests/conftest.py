import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tandem.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="tandem-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat(spark):
    from tandem.sources.adapter import driver_catalog
    return driver_catalog(spark, SF_SMALL)
