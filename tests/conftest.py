import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from credtrail.session import get_session
    s = get_session("credtrail-tests", master="local[*]", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="credtrail-tests-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def catalog(spark):
    from credtrail.plans.catalog import Catalog
    return Catalog(spark, SF_SMALL)
