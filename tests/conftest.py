import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pricegrid.session import build_session
    # tests only: the catalog's warehouse goes to a scratch folder, not the repo
    s = build_session("local[4]", "pricegrid-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="pg-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from pricegrid.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
