import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from rosterflow.session import build_session

    scratch = tempfile.mkdtemp(prefix="rosterflow-test-")
    s = build_session("local[*]", app="rosterflow-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                             "spark.local.dir": scratch})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def views(spark):
    from rosterflow.sources.tables import Views

    return Views(spark, SF)
