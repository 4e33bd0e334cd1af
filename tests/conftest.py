import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from peakflow.session import local_session
    base = tmp_path_factory.mktemp("spark")
    s = local_session("*", shuffle_partitions=8, extra={"spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
