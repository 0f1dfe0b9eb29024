import sys
import tempfile

import pytest

sys.path.insert(0, "/root/repo")


@pytest.fixture(scope="session")
def spark():
    from skyfare.session import build_session
    s = build_session("local[4]", app="skyfare-tests", shuffle_partitions=8,
                      extra={"spark.sql.session.timeZone": "UTC"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skyfare-test-", dir="/tmp"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
