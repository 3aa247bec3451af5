import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bookshift.session import get_session

    s = get_session("local[4]", 4, app_name="bookshift-tests",
                    extra={"spark.sql.session.timeZone": "America/New_York",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bookshift-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
