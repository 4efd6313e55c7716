import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.session import build_session  # noqa: E402

# checks against the published exports need their folder
collect_ignore = [] if os.environ.get("LAKEMART_PUBLISHED_MARTS") else ["test_published_marts.py"]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", app_name="lakemart-tests", shuffle_partitions=8,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakemart-test-ckpt-"),
               "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakemart-test-wh-")})
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakemart-test-")
