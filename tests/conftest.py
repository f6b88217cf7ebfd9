import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


def _defaults_name_checkpoint_dir() -> bool:
    import pyspark

    path = os.path.join(os.path.dirname(pyspark.__file__), "conf", "spark-defaults.conf")
    return os.path.exists(path) and "spark.checkpoint.dir" in open(path).read()


@pytest.fixture(scope="session")
def spark():
    extra = {"spark.default.parallelism": "4"}
    if not os.environ.get("SPARK_CONF_DIR") and not _defaults_name_checkpoint_dir():
        # tests own their shared folder only where the environment names none
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerlake-test-")
    s = build_session("local[4]", app_name="ledgerlake-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlake-t-")
