import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mesonlab.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_session("mesonlab-tests", "local[*]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
