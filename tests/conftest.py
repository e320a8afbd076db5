import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.tessera.base.dir", tempfile.mkdtemp(prefix="tessera-test-"))
    import tessera

    tessera.ensure_local_dirs(s)
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
