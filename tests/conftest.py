import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from polikit.session import local_session
    # many small queries: quick compilation counts for more than fast code
    s = local_session(4, shuffle_partitions=4, app="polikit-tests", driver_memory="4g",
                      extra={"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="polikit-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="polikit-test-", dir="/tmp")


@pytest.fixture(scope="session")
def built(spark):
    """``built(key, sf)``: the result of a registered query, made once (making some runs whole jobs)."""
    made = {}

    def get(key, sf=SMOKE):
        import __spark_entry__ as E
        if (key, sf) not in made:
            made[key, sf] = E.queries()[key](spark, sf)
        return made[key, sf]
    return get
