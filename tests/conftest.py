import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forkline.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="forkline-warehouse-")
    session = local_session(8, 4, **{"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": f"{warehouse}/shared"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def chain(spark):
    from forkline.fixtures import Chain
    return Chain(spark, SF)
