import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loanmart.session import checkpoint_dir, get_session
    warehouse = tempfile.mkdtemp(prefix="loanmart-wh-")
    s = get_session(master="local[*]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": warehouse,
                           "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}"})
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="loanmart-test-")
