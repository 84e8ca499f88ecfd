import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cropflow.session import checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    checkpoint_dir(s, local_fallback=True)
    yield s


@pytest.fixture(scope="session")
def models(spark):
    from cropflow.plans.pipeline import driver_models
    return driver_models(spark, SF)


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="cropflow-test-")
