import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cadence.session import local_session
    session = local_session("*", shuffle_partitions=8, app="cadence-tests",
                            checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()
