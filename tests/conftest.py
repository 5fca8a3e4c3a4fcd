import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fleetframe.session import create_session

    session = create_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR
