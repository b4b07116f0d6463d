import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONPATH", str(ROOT))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewell.session import build_session

    session = build_session(
        "tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def store(spark, tmp_path):
    from tidewell.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "tables"))
