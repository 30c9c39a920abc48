import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from vidpulse.session import build_session  # noqa: E402

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "vidpulse-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="2000",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip(f"no test tables at {DATA}")
    return str(DATA)
