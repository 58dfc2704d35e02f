import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import local_session  # noqa: E402

TESTDATA = Path(os.environ.get("TIDEMARK_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tidemark-tests",
        cores="4",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("no test data")
    return str(TESTDATA)
