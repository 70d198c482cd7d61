import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapeworks import session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="tapeworks-tests-") as shared:
        built = session.build(
            "tests",
            **{
                "spark.master": "local[8]",
                "spark.sql.shuffle.partitions": "4",
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.checkpoint.dir": shared,
                "spark.sql.warehouse.dir": shared + "/warehouse",
                "spark.driver.memory": "4g",
                "spark.sql.maxMetadataStringLength": "2000",
            },
        )
        built.sparkContext.setLogLevel("ERROR")
        yield built
        built.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "data")
