import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidemark import session

    made = session.build(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def work():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def land(spark, work):
    """Write frames as single files, each one later than the one before."""

    def write(frames, name="in"):
        target = Path(work) / name
        target.mkdir()
        for place, frame in enumerate(frames):
            part = Path(work) / f"{name}-{place}"
            frame.coalesce(1).write.parquet(str(part))
            (source,) = part.glob("*.parquet")
            path = target / f"{place:04d}.parquet"
            path.write_bytes(source.read_bytes())
            os.utime(path, (1_700_000_000 + place, 1_700_000_000 + place))
        return str(target)

    return write
