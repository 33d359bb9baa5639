import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from glebe.session import build_session, scratch_path  # noqa: E402
from glebe.sources import fs  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def landing_dir(spark):
    """A fresh landing directory and a writer of small CSV files into it."""
    d = scratch_path(spark, "test-landing")
    fs.mkdirs(spark, d)

    def put(name: str, text: str) -> str:
        fs.write_small_text(spark, f"{d}/{name}", text)
        return f"{d}/{name}"

    return d, put
