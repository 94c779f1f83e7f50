import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from quayside.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="quayside-warehouse-")
    s = build_session(cpus=4, shuffle_partitions=8, app="quayside-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    checkpoint_root(s)  # sets one only when the session names none
    yield s


def write_file(path, data: bytes, mtime: float | None = None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path
