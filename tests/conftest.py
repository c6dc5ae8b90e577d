import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmart.session import build_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app="tripmart-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark, request):
    """A fresh folder below the session's checkpoint directory."""
    return scratch_path(spark, request.node.name.replace("[", "-").replace("]", ""))


def local_file(folder: str, name: str, text: str) -> str:
    """Write a small landed file for a test (test folders are local)."""
    path = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)
    return os.path.join(path, name)
