import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ingot.session import build_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="ingot-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ingot-tests-"),
                             "spark.ui.showConsoleProgress": "false"})
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def ws(spark):
    """A fresh folder under the shared checkpoint directory."""
    from ingot.session import new_workspace
    return new_workspace(spark, "test")


def write_lines(path: str, lines: list[str], name: str = "part-0.jsonl") -> str:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    return path
