import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkops.session import get_session
    s = get_session("local[*]", 8, app_name="sparkops-tests",
                    extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def write_text(tmp_path):
    """Write a small fixture file and return its path."""
    def _write(name: str, content: str) -> str:
        p = tmp_path / name
        p.write_text(content, encoding="utf-8")
        return str(p)
    return _write
