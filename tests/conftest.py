import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from twasprep.session import build_session

    s = build_session("local[4]", app_name="twasprep-tests", shuffle_partitions=4,
                      extra_conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return Path(tempfile.mkdtemp(prefix="twasprep-test-"))


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)
