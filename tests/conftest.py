import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from framequarry.config import Layout  # noqa: E402
from framequarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    """Empty object roots and tables in a fresh folder."""
    return Layout(*[str(tmp_path / n) for n in ("raw-public", "public", "raw-user", "user", "tables")])


def write(root, files):
    """Write {relative name: text or bytes} below a folder."""
    for name, content in files.items():
        path = Path(root) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def tree(root):
    """{relative name: bytes} of all files below a folder, without Spark's own marker files."""
    base = Path(root)
    return {
        str(p.relative_to(base)): p.read_bytes()
        for p in base.rglob("*") if p.is_file() and not p.name.startswith((".", "_SUCCESS"))
    }
