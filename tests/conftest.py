import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from marketlake.plans.lake import Lake  # noqa: E402
from marketlake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        app="tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def lake(tmp_path):
    """An empty lake of its own."""
    tag = uuid.uuid4().hex[:8]
    landing = tmp_path / "landing"
    return Lake(
        reports=str(tmp_path / "reports"),
        ohlcv=str(landing / "ohlcv"),
        company=str(landing / "company"),
        fx=str(landing / "fx"),
        macro=str(landing / "macro"),
        bronze=f"bronze_{tag}",
        silver=f"silver_{tag}",
        gold=f"gold_{tag}",
        tables_root=str(tmp_path / "tables"),
    )


@pytest.fixture
def land():
    """Write one landing file: ``land(root, "AAPL/2025/Dec/18", "AAPL_stock_13-16-54.csv", header, rows)``."""

    def write(root, folder, name, header, rows=()):
        path = Path(root) / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_text("\n".join([header, *rows]) + "\n")
        return path / name

    return write


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
