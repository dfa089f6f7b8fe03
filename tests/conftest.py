import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from treeshred import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def document(tmp_path):
    """Write one capture document from packet bodies and return its folder."""
    def write(*packets, name="a.xml", folder="."):
        target = tmp_path / folder
        target.mkdir(parents=True, exist_ok=True)
        info = ('<proto name="geninfo"><field name="num" show="{n}"/>'
                '<field name="timestamp" show="Jan  2, 2011 03:04:05.123456789"/></proto>')
        body = "".join(f"<packet>{info.format(n=i + 1)}{p}</packet>" for i, p in enumerate(packets))
        (target / name).write_text(f'<?xml version="1.0"?><pdml>{body}</pdml>', encoding="utf-8")
        return str(tmp_path)
    return write
