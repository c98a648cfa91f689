import pytest

from shelfwise.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def drop(tmp_path):
    """Write a drop file and return its path."""

    def write(name: str, content: str, encoding: str = "utf-8-sig") -> str:
        path = tmp_path / name
        path.write_text(content, encoding=encoding)
        return str(path)

    return write
