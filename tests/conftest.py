import pytest

from ratemill.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from ratemill import TableStore

    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def write(tmp_path):
    """Write a file below a fresh folder and return its path."""

    def _write(name: str, text: str | bytes) -> str:
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(path)

    return _write
