from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pricefold.session import local_session  # noqa: E402
from pricefold.store import PriceStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    made = PriceStore(spark, str(tmp_path / "store"))
    made.reset()
    return made


@pytest.fixture
def write(tmp_path):
    """Write a text file and return its path."""

    def writer(name: str, *lines: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return writer
