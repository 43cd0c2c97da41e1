import pytest

from tidemark.llm.common import ship


@pytest.fixture(autouse=True, scope="session")
def _shipped(spark):
    ship(spark)
