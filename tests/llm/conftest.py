import pytest

from tripcraft.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    importable(spark)
