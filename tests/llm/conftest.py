import pytest
from navloom.llm import queries


@pytest.fixture(autouse=True)
def shipped(spark):
    queries.ship(spark)


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/out"
