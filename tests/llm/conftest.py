import pytest


@pytest.fixture(scope="session")
def llm_spark(spark):
    from rastergrid.session import ship_package

    ship_package(spark)
    return spark
