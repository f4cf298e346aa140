import pytest


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from slawatch.llm.base import workers_import

    workers_import(spark)


@pytest.fixture(scope="session")
def edges(spark):
    from fixtures import edge_documents

    return edge_documents(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    from fixtures import no_documents

    return no_documents(spark)
