import pyarrow.parquet as pq
import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def texts(sf):
    table = pq.read_table(f"{sf}/documents.parquet")
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


@pytest.fixture(scope="session")
def labels(sf):
    table = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    return {row["doc_id"]: row for row in table}
