import os

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.01"


def rows(name: str, sf: str = SF) -> list[dict]:
    return pq.read_table(os.path.join(sf, f"{name}.parquet")).to_pylist()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF
