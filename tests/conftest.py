from __future__ import annotations

import pytest

from basketry.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        4,
        "tests",
        shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": str(warehouse), "spark.driver.memory": "6g"},
    )
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted for comparison."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=repr) if not order else found
