from __future__ import annotations

import pytest

from footfall.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        shuffle_partitions=4,
        memory="6g",
        **{"spark.sql.warehouse.dir": str(warehouse), "spark.sql.catalogImplementation": "in-memory"},
    )
    yield session
    session.stop()
