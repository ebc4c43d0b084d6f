from __future__ import annotations

import pytest

from ledgerbrook.session import clear_scratch, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, name="tests")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()
