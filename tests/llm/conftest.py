from __future__ import annotations

import pytest


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from dqspark.llm.common import ship

    ship(spark)
    return spark
